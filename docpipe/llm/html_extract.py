"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks. A classifier gives each block the cost of calling
it content and of calling it boilerplate: these are the capacities of its edges to the
two terminals. Blocks next to each other, and blocks near each other in the DOM, are
joined by smoothness edges whose capacity falls with their distance. A maximum flow
gives the minimum cut, and the blocks on the source's side are the content.

The classifier is a logistic regression on features of a block: of its text (length, share
of linked text, punctuation, heading) and of its place (elements whose meaning is plain,
class and id names, inside or outside the part of the page that holds most running text,
repeated boxes). Names count by how well they say what an element is, and the less the
more of the page's text the element holds. It is trained on a bounded sample of the pages,
where plain elements (article, nav, footer, ...) label their blocks and are themselves
hidden from it; without data it stays at its default weights.
"""

from __future__ import annotations

import html as html_module
import math
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))|\b(hidden)\b")
_SPACES = re.compile(r"\s+")

# Fixed values of HTML: element names by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style head title noscript template svg math canvas object iframe audio video map select option datalist textarea button input noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - frozenset("body html tbody td tfoot th thead tr caption legend optgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and roles that say what they hold.
GOOD_ELEMENTS = frozenset("article main".split())
BAD_ELEMENTS = frozenset("nav footer aside form menu dialog header search fieldset".split())
GOOD_ROLES = frozenset("main article".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar note status".split())
#: Words in class and id names of boilerplate, words that only tell of a box, and words that turn a name around.
BAD_NAMES = frozenset("ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion promoted banner nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidebars rail footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert warning disclaimer privacy popup modal overlay dialog newsletter subscribe subscription signup signin login register paywall comment comments commentlist respond reply replies disqus discussion feedback share sharing social follow related recommended recommendations trending popular pager pagination paging widget widgets toc tags tagcloud copyright legal search form skip hidden".split())
BOX_NAMES = frozenset("area bar block body box boxes container content group holder inner item items left line link links list main outer panel right row section slot text top unit wrap wrapper zone".split())
TURNING_NAMES = frozenset("after before disabled enabled has hide no non not with without".split())

#: Log odds of content before any training, in the order of ``features``.
FEATURES = ("always", "log of words", "linked share", "marks a word", "ends a sentence", "heading", "first heading", "element", "bad name", "outside the main part", "repeated box")
DEFAULT_WEIGHTS = (-1.0, 0.8, -5.0, 2.0, 0.8, 0.5, 2.5, 5.0, -5.0, -4.5, -3.5)
_ELEMENT = FEATURES.index("element")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def name_says(value: str) -> float:
    """How plainly a class or id value names boilerplate: 1 a word of its own, less in compounds.

    In a compound the last word that is no mere box counts; other bad words tell little, and
    nothing beside a word such as with, has or no.
    """
    most = 0.0
    for token in value.split():
        words = [w.lower() for part in re.split(r"[_\-:.\d]+", token) for w in _NAME.findall(part)]
        bad = [w in BAD_NAMES for w in words]
        if token.lower() in BAD_NAMES or len(words) == 1 and bad[0]:
            most = 1.0
        elif any(bad) and not TURNING_NAMES & set(words):
            head = next((w for w in reversed(words) if w not in BOX_NAMES or w in BAD_NAMES), words[-1])
            most = max(most, 0.8 if head in BAD_NAMES else 0.3)
    return most


class Tree:
    """Elements of a page in the order of their starts: a parent's number is below its children's.

    ``good`` and ``bad`` tell of the nearest plain element above or at an element.
    """

    def __init__(self):
        self.parent, self.name, self.kind, self.says, self.good, self.bad, self.depth = [-1], ["html"], [""], [0.0], [-1], [False], [0]

    def add(self, parent: int, name: str, kind: str, says: float, good: bool, bad: bool) -> int:
        n = len(self.parent)
        self.parent.append(parent)
        self.name.append(name)
        self.kind.append(kind)
        self.says.append(says)
        # an article's own header may hold its title
        bad = bad and not (name == "header" and self.good[parent] >= 0)
        self.good.append(n if good and self.good[parent] < 0 else self.good[parent])
        self.bad.append(self.bad[parent] or bad)
        self.depth.append(self.depth[parent] + (name in BLOCK))
        return n


class Block:
    __slots__ = ("text", "words", "linked", "at", "heading", "x")

    def __init__(self, text, linked, at, heading):
        self.text, self.linked, self.at, self.heading = text, linked, at, heading
        self.words = text.count(" ") + 1
        self.x = None


def _read(attrs: str) -> tuple[str, float, bool, bool, bool]:
    """Of an element's attributes: class, what names say, good role, bad role, shown."""
    kind, says, good, bad, seen = "", 0.0, False, False, True
    if not attrs or attrs.isspace():
        return kind, says, good, bad, seen
    for key, a, b, c, hidden in _ATTR.findall(attrs):
        key, text = key.lower(), html_module.unescape(a or b or c)
        if hidden or key == "hidden" or key == "aria-hidden" and text.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", text, re.I):
            seen = False
        elif key == "role":
            good, bad = good or text.strip().lower() in GOOD_ROLES, bad or text.strip().lower() in BAD_ROLES
        elif key == "itemprop" and "articlebody" in text.lower():
            good = True
        elif key in ("class", "id"):
            says = max(says, name_says(text))
            kind = text if key == "class" else kind
    return kind, says, good, bad, seen


#: Elements that a start tag of a kind ends, and those that keep it from reaching further up.
_ENDS = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
_WITHIN = {"li": ("ul", "ol", "menu"), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}


def blocks(page: str) -> tuple[list[Block], Tree]:
    """Text blocks in page order; hidden elements, scripts, styles and markup are left out."""
    out: list[Block] = []
    tree = Tree()
    stack: list[tuple[str, int, bool]] = []  # (name, number, shown)
    where: dict[str, list[int]] = {}  # name -> its places in the stack; "" -> blocks other than p
    text: list[str] = []
    linked, at, shown = 0, 0, True

    def flush():
        nonlocal linked
        if text:
            joined = _SPACES.sub(" ", html_module.unescape("".join(text))).strip()
            if joined:
                heading = max((where[h][-1], h) for h in HEADINGS if where.get(h))[1] if any(where.get(h) for h in HEADINGS) else ""
                lowest = max((where[k][-1] for k in ("", "p") if where.get(k)), default=-1)
                out.append(Block(joined, min(1.0, linked / len(joined)), stack[lowest][1] if lowest >= 0 else 0, heading))
        text.clear()
        linked = 0

    def last(names) -> int:
        return max((where[k][-1] for k in names if where.get(k)), default=-1)

    def end(k: int):
        """Ends the elements from place k of the stack on."""
        nonlocal shown
        while len(stack) > k:
            name = stack.pop()[0]
            where[name].pop()
            if name in BLOCK and name != "p":
                where[""].pop()
        shown = stack[-1][2] if stack else True

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at and shown:
            text.append(piece := page[at : m.start()])
            if where.get("a"):
                linked += len(piece)
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCK or name in UNSEEN:
            flush()
        elif name == "br":
            text.append(" ")
        if m[1]:
            if where.get(name):
                end(where[name][-1])
            continue
        if name in CLOSES_P and (p := last(("p",))) > last(("",)):
            end(p)
        if name in _ENDS and (k := last(_ENDS[name])) > last(_WITHIN[name]):
            end(k)
        if name in VOID or m[3].rstrip().endswith("/") and name in ("svg", "path"):
            continue
        kind, says, good, bad, seen = _read(m[3])
        if name in ("html", "body"):
            kind, says = "", 0.0  # page-wide names tell of the page, not of its parts
        number = tree.add(stack[-1][1] if stack else 0, name, kind, says, good or name in GOOD_ELEMENTS, bad or name in BAD_ELEMENTS)
        for key in (name, "") if name in BLOCK and name != "p" else (name,):
            where.setdefault(key, []).append(len(stack))
        shown = shown and seen and name not in UNSEEN
        stack.append((name, number, shown))
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            end(len(stack) - 1)
            if not close:
                break
    if at < len(page) and shown:
        text.append(page[at:])
    flush()
    return out, tree


def describe(found: list[Block], tree: Tree) -> np.ndarray:
    """Features of a page's blocks, a row each; every pass over the tree is linear."""
    n = len(tree.parent)
    own = np.array([b.words * (1 - b.linked) for b in found])
    mass = np.zeros(n)
    np.add.at(mass, [b.at for b in found], own)
    direct = mass.copy()
    for k in range(n - 1, 0, -1):
        mass[tree.parent[k]] += mass[k]
    total = max(mass[0], 1e-9)
    # a name says the less of an element, the more of the page's text is in it
    bad = [0.0] * n
    for k in range(1, n):
        bad[k] = max(bad[tree.parent[k]], tree.says[k] * max(0.0, 1 - 1.6 * mass[k] / total) if tree.says[k] else 0.0)
    # the main part: the plain element with most text, else where most running text is near by
    good = {g for g in set(tree.good) if g >= 0 and not tree.bad[g] and bad[g] < 0.7}
    if good and (most := max(mass[g] for g in good)) >= 0.1 * total:
        main = {g for g in good if mass[g] >= 0.5 * most}
    else:
        score = np.zeros(n)
        for k in np.flatnonzero(direct).tolist():
            if tree.bad[k] or bad[k] >= 0.7:
                continue
            up = k if tree.name[k] not in ("p", "li", "blockquote", "pre", "dd", "td", *HEADINGS) else tree.parent[k]
            for share in (1.0, 0.55, 0.35):
                score[up] += direct[k] * share
                up = tree.parent[up]
                if up < 0:
                    break
        main = {int(score.argmax())} if n > 1 and score.max() > 0 else {0}
    inside = [False] * n
    for k in range(n):
        inside[k] = k in main or k > 0 and inside[tree.parent[k]]
    weight = min(1.0, sum(mass[k] for k in main) / total)
    # boxes: several children of one element, alike in name and class, that share out less than half of its text
    alike: dict[tuple, list[int]] = {}
    for k in range(1, n):
        if tree.name[k] in ("div", "li", "section", "article") and (tree.kind[k] or tree.name[k] == "article") and mass[k]:
            alike.setdefault((tree.parent[k], tree.name[k], tree.kind[k]), []).append(k)
    boxed = [False] * n
    for own_kind in alike.values():
        size = sum(mass[k] for k in own_kind)
        if len(own_kind) > 1 and size < 0.45 * total and size < 60 * len(own_kind) and not main & set(own_kind):
            for k in own_kind:
                boxed[k] = True
    for k in range(1, n):
        boxed[k] = boxed[k] or boxed[tree.parent[k]]
    x = np.zeros((len(found), len(FEATURES)))
    for b, row in zip(found, x):
        marks = sum(map(b.text.count, ".,;:!?"))
        element = -1.0 if tree.bad[b.at] else 1.0 if tree.good[b.at] in main else 0.0
        row[:] = (1, math.log1p(b.words), b.linked, min(marks / b.words, 1.0), b.text[-1] in ".!?…”\"'", bool(b.heading), b.heading == "h1" and not tree.bad[b.at], element, bad[b.at], 0.0 if inside[b.at] else weight, boxed[b.at])
        b.x = row
    return x


def distance(a: int, b: int, tree: Tree, most: int = 12) -> int:
    """Steps between two elements in the tree of blocks, ``most`` at most."""
    steps = 0
    while a != b and steps < most:
        if a > b:  # the later one cannot be above the earlier
            a, b = b, a
        steps += tree.name[b] in BLOCK
        b = tree.parent[b]
    return steps


def edges(found: list[Block], tree: Tree, near: float = 1.5) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block with the next, and with the one before under its parent.

    They are weak between blocks that differ in what their names say or in the part of the page.
    """
    names, outside = FEATURES.index("bad name"), FEATURES.index("outside the main part")

    def strength(i, j):
        a, b = found[i].x, found[j].x
        return near * (1 - 0.8 * abs(a[names] - b[names])) * (0.3 if (a[outside] > 0) != (b[outside] > 0) or a[_ELEMENT] * b[_ELEMENT] < 0 else 1.0)

    out = [(i, i + 1, strength(i, i + 1) * math.exp(-0.5 * max(0, distance(found[i].at, found[i + 1].at, tree) - 2))) for i in range(len(found) - 1)]
    before: dict[int, int] = {}
    for i, b in enumerate(found):
        parent = tree.parent[b.at]
        if (j := before.get(parent, i)) < i - 1:
            out.append((j, i, strength(j, i) * 0.5))
        before[parent] = i
    return out


def minimum_cut(gain: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise the sum of |gain| of blocks labelled against it and of cut links.

    A block with gain g > 0 has an edge of capacity g from the source, else one of -g to
    the sink. The flow is found by Dinic's algorithm; what the source still reaches is
    content. A block that could be either (gain 0, no flow) is boilerplate.
    """
    n = len(gain)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def add(u, v, c, back=0.0):
        head[u].append(len(to))
        to.append(v)
        cap.append(c)
        head[v].append(len(to))
        to.append(u)
        cap.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            add(s, i, g)
        elif g < 0:
            add(i, t, -g)
    for i, j, c in links:
        add(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in head[u]:
                if cap[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if cap[e] <= 1e-12)
                u = to[path[k] ^ 1]
                del path[k:]
            elif at[u] < len(head[u]):
                e = head[u][at[u]]
                if cap[e] > 1e-12 and level[to[e]] == level[u] + 1:
                    path.append(e)
                    u = to[e]
                else:
                    at[u] += 1
            elif path:
                level[u] = -2
                u = to[path.pop() ^ 1]
                at[u] += 1
            else:
                break


def label(page: str | None, weights=DEFAULT_WEIGHTS) -> tuple[list[Block], np.ndarray, list[bool]]:
    """Blocks of a page, their log odds of content, and whether the cut calls them content."""
    found, tree = blocks(page or "")
    if not found:
        return [], np.zeros(0), []
    gain = describe(found, tree) @ np.asarray(weights)
    if (gain > 0).all() or (gain <= 0).all():
        return found, gain, [bool(g > 0) for g in gain]  # nothing to cut
    return found, gain, minimum_cut(gain.tolist(), edges(found, tree))


def extract(page: str | None, weights=DEFAULT_WEIGHTS) -> str:
    """Main text of one page: its content blocks, joined by two newlines."""
    found, _, keep = label(page, weights)
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def fit(pages: list[str], rounds: int = 200, penalty: float = 0.1) -> tuple[float, ...]:
    """Weights of all features but that of the elements, learned from blocks in plain elements."""
    rows = [x[x[:, _ELEMENT] != 0] for page in pages for found, tree in [blocks(page)] if found for x in [describe(found, tree)]]
    x = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
    y = (x[:, _ELEMENT] > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return DEFAULT_WEIGHTS
    x[:, _ELEMENT] = 0
    balance = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    start = np.array(DEFAULT_WEIGHTS)
    w = start.copy()
    for _ in range(rounds):  # Newton steps towards the defaults where data say nothing
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (balance * (p - y)) + penalty * (w - start)
        hess = (x * (balance * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def sample_pages(pages: DataFrame, page_id: str, html: str, rows: int, largest: int) -> list[str]:
    """About ``rows`` whole pages of at most ``largest`` bytes, in the order of a digest of the id."""
    small = pages.where(F.octet_length(F.col(html)) <= largest)
    n = small.count()
    at = F.xxhash64(F.col(page_id)).bitwiseAND(F.lit((1 << 52) - 1))
    near = small.where(at < int((1 << 52) * min(1.0, 2.0 * rows / max(n, 1))))
    return [r["_h"] for r in near.select(at.alias("_at"), F.col(html).cast("string").alias("_h")).orderBy("_at", "_h").limit(rows).collect()]


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", fit_pages: int = 400, largest: int = 50_000) -> DataFrame:
    """Columns page_id, url, text, n_chars, one row for each page row.

    A null or empty page, or one without content, has an empty text. White space inside
    a block (Unicode white space) is one blank; blocks keep the page's order. Null ids
    and URLs are passed on; repeated rows are extracted one by one; other columns are
    ignored. Unclosed and stray tags are read as browsers do in the main. The classifier
    is fitted on at most ``fit_pages`` pages of at most ``largest`` bytes.
    """
    weights = fit(sample_pages(pages, page_id, html, fit_pages, largest))

    def per_batch(batches):
        for t in batches:
            texts = [extract(h, weights) for h in t["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([t["page_id"], t["url"], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(per_batch, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
