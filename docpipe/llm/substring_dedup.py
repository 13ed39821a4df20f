"""Removing passages that occur earlier in the corpus, with repeated-phrase automata.

A window is a run of ``width`` words. Two tallies (see ``shared``) confirm which passages
may recur. Of the 8-word grams in a window the one with the least hash is its anchor, and
a window can recur only if its anchor does; windows with recurring anchors are tallied by
their own hashes. Hashes only ever say "may recur", so what they tell apart wrongly costs
time and never a word.

The passages confirmed (runs of windows with one anchor) leave the documents as word
sequences and go to the shard that owns their anchor: whichever documents hold a window,
all of them stream it through that one shard. A shard compiles its passages' windows into
Aho-Corasick automata over words, each of bounded size, and streams every document's
passages through each of them. The automata's hits, word for word, say where each window
occurs; the first place in the corpus stays and all others are removed. A passage that
fills a third of the corpus is one entry for each group of documents, in every step.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, dealt, groups_for, mix, ngram_hashes, planes, settled, signed, slices, trim, unplane

_U = np.uint64
WIDTH, GRAM = 20, 8
#: Windows that one automaton may hold: automata that fit in a cache are compiled ten times faster.
SHARD = 1_000
#: Bytes of a passage's anchor, and of its place: id, digest of the text, row, first word.
_SENT = (4, 8, 8, 8, 5)


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """Minimum or maximum of each run of n entries."""
    reach = 1
    while 2 * reach <= n:
        x = best(x[: len(x) - reach], x[reach:])
        reach *= 2
    return best(x[: len(x) - (n - reach)], x[n - reach :]) if n > reach else x


class _Group:
    """Documents of one group in the corpus' order, their words, windows and anchors."""

    def __init__(self, table: pa.Table, width: int = WIDTH, bits: int = 64):
        null = np.asarray(table["_id"].is_null())
        ids = signed(np.where(null, 0, table["_id"].to_numpy(zero_copy_only=False)).astype(np.int64))
        ids[null] = ~_U(0)
        digest, row = (signed(table[c].to_numpy()) for c in ("_digest", "_row"))
        order = np.lexsort((row, digest, ids))
        self.table = table.take(pa.array(order))
        self.place = [x[order] for x in (ids, digest, row)]
        self.words = Words(self.table["_text"], lower=False)
        self.hashes = h = self.words.hashes & _U((1 << bits) - 1)
        first = self.words.first
        self.n, self.width = len(h), width
        self.doc = np.repeat(np.arange(len(self.words.counts)), self.words.counts)
        self.start = np.arange(self.n) - first[:-1][self.doc]
        self.valid = np.flatnonzero(first[1:][self.doc] - np.arange(self.n) >= width)
        self.anchor = self.chosen = np.zeros(0, _U)
        if len(self.valid):
            reach = width - GRAM + 1
            gram = ngram_hashes(h, GRAM)
            least = _slide(gram, reach, np.minimum)
            allowed = np.zeros(len(least) + 2 * (reach - 1), _U)
            allowed[self.valid + reach - 1] = least[self.valid]
            # least hashes are small ones: mixed again, they spread over all shards
            self.anchor = mix(least[self.valid])
            self.chosen = mix(gram[_slide(allowed, reach, np.maximum) == gram])

    def anchored(self, told: dict[int, np.ndarray]) -> np.ndarray:
        """Which of the valid windows have an anchor that occurs twice or more in the corpus."""
        return told[1].astype(bool)[np.searchsorted(np.unique(self.chosen), self.anchor)] if len(self.valid) else np.zeros(0, bool)

    def window_keys(self, may: np.ndarray):
        """Distinct hashes of those valid windows, how often each, and each window's number."""
        if not may.any():
            return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, number, n = np.unique(ngram_hashes(self.hashes, self.width, salt=1)[self.valid[may]], return_inverse=True, return_counts=True)
        return keys, n, number

    def passages(self, told: dict[int, np.ndarray]):
        """Runs of confirmed windows with one anchor: first word, number of windows, anchor."""
        may = self.anchored(told)
        _, _, number = self.window_keys(may)
        may[may] = told[2].astype(bool)[number]
        at, anchor = self.valid[may], self.anchor[may]
        if not len(at):
            return at, at, anchor
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1])]))
        return at[new], np.diff(np.append(new, len(at))), anchor[new]

    def sequences(self, first: np.ndarray, windows: np.ndarray) -> list[bytes]:
        """The words of passages, one blank between them."""
        size = self.words.ends - self.words.starts
        begin = np.cumsum(size + 1) - size - 1
        plain = np.full(int((size + 1).sum()), 32, np.uint8)
        for lo in range(0, self.n, 1 << 18):
            s = size[lo : lo + (1 << 18)]
            inner = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
            plain[np.repeat(begin[lo : lo + len(s)], s) + inner] = self.words.buf[np.repeat(self.words.starts[lo : lo + len(s)], s) + inner]
        last = first + windows + self.width - 2
        data = plain.tobytes()
        return [data[a:b] for a, b in zip(begin[first].tolist(), (begin[last] + size[last]).tolist())]


def _asked(p: int, own: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"bucket": pa.array([b for b, _ in own], pa.int32()), "p": pa.array([p] * len(own), pa.int32()), "asked": pa.array([x for _, x in own], pa.large_binary()).cast(pa.binary())})


def _receive(blobs: list[bytes], widths) -> tuple[np.ndarray, list[np.ndarray]]:
    sizes = np.array([len(x) // sum(widths) for x in blobs], np.int64)
    out, skip = [], 0
    for w in widths:
        out.append(np.concatenate([unplane(x[skip * n : (skip + w) * n], w) for x, n in zip(blobs, sizes)] or [np.zeros(0, _U)]))
        skip += w
    return sizes, out


_ASKED, _TOLD = "bucket int, p int, asked binary", "p int, bucket int, kind int, told binary"


def _tell(table: pa.Table, sizes: np.ndarray, flags: np.ndarray, kind: int) -> pa.Table:
    parts = np.split(flags.astype(np.uint8), np.cumsum(sizes)[:-1])
    return pa.table({"p": table["p"], "bucket": table["bucket"], "kind": pa.array([kind] * len(parts), pa.int32()), "told": pa.array([x.tobytes() for x in parts], pa.binary())})


def _told(table: pa.Table) -> dict[int, np.ndarray]:
    """Answers of each kind in the order of the questions, bucket after bucket."""
    table = table.sort_by("bucket")
    out = defaultdict(list)
    for k, x in zip(table["kind"].to_pylist(), table["told"].to_pylist()):
        out[k].append(np.frombuffer(x, np.uint8))
    return defaultdict(lambda: np.zeros(0, np.uint8), {k: np.concatenate(v) for k, v in out.items()})


def _ask_anchors(buckets: int, width: int, bits: int):
    def ask(table: pa.Table) -> pa.Table:
        keys, n = np.unique(_Group(table, width, bits).chosen, return_counts=True)
        trim()
        return _asked(table["_p"][0].as_py(), [(b, planes(keys[s]) + planes(np.minimum(n[s], 2).astype(_U), 1)) for b, s in slices(keys, buckets)])

    return ask


def _tell_recurring(kind: int):
    """1 for a key that two groups hold, or one group twice."""

    def tell(table: pa.Table) -> pa.Table:
        sizes, (keys, n) = _receive(table["asked"].to_pylist(), (8, 1))
        _, at = np.unique(keys, return_inverse=True)
        return _tell(table, sizes, (np.bincount(at, n.astype(float)) >= 2)[at] if len(at) else np.zeros(0, bool), kind)

    return tell


def _ask_windows(buckets: int, width: int, bits: int):
    def ask(key, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _asked(0, [])
        g = _Group(table, width, bits)
        keys, n, _ = g.window_keys(g.anchored(_told(told)))
        out = _asked(key[0].as_py(), [(b, planes(keys[s]) + planes(np.minimum(n[s], 2).astype(_U), 1)) for b, s in slices(keys, buckets)])
        del g, keys, n
        trim()
        return out

    return ask


def _distinct(g: _Group, told: dict[int, np.ndarray], buckets: int):
    """Passages of a group in the order in which shards are asked: one each of equal ones.

    (first words, windows, number of the distinct one, anchors) of all passages, then for
    distinct ones: their first passage, shard, and words.
    """
    first, windows, anchor = g.passages(told)
    number, texts, lead = np.zeros(len(first), np.int64), {}, []
    for i, text in enumerate(g.sequences(first, windows) if len(first) else ()):
        if (k := texts.setdefault(text, len(texts))) == len(lead):
            lead.append(i)
        number[i] = k
    lead = np.array(lead, np.int64)
    shard = (((anchor[lead] >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    words = list(texts)
    return (first, windows, rank[number] if len(first) else number, anchor), lead[order], shard[order], [words[i] for i in order.tolist()]


def _ask_passages(buckets: int, width: int, bits: int):
    def ask(key, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _asked(0, [])
        g = _Group(table, width, bits)
        (first, _, _, anchor), lead, shard, words = _distinct(g, _told(told), buckets)
        edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, np.int64)
        own = []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            at = first[lead[a:b]]
            facts = (anchor[lead[a:b]], *(x[g.doc[at]] for x in g.place), g.start[at].astype(_U))
            own.append((int(shard[a]), (b - a).to_bytes(4, "little") + b"".join(planes(x, n) for x, n in zip(facts, _SENT)) + b"\n".join(words[a:b])))
        out = _asked(key[0].as_py(), own)
        del g, words, own
        trim()
        return out

    return ask


def locate(passages: list[tuple], anchors: np.ndarray, width: int = WIDTH, shard: int = SHARD) -> np.ndarray:
    """Which window occurs at each place of the passages, as numbers, by Aho-Corasick automata.

    ``passages`` are tuples of word numbers; equal windows have equal ``anchors``. An automaton
    holds the windows of whole anchors, ``shard`` windows or as many as one anchor has, and all
    passages of its anchors stream through it; a window's number comes from the automaton that
    found it. Places are those of all windows of a passage, passage after passage.
    """
    sizes = np.array([len(t) - width + 1 for t in passages], np.int64)
    offset = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.int64)
    order = np.argsort(anchors, kind="stable")
    turn = np.cumsum(sizes[order]) // shard
    turn = turn[np.searchsorted(anchors[order], anchors[order])]  # that of the anchor's first passage
    base = 0
    for own in np.split(order, np.flatnonzero(np.diff(turn)) + 1) if len(order) else ():
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for i in own.tolist():
            t = passages[i]
            for k in range(len(t) - width + 1):
                automaton.add_word(t[k : k + width], base)
                base += 1
        automaton.make_automaton()
        for i in own.tolist():
            o = int(offset[i])
            found = [window for _, window in automaton.iter(passages[i])]
            out[o : o + len(found)] = found
    return out


def _tell_first(width: int, shard: int):
    """1 for each window of each passage whose place is the first in the corpus."""

    def tell(table: pa.Table) -> pa.Table:
        blobs = table["asked"].to_pylist()
        counts = [int.from_bytes(x[:4], "little") for x in blobs]
        wide = sum(_SENT)
        _, (anchor, ids, digest, row, start) = _receive([x[4 : 4 + n * wide] for x, n in zip(blobs, counts)], _SENT)
        texts: dict[bytes, int] = {}
        number = np.array([texts.setdefault(t, len(texts)) for x, n in zip(blobs, counts) for t in x[4 + n * wide :].split(b"\n")], np.int64)
        del blobs
        words = defaultdict(count().__next__)
        passages = [tuple(map(words.__getitem__, t.split(b" "))) for t in texts]
        del texts, words
        anchors = np.zeros(len(passages), _U)
        anchors[number] = anchor
        window = locate(passages, anchors, width, shard)
        sizes = np.array([len(t) - width + 1 for t in passages], np.int64)
        del passages
        # a place is a rank among the documents here, then a word
        order = np.lexsort((row, digest, ids))
        same = (ids[order[1:]] == ids[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ~same]))
        each = sizes[number]  # windows of each passage sent
        inner = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        place = np.repeat((rank << 36) + start.astype(np.int64), each) + inner
        which = window[np.repeat((np.cumsum(sizes) - sizes)[number], each) + inner]
        least = np.full(int(window.max()) + 1 if len(window) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, which, place)
        ends = np.cumsum(each)[np.cumsum(counts) - 1]
        out = _tell(table, np.diff(ends, prepend=0), place == least[which], 3)
        trim()
        return out

    return tell


def _remove(buckets: int, width: int, bits: int):
    def remove(key, table: pa.Table, told: pa.Table) -> pa.Table:
        g, told = _Group(table, width, bits), _told(told)
        (first, windows, number, _), lead, _, _ = _distinct(g, told, buckets)
        change = np.zeros(g.n + 1, np.int64)
        if len(first):
            # a window goes unless it is the corpus' first, and so does any in a repeated passage
            sent = windows[lead]
            inner = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
            stays = told[3].astype(bool)[np.repeat((np.cumsum(sent) - sent)[number], windows) + inner]
            stays &= np.repeat(lead[number] == np.arange(len(first)), windows)
            gone = (np.repeat(first, windows) + inner)[~stays]
            np.add.at(change, gone, 1)
            np.add.at(change, gone + width, -1)
        gone = np.cumsum(change[: g.n]) > 0
        sums = np.concatenate([[0], np.cumsum(gone)])
        removed = sums[g.words.first[1:]] - sums[g.words.first[:-1]]
        texts = []
        for i, k in enumerate(removed.tolist()):
            own = g.words.text(i).split()
            if k:
                own = [w for w, x in zip(own, gone[g.words.first[i] : g.words.first[i + 1]].tolist()) if not x]
            texts.append(b" ".join(own).decode("utf-8", "replace"))
        names = [c for c in g.table.column_names if not c.startswith("_")]
        out = pa.table([g.table["_id"], pa.array(g.words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(texts, pa.string()), *(g.table[c] for c in names)], names=["doc_id", "n_words", "n_removed", "kept_text", *names])
        del g, texts, gone, change
        trim()
        return out

    return remove


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None, width: int = WIDTH, group_mb: int = 8, least_groups: int = 64, shard: int = SHARD, bits: int = 64) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words, one blank between) of each row.

    A word goes if it is in a window of ``width`` words that also starts earlier: in a
    document of smaller id or earlier in the same one. Windows are judged on the input,
    word for word. Words are unchanged runs of anything but the six ASCII white space
    characters.

    Null and empty texts have no words; texts shorter than a window lose none. Null ids
    come after all others. Rows that share an id, or have none, count in the order of
    their texts' 64-bit digests, equal rows in the order in which they are read; they are
    dealt over all groups like any others. ``carry`` names columns to pass on in a struct
    ``rest``; others are ignored. An empty table gives an empty result. ``bits`` are kept
    of a word's hash: fewer make more candidates and change no result.
    """
    docs = settled(docs)  # rows keep their numbers
    groups = groups_for(docs, text, group_mb, least_groups)
    row = F.monotonically_increasing_id()
    cols = [row.alias("_row"), F.col(doc_id).cast("long").alias("_id"), F.xxhash64(F.col(text).cast("string")).alias("_digest"), F.col(text).cast("string").alias("_text")]
    if carry:
        cols.append(F.struct(*(F.col(c) for c in carry)).alias("rest"))
    by = lambda df, k: df.groupBy(k)
    # one exchange of the texts serves all steps
    rows = dealt(docs.select(*cols).withColumn("_p", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("int")), "_p", groups)
    ask = lambda told, how: by(rows, "_p").cogroup(by(told, "p")).applyInArrow(how(groups, width, bits), _ASKED)
    anchors = by(by(rows, "_p").applyInArrow(_ask_anchors(groups, width, bits), _ASKED), "bucket").applyInArrow(_tell_recurring(1), _TOLD)
    windows = anchors.union(by(ask(anchors, _ask_windows), "bucket").applyInArrow(_tell_recurring(2), _TOLD))
    firsts = windows.union(by(ask(windows, _ask_passages), "bucket").applyInArrow(_tell_first(width, shard), _TOLD))
    kinds = "doc_id long, n_words long, n_removed long, kept_text string" + (f", rest {dict(rows.dtypes)['rest']}" if carry else "")
    return by(rows, "_p").cogroup(by(firsts, "p")).applyInArrow(_remove(groups, width, bits), kinds)
