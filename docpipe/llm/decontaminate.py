"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive tokens of which only some positions count, so a
substitution at an ignored position leaves its hash as it is. Hashes of all masks at all
positions of test and training texts are joined. A hit says which diagonal it is on: how far
one text is shifted against the other. Along each diagonal with a hit the two texts are laid
side by side once, in one linear pass, and the best-scoring ungapped stretch through any of
its hits is verified: it must hold enough equal tokens, and few enough substitutions. So
repeated tokens cost no more than their diagonals.

Test sets are small as a rule: if their seeds fit in ``broadcast_mb`` (measured), every
task joins its documents with a copy in memory and nothing is shuffled. A larger test
set is joined by a shuffle on the hashes, and its hits are verified after joining texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, cut, mix

_U = np.uint64
#: Ones count, zeros are ignored. Three substitutions in 15 tokens leave a hit of one of them.
MASKS = ("11111", "1101011", "100110011")
LEAST_TOKENS = 5
#: Meetings that are looked at together.
MEETINGS = 4_000_000
#: Tokens are runs of letters and digits: every other ASCII byte breaks them.
BREAKS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def tokens(column) -> Words:
    return Words(column, lower=True, breaks=BREAKS)


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the counted tokens at each position; text borders are the caller's affair."""
    m = len(h) - len(mask) + 1
    if m <= 0:
        return np.zeros(0, _U)
    acc = np.full(m, int(mask, 2) + (len(mask) << 32), _U)
    for k, one in enumerate(mask):
        if one == "1":
            acc = acc * _U(0x5851F42D4C957F2D) + h[k : k + m]
    return mix(acc)


def masks_for(lengths: set[int]) -> list[str]:
    """The fixed masks, and for test texts too short for two of them one over the whole text."""
    return [*MASKS, *("1" * n for n in sorted(lengths) if LEAST_TOKENS < n < 9)]


def inside(words: Words, width: int) -> np.ndarray:
    """Positions at which a mask of this width stays within its text."""
    n = len(words.hashes)
    stop = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(stop - np.arange(n) >= width)


def all_seeds(words: Words, masks: list[str]):
    """Hash, text and place in it of every seed, mask by mask."""
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    for m in masks:
        at = inside(words, len(m))
        yield seeds(words.hashes, m)[at] if len(at) else np.zeros(0, _U), owner[at], at - words.first[:-1][owner[at]]


def best_on_diagonal(equal: np.ndarray, masks: list[str], least: int, identity: float):
    """(start, stop, equal tokens) of the best stretch that counts through any seed hit: most equal tokens, then first.

    A stretch through a place goes left and right as far as the sum of +1 for equal tokens
    and -1 for others grows; all places' stretches come from running extremes of prefix sums.
    """
    n = len(equal)
    if np.count_nonzero(equal) < least:
        return None
    hit = np.zeros(n, bool)
    for m in masks:
        if len(m) <= n:
            here = np.ones(n - len(m) + 1, bool)
            for k, one in enumerate(m):
                if one == "1":
                    here &= equal[k : k + len(here)]
            hit[: len(here)] |= here
    places = np.flatnonzero(hit)
    if not len(places):
        return None
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -1))])
    right = np.maximum.accumulate(total[::-1])[::-1]  # most from here on
    # the first place at which that most is reached, and the last one at which the least before was
    index = np.arange(n + 1)
    stop = np.minimum.accumulate(np.where(total == right, index, n + 1)[::-1])[::-1]
    low = np.minimum.accumulate(total)
    start = np.maximum.accumulate(np.where(total == low, index, -1))
    start, stop = start[places], stop[places + 1]
    same = np.concatenate([[0], np.cumsum(equal)])
    count = same[stop] - same[start]
    ok = np.flatnonzero((count >= least) & (count >= identity * (stop - start)))
    if not len(ok):
        return None
    k = ok[np.argmax(count[ok] * (n + 1) - start[ok])]
    return int(start[k]), int(stop[k]), int(count[k])


class Index:
    """Test texts, and their seeds in the order of hashes."""

    def __init__(self, ids: list, texts):
        words = tokens(texts)
        self.ids = ids
        self.texts = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.masks = masks_for({len(t) for t in self.texts})
        keys, items, places = (np.concatenate(x) for x in zip(*all_seeds(words, self.masks)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.items, self.places = keys[order], items[order], places[order]
        self.table = np.zeros(1 << 22, bool)
        self.table[(self.keys >> _U(42)).astype(np.int64)] = True

    def diagonals(self, words: Words) -> np.ndarray:
        """Columns text, item, offset of the item in the text, of every diagonal with a seed of both, once."""
        # one number for text, item and offset: offsets lie between minus the longest item and the longest text
        longest = max(map(len, self.texts), default=0)
        wide, n_items = longest + int(words.counts.max(initial=0)) + 1, max(len(self.texts), 1)
        found = [np.zeros(0, np.int64)]
        for h, text, place in all_seeds(words, self.masks):
            near = np.flatnonzero(self.table[(h >> _U(42)).astype(np.int64)])
            low, high = np.searchsorted(self.keys, h[near]), np.searchsorted(self.keys, h[near], "right")
            near, low, high = near[high > low], low[high > low], high[high > low]
            ends = np.cumsum(high - low)
            at = 0
            while at < len(near):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MEETINGS, "right")))
                n = (high - low)[at:to]
                each = np.repeat(near[at:to], n)
                j = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at:to], n)
                found.append(np.unique((text[each] * n_items + self.items[j]) * wide + place[each] - self.places[j] + longest))
                at = to
        pair, offset = np.divmod(np.unique(np.concatenate(found)), wide)
        return np.stack([pair // n_items, pair % n_items, offset - longest], axis=1)


def verify(doc: np.ndarray, item: np.ndarray, offset: int, masks: list[str], least: int, share: float, identity: float):
    """The best stretch of a diagonal (start and end in the document, start in the item, equal) if one counts."""
    low, high = max(0, -offset), min(len(item), len(doc) - offset)
    found = best_on_diagonal(item[low:high] == doc[low + offset : high + offset], masks, min(least, int(np.ceil(share * len(item)))), identity)
    if found is None:
        return None
    a, b, equal = found
    return low + a + offset, low + b + offset, low + a, equal


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 12, share: float = 0.75, identity: float = 0.75, broadcast_mb: int = 32) -> DataFrame:
    """One row for each document and test item that it overlaps: doc_id, item_id, n_matched,
    n_item (tokens of the item), doc_start and doc_end (tokens), item_start.

    An overlap counts if a stretch of both texts, token by token, has at least ``least``
    equal tokens (or ``share`` of an item, if that is fewer) and equal tokens are at least
    ``identity`` of it. Of several the one with most equal tokens is told, then the first.

    Tokens are runs of letters and digits, A-Z lower-cased. Null and empty texts overlap
    nothing; items under five tokens are too short to be recognised and match nothing.
    Rows that share an id are compared one by one and told once. Null ids are told as
    null. Empty tables give an empty result; other columns are ignored.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("item_text")).where(F.col("item_text").isNotNull())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    found = "doc_id long, item_id long, n_matched int, n_item int, doc_start int, doc_end int, item_start int"
    limits = (least, share, identity)

    def table(out):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64() if k < 2 else pa.int32()) for k in range(7)], names=["doc_id", "item_id", "n_matched", "n_item", "doc_start", "doc_end", "item_start"])

    if size <= broadcast_mb << 20:
        got = items.orderBy("item_id", "item_text").toArrow()
        shared = {"ids": got["item_id"].to_pylist(), "texts": got["item_text"].combine_chunks()}

        def per_batch(batches):
            index = Index(shared["ids"], shared["texts"])
            for t in batches:
                for lo in range(0, t.num_rows, 2000):
                    part = t.slice(lo, 2000)
                    words, ids, out = tokens(part["text"]), part["doc_id"].to_pylist(), []
                    for text, item, offset in index.diagonals(words).tolist():
                        doc = words.hashes[words.first[text] : words.first[text + 1]]
                        if ok := verify(doc, index.texts[item], offset, index.masks, *limits):
                            a, b, start, equal = ok
                            out.append((ids[text], index.ids[item], equal, len(index.texts[item]), a, b, start))
                    yield table(out)

        met = rows.mapInArrow(per_batch, found)
    else:
        lengths = cut(items.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": pa.array(tokens(t["item_text"]).counts.astype(np.int32))}) for t in bs), "n int").distinct().where("n < 9"))
        masks = masks_for({r.n for r in lengths.collect()})

        def seed_rows(name, column):
            def per_batch(batches):
                for t in batches:
                    words = tokens(t[column])
                    for h, text, place in all_seeds(words, masks):
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), t[name].take(pa.array(text)), pa.array(place.astype(np.int32))], names=["seed", name, f"{name}_at"])

            return per_batch

        keyed = items.withColumn("item", F.xxhash64("item_id", "item_text"))
        asked = rows.withColumn("doc", F.xxhash64("doc_id", "text"))
        left = asked.select("doc", "text").mapInArrow(seed_rows("doc", "text"), "seed long, doc long, doc_at int")
        right = keyed.select("item", "item_text").mapInArrow(seed_rows("item", "item_text"), "seed long, item long, item_at int").distinct()
        # a pair has as many diagonals as both texts have tokens, at most; its texts move once
        hits = left.join(right, "seed").select("doc", "item", (F.col("doc_at") - F.col("item_at")).alias("offset")).distinct().groupBy("doc", "item").agg(F.collect_list("offset").alias("offsets"))

        def check(batches):
            for t in batches:
                d, i = tokens(t["text"]), tokens(t["item_text"])
                out = []
                for k, (doc, item, offsets) in enumerate(zip(*(t[c].to_pylist() for c in ("doc_id", "item_id", "offsets")))):
                    one, other = d.hashes[d.first[k] : d.first[k + 1]], i.hashes[i.first[k] : i.first[k + 1]]
                    for a, b, start, equal in {ok for offset in offsets if (ok := verify(one, other, offset, masks, *limits))}:
                        out.append((doc, item, equal, len(other), a, b, start))
                yield table(out)

        met = hits.join(asked, "doc").join(keyed, "item").select("doc_id", "item_id", "offsets", "text", "item_text").mapInArrow(check, found)
    best = F.max_by(F.struct("n_matched", "n_item", "doc_start", "doc_end", "item_start"), F.struct("n_matched", -F.col("doc_start"), -F.col("item_start"))).alias("best")
    return met.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
