"""Near copies by word shingles: every pair of texts above a Jaccard similarity is connected.

Two sets that share enough of their members share one among the first few of each, in
whatever order all sets agree on (prefix filtering), so texts that meet in no list of an
index over these first members are no near copies. Members that many texts of a sample have
come last in that order, which keeps lists short.

Only what connects is asked for, and most of it is found beforehand: texts whose least hashes
agree in one of ``BANDS`` bands are verified against the most central text of their band: the
one whose bands hold most texts in all, as an original's do among its changed copies. So large
groups of copies are one component, in rows that grow with the texts, before the index is
looked at, and it only proposes pairs of different components: first the one whose signature
is closest to a text's, then, of texts still apart, every other. Common phrases bring texts
together that are far from alike, so each entry carries a signature of its whole text, and
pairs whose signatures differ in more bits than those of near copies do go before they leave
their list (a near copy is lost that way once in 10^9). Two texts that share many lists are
proposed by one of them only: that of their least first member, if both have the same one by
one of two orders. Every pair that counts is verified on
the texts themselves.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .shared import Words, ascii_lower, components, cut, digest_at, merged, mix, ngram_hashes, sent, trim

_U = np.uint64
#: Bytes of text sampled for the order of shingles, and most shingles that it knows of.
SAMPLE_BYTES, MOST_KNOWN = 64 << 20, 500_000
#: Bands of least hashes, and hash ranges in each.
BANDS, BAND = 16, 8
#: A shingle that so many texts of the sample have gets a list for each class of sizes.
FREQUENT = 64
#: Bits of a signature, and how likely near copies are to differ in more bits than ``limits`` allows.
BITS, LOSS = 128, 1e-9
_SLACK = 1e-9
#: An entry of the index: a shingle, its text, the component so far, the set's size, the place in it, the signature,
#: the least first member by two orders, and by which of them (bits) the shingle is that.
ENTRY = {"token": pa.int64(), "id": pa.int64(), "part": pa.int64(), "size": pa.int32(), "at": pa.int32(), "s": pa.int64(), "t": pa.int64(), "m": pa.int64(), "w": pa.int64(), "own": pa.int8()}
SALTS = (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47)


def sets(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts' distinct shingles, A-Z lower-cased: text numbers and hashes, both in order.

    A text of fewer words than ``width`` is one shingle; one without words has none.
    """
    words = Words(column)
    number = np.repeat(np.arange(len(words.counts)), words.counts)
    left = np.repeat(words.first[1:], words.counts) - np.arange(len(words.hashes))
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    for k in range(1, width + 1):
        at = words.first[:-1][words.counts == k] if k < width else np.flatnonzero(left >= width)
        if len(at):
            owners.append(number[at])
            hashes.append(ngram_hashes(words.hashes, k, k)[at])
    owner, h = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return owner[new], h[new]


def _parts(batches, rows: int = 2000):
    for t in batches:
        for lo in range(0, t.num_rows, rows):
            yield t.slice(lo, rows)
    trim()


def _frequent(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several texts of a sample of bounded size, in order, and how many texts."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, SAMPLE_BYTES / max(total, 1))

    def per_batch(batches):
        for t in _parts(batches):
            yield pa.RecordBatch.from_pydict({"h": pa.array(sets(t["text"], width)[1].view(np.int64))})

    some = rows.where(digest_at(F.col("id")) < share).mapInArrow(per_batch, "h long")
    got = some.groupBy("h").count().where("count >= 4").orderBy(F.desc("count"), "h").limit(MOST_KNOWN).toArrow()
    h, n = got["h"].to_numpy().astype(np.int64).view(_U), got["count"].to_numpy().astype(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _may(size_a, at_a, size_b, at_b, share: float):
    """Whether sets that first meet at these positions can be similar enough."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    most = np.minimum(size_a - at_a, size_b - at_b)
    return (small >= share * large - _SLACK) & (most >= share / (1 + share) * (size_a + size_b) - _SLACK)


def signatures(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """One row of two 64-bit numbers for each of ``n`` sets in order, as ``sets`` gives them.

    The hashes of a set fall into ``BITS`` equal ranges; a range's bit is the last one of its
    least hash, or zero if it is empty. Where two sets have a hash in a range at all, the least
    of both is in both with the probability of their similarity, otherwise bits agree by chance.
    """
    at = owner * BITS + (h >> _U(64 - 7)).astype(np.int64)
    first = np.ones(len(h), bool)
    first[1:] = at[1:] != at[:-1]
    bits = np.zeros(n * BITS, np.uint8)
    bits[at[first]] = (h[first] & _U(1)).astype(np.uint8)
    return np.packbits(bits.reshape(n, BITS), axis=1).view(np.int64)


def bands(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """``BANDS`` keys for each of ``n`` sets, none of them empty, by the least hash of each range.

    An empty range has the next one's that is not, changed by how far that is.
    """
    at = owner * BITS + (h >> _U(64 - 7)).astype(np.int64)
    first = np.ones(len(h), bool)
    first[1:] = at[1:] != at[:-1]
    least = np.zeros(n * BITS, _U)
    least[at[first]] = h[first]
    least = np.tile(least.reshape(n, BITS), 2)
    where = np.where(np.tile(np.bincount(at[first], minlength=n * BITS).reshape(n, BITS) > 0, 2), np.arange(2 * BITS), 2 * BITS)
    nearest = np.minimum.accumulate(where[:, ::-1], axis=1)[:, ::-1][:, :BITS]
    value = np.take_along_axis(least, nearest, axis=1) + (nearest - np.arange(BITS)).astype(_U) * _U(0x9E3779B97F4A7C15)
    value = value.reshape(n, BANDS, BAND)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U), (n, BANDS))
    for k in range(BAND):
        key = mix(key * _U(0x5851F42D4C957F2D) + value[:, :, k])
    return key


def limits(share: float) -> np.ndarray:
    """By the number of ranges in use: the most bits in which signatures of near copies differ."""
    p, found = (1 - share) / 2, []
    for m in range(BITS + 1):
        chance = np.array([comb(m, k) * p**k * (1 - p) ** (m - k) for k in range(m + 1)])
        more = np.append(np.cumsum(chance[::-1])[::-1][1:], 0.0)
        found.append(int(np.argmax(more < LOSS)))
    return np.array(found)


def _lists(batches, least_rows: int = 200_000):
    """Tables of whole lists: (columns, first row of each list and the end), from sorted rows."""
    held, n = [], 0

    def table():
        t = pa.Table.from_batches(held).combine_chunks()
        columns = {c: t[c].to_numpy(zero_copy_only=False) for c in t.column_names}
        token = columns["token"]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]])) if len(token) else np.zeros(1, np.int64)
        return t, columns, first

    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= least_rows:
            t, columns, first = table()
            if len(first) > 2:
                yield columns, first[:-1]
            rest = t.slice(int(first[-2]))
            held, n = rest.to_batches(), 0
    if held:
        _, columns, first = table()
        yield columns, first
    trim()


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.8, width: int = 5, list_limit: int = 64, banded: bool = True) -> DataFrame:
    """Links a, b between ids. Texts are near copies if the Jaccard similarity of their
    ``width``-word shingles is ``share`` or more; links connect just those ids that a chain
    of near copies connects. ``banded`` and ``list_limit`` only choose the way there.

    Null, empty and blank texts are near copies of nothing. Rows without an id are left out;
    other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("id is not null and text is not null")

    # equal texts: one of each goes on
    plain = ascii_lower(F.col("text"))
    named = cut(rows.select("id", F.xxhash64(plain).alias("u"), F.xxhash64(plain, F.lit(1)).alias("v")))
    least = named.groupBy("u", "v").agg(F.min("id").alias("b"), F.max("id").alias("most")).where("b < most").select("u", "v", "b")
    equal = cut(named.join(merged(least), ["u", "v"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct())
    gone = equal.select(F.col("a").alias("id"))
    rows = rows.join(sent(gone), "id", "left_anti")
    rows = cut(rows) if gone.count() > shared.MOST_SENT else rows  # texts that had to move do so once
    known, often = _frequent(rows, width)
    trim()
    differ = limits(share)

    def near(c, i, j):
        """Whether entries i and j of a list may belong to near copies and are this list's to propose, and their signatures' distance."""
        bits = sum(np.bitwise_count((c[x][i] ^ c[x][j]).view(_U)).astype(np.int64) for x in "st")
        used = np.minimum(c["size"][i].astype(np.int64) + c["size"][j], BITS)
        may = _may(c["size"][i], 0, c["size"][j], 0, share) & (bits <= differ[used])
        # positions bound what is left only where texts meet first, which need not be in the list that proposes them
        meets = _may(c["size"][i], c["at"][i], c["size"][j], c["at"][j], share)
        both = c["own"][i] & c["own"][j]
        mine = np.where(c["m"][i] == c["m"][j], (both & 1) > 0, np.where(c["w"][i] == c["w"][j], (both & 2) > 0, meets))
        return may & mine, bits

    def band_keys(batches):
        for t in _parts(batches):
            owner, h = sets(t["text"], width)
            some = np.unique(owner)
            keys = bands(np.searchsorted(some, owner), h, len(some))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), t["id"].take(pa.array(np.repeat(some, BANDS)))], names=["key", "id"])

    def first_members(batches):
        for t in _parts(batches):
            owner, h = sets(t["text"], width)
            sign = signatures(owner, h, t.num_rows)
            at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            rank = np.where(known[at] == h, often[at], 0) if len(known) else np.zeros(len(h), np.int64)
            order = np.lexsort((rank, owner))
            h, rank = h[order], rank[order]
            size = np.bincount(owner, minlength=t.num_rows)
            place = np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
            most = size - np.ceil(share * size - _SLACK).astype(np.int64) + 1
            keep = np.flatnonzero(place < most[owner])
            # near copies' sizes fall into one class or two that follow each other
            classes = np.floor(np.log(np.maximum(size[owner[keep]], 1)) / -np.log(share) + _SLACK).astype(np.int64) if share < 1 else size[owner[keep]]
            starts = np.flatnonzero(np.concatenate([[True], owner[keep][1:] != owner[keep][:-1]])) if len(keep) else np.zeros(0, np.int64)
            orders = [mix(h[keep] ^ _U(x)) for x in SALTS]
            least = [np.repeat(np.minimum.reduceat(x, starts), np.diff(np.append(starts, len(keep)))) if len(keep) else x for x in orders]
            own_bits = sum(((x == y).astype(np.int8) << k for k, (x, y) in enumerate(zip(orders, least))), np.zeros(len(keep), np.int8))
            often_here = rank[keep] >= FREQUENT
            twice = np.concatenate([np.arange(len(keep)), np.flatnonzero(often_here)])
            least, own_bits = [x[twice] for x in least], own_bits[twice]
            keep, classes = keep[twice], np.concatenate([np.where(often_here, classes, -1), classes[often_here] + 1])
            token = np.where(classes < 0, h[keep], mix(h[keep] + classes.astype(_U) * _U(0x9E3779B97F4A7C15)))
            own = owner[keep]
            took = lambda c: t[c].take(pa.array(own))
            values = {"token": token.view(np.int64), "id": took("id"), "part": took("part"), "size": size[own].astype(np.int32), "at": place[keep].astype(np.int32), "s": sign[own, 0], "t": sign[own, 1], "m": least[0].view(np.int64), "w": least[1].view(np.int64), "own": own_bits}
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) if isinstance(v, np.ndarray) else v for v, kind in zip(values.values(), ENTRY.values())], names=list(ENTRY))

    def propose(batches):
        for c, first in _lists(batches):
            ids, size, part, n = c["id"], c["size"], c["part"], np.diff(first)
            mixed = np.zeros(len(n), bool)
            if len(n):
                mixed = np.minimum.reduceat(part, first[:-1]) != np.maximum.reduceat(part, first[:-1])
            found = [np.zeros((3, 0), np.int64)]

            def keep(i, j):
                ok, bits = near(c, i, j)
                ok &= part[i] != part[j]
                a, b = ids[i[ok] if isinstance(i, np.ndarray) else np.full(int(ok.sum()), i)], ids[j[ok]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b), bits[ok]]))

            for m in np.unique(n[mixed & (n <= list_limit)]):
                i, j = np.triu_indices(m, 1)
                start = first[:-1][mixed & (n == m)][:, None]
                keep((start + i).ravel(), (start + j).ravel())
            for k in np.flatnonzero(mixed & (n > list_limit)):
                lo, hi = first[k], first[k + 1]
                for i in range(lo, hi):  # sizes rise along a list: what may be near is one run of it
                    keep(i, np.arange(i + 1, lo + np.searchsorted(size[lo:hi], size[i] / share + _SLACK, "right")))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[0]), "b": pa.array(pairs[1]), "bits": pa.array(pairs[2])})

    def verify(batches):
        for t in _parts(batches, 500):
            (oa, ha), (ob, hb) = sets(t["text_a"], width), sets(t["text_b"], width)
            owner, h = np.concatenate([oa, ob]), np.concatenate([ha, hb])
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            both = np.bincount(owner[1:][(owner[1:] == owner[:-1]) & (h[1:] == h[:-1])], minlength=t.num_rows)
            ok = both >= share * (np.bincount(owner, minlength=t.num_rows) - both) - _SLACK
            yield t.select(["a", "b"]).filter(pa.array(ok))

    def verified(pairs):
        wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        texts = rows.join(sent(wanted), "id", "left_semi").dropDuplicates(["id"])
        sides = [texts.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"]
        joined = pairs.join(merged(sides[0]), "a").join(merged(sides[1]), "b").select("a", "b", "text_a", "text_b")
        return cut(joined.mapInArrow(verify, "a long, b long"))

    # most of what connects: texts that agree in a band, each with the band's most central text
    keyed = cut((rows if banded else rows.limit(0)).mapInArrow(band_keys, "key long, id long"))
    common = cut(keyed.join(merged(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")), "key"))
    scored = common.join(merged(common.groupBy("id").agg(F.sum("n").alias("score"))), "id").select("key", "id", "score")
    hubs = scored.groupBy("key").agg(F.max_by("id", F.struct("score", "id")).alias("a"))
    links = verified(cut(common.join(merged(hubs), "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()))
    part = cut(components(links))
    of = lambda x: part.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}"))

    # the rest: pairs of different components that share a list
    labelled = rows.join(sent(of("id")), "id", "left").select("id", "text", F.coalesce("part_id", "id").alias("part"))
    index = labelled.mapInArrow(first_members, "token long, id long, part long, size int, at int, s long, t long, m long, w long, own byte")
    index = index.repartition("token").sortWithinPartitions("token", "size", "id")
    pairs = cut(index.mapInArrow(propose, "a long, b long, bits long").groupBy("a", "b").agg(F.min("bits").alias("bits")))
    best = cut(pairs.groupBy("b").agg(F.min_by("a", F.struct("bits", "a")).alias("a")))
    links = links.union(verified(best))
    part = cut(components(links))
    apart = pairs.join(merged(of("a")), "a", "left").join(merged(of("b")), "b", "left").where("coalesce(part_a, a) <> coalesce(part_b, b)").select("a", "b")
    rest = cut(apart.join(merged(best), ["a", "b"], "left_anti"))
    return links.union(verified(rest)).union(equal)
