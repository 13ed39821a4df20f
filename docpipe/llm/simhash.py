"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints at most two bits apart differ in at most two of their eight
bytes, so they share at least six positional bytes: the guaranteed minimum. Lists of
single positional bytes would hold a 256th of all fingerprints each, so the index holds
their intersections, four bytes at a time: a list for each choice of four positions and
each value of their bytes. A pair that shares m positional bytes meets in C(m, 4) of these
70 choices, so the tally of its meetings tells m, and pairs tallied below C(6, 4) = 15 go.
The others are verified bit by bit.

A list longer than ``list_limit`` would make a pair count square in its length; further
bytes would not split it, as it holds close variants of one text. Its members are linked in
another exact way: fingerprints are at most two bits apart just if they share a value among
themselves and their 64 one-bit neighbours, so each member contributes 65 rows and every
value links its members to its smallest one. A fingerprint in no such list has all its
lists tallied, so either way is whole.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import components, cut, merged, utf8

#: Positional bytes that two fingerprints within two bits of each other share.
SHARED_BYTES = 6
MAX_BITS = 2
#: Positional bytes that a list of the index intersects.
TOGETHER = 4


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of one text's bytes: A-Z lower-cased, word shingles hashed by XXH64."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stop = np.cumsum(size) - 1
    start = stop - size + 1
    if len(words) > width:
        start, stop = start[: len(words) - width + 1], stop[width - 1 :]
    else:
        start, stop = start[:1], stop[-1:]
    ones, n = np.zeros(64, np.int64), len(start)
    for at in range(0, n, 1 << 14):
        spans = zip(start[at : at + (1 << 14)].tolist(), stop[at : at + (1 << 14)].tolist())
        digests = b"".join([xxhash.xxh64_digest(joined[a:b], seed) for a, b in spans])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id and fp, the fingerprint as a signed 64-bit integer."""

    def per_batch(batches):
        for t in batches:
            buf, off = utf8(t["text"])
            fps = [fingerprint(buf[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_pydict({"doc_id": t["doc_id"], "fp": pa.array(np.array(fps, np.uint64).view(np.int64))})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(per_batch, "doc_id long, fp long")


def positions() -> list[int]:
    """Masks of all choices of ``TOGETHER`` of the eight bytes, as signed 64-bit integers."""
    masks = [sum(0xFF << 8 * k for k in chosen) for chosen in combinations(range(8), TOGETHER)]
    return [m - (1 << 64 if m >> 63 else 0) for m in masks]


def near_links(fps: DataFrame, list_limit: int = 64) -> DataFrame:
    """Links a, b that connect all distinct fingerprints (column fp) within two bits.

    Every returned link is within two bits or joins members of one component; every
    pair within two bits is connected by returned links.

    Joins are sort merge joins by hint: Spark takes a table of 70 or 65 rows a fingerprint for
    no larger than the fingerprints, and would broadcast it whole through the driver.
    """
    index = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in positions()))).alias("which", "bytes"))
    lists = index.groupBy("which", "bytes").count().where("count > 1")
    index = cut(index.join(lists.hint("merge"), ["which", "bytes"]))

    crowded = index.groupBy("fp").agg(F.max("count").alias("most")).where(F.col("most") > list_limit).select("fp")
    short = index.where(F.col("count") <= list_limit)
    left, right = short.select("which", "bytes", F.col("fp").alias("a")), short.select("which", "bytes", F.col("fp").alias("b"))
    tally = left.join(right.hint("merge"), ["which", "bytes"]).where("a < b").groupBy("a", "b").count()
    pairs = tally.where(F.col("count") >= comb(SHARED_BYTES, TOGETHER))
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b")

    flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << 64 if k == 63 else 0))) for k in range(64)))
    spread = crowded.select("fp", F.explode(flips).alias("value"))
    least = spread.groupBy("value").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most").select("value", "b")
    stars = spread.join(least.hint("merge"), "value").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return pairs.union(stars)


def duplicate_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", list_limit: int = 64) -> DataFrame:
    """Links a, b between ids that connect what ``near_duplicates`` puts in one component.

    For callers that add links of their own before they ask for components. Rows without an
    id take part in no link; otherwise rows are treated as ``near_duplicates`` treats them.
    """
    of = cut(fingerprints(docs, doc_id, text).where("doc_id is not null"))
    classes = cut(of.groupBy("fp").agg(F.min("doc_id").alias("b")))
    equal = of.join(merged(classes), "fp").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
    sides = [classes.select(F.col("fp").alias(f"fp_{x}"), F.col("b").alias(x)) for x in "ab"]
    close = near_links(classes.select("fp"), list_limit).toDF("fp_a", "fp_b").join(merged(sides[0]), "fp_a").join(merged(sides[1]), "fp_b")
    return equal.union(close.select("a", "b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", list_limit: int = 64) -> DataFrame:
    """One row for each document: doc_id, fp, component_id (smallest id reachable).

    Null, empty and blank texts have fingerprint zero and are linked like any other.
    Equal texts have equal fingerprints; rows may repeat. A null id takes part but names
    no component unless its component holds nothing else; then component_id is null.
    Other columns are ignored; an empty table gives an empty result.
    """
    of = cut(fingerprints(docs, doc_id, text))
    classes = of.groupBy("fp").agg(F.min("doc_id").alias("least"))
    part = components(near_links(classes.select("fp"), list_limit))
    joined = cut(classes.join(part, classes.fp == part.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component")))
    name = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(name, "component").select("fp", "component_id")
    return of.join(named, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
