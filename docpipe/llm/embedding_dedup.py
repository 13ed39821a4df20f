"""Embedding near-duplicates: tiles of vectors, compared pair by pair as matrices.

Vectors are dealt into tiles of some thousands, a row each, which are written once. Every
pair of tiles meets in a task (a cartesian product: tasks read the tiles from the shared
folder, so nothing is replicated by a shuffle), and a pair of tiles is one matrix product.
So disk grows with the vectors, and time with the square of their number, at about a
nanosecond a pair. (Cells of a grid need less time in theory, but 64 to 2,048 rows a vector.)

Unit vectors of cosine t or more are at most 2 (1 - t) apart in squared distance, over all
dimensions and so over any part of them. A fixed rotation spreads their energy evenly, so
the first half of its dimensions drops nearly every pair that is far apart, in single
precision with some slack; what is left is decided by exact cosines in double precision.

A pair of tiles returns no links but sums: for each vector how many others it links with,
and the smallest one that links within both tiles reach. A dense cluster thus has rows in
proportion to its vectors and tiles. Equal vectors are one class from the start.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import components, cut

BLOCK = 8
#: Vectors in a tile, and tiles in a file, which a task holds.
TILE, TILES = 4096, 16
_SLACK = 1e-5  # squared distance, in single precision


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int) -> list[tuple[int, int]]:
    n = max(1, dim // BLOCK)
    edge = [round(k * dim / n) for k in range(n + 1)]
    return list(zip(edge[:-1], edge[1:]))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _tiles(crowd: int, kind: type):
    """Rows (dim, tile, ids, weights, vectors) of up to ``crowd`` vectors of one length each."""

    def tiles(batches):
        task, n, held = TaskContext.get().partitionId(), 0, {}

        def tile(dim, t):
            parts = (np.asarray(t["cls"]), np.asarray(t["weight"]), _matrix(t["embedding"], dim).astype(kind))
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "tile": [task << 32 | n], **{c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(("ids", "weights", "vectors"), parts)}})

        for t in batches:
            sizes = np.asarray(t["dim"])
            for dim in map(int, np.unique(sizes)):
                own = pa.Table.from_batches([*held.pop(dim, []), t.filter(pa.array(sizes == dim))])
                while own.num_rows >= crowd:
                    yield tile(dim, own.slice(0, crowd))
                    own, n = own.slice(crowd), n + 1
                held[dim] = own.to_batches()
        for dim, rest in held.items():
            if rest:
                yield tile(dim, pa.Table.from_batches(rest))
                n += 1

    return tiles


def _join(low: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Makes ``low``, the least member of each vector's component so far, hold links i, j too."""
    while len(apart := np.flatnonzero(low[i] != low[j])):
        i, j = i[apart], j[apart]
        x, y = low[i], low[j]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low[:] = low[low]


def _compare(threshold: float, kind: type):
    """Rows (a, b, others) of pairs of tiles: a vector, the least one it reaches, its links."""

    def side(row: dict, x: str, dim: int, minus: bool):
        unit_ = unit(np.frombuffer(row[f"vectors_{x}"], kind).reshape(-1, dim).astype(np.float64))
        edges = block_edges(dim)
        y = unit_ @ rotation(dim)[:, : edges[(len(edges) - 1) // 2][1]]
        square, one = np.einsum("ij,ij->i", y, y)[:, None], np.ones((len(y), 1))
        # the product of two such rows is the squared distance
        lead = np.concatenate([-2 * y, square, one] if minus else [y, one, square], axis=1).astype(np.float32)
        return np.frombuffer(row[f"ids_{x}"], np.int64), np.frombuffer(row[f"weights_{x}"], np.int64).astype(np.float64), unit_, lead

    def compare(batches):
        budget, last = np.float32(2 * (1 - threshold) + _SLACK), None
        for t in batches:
            ids, least, others = ([np.zeros(0, np.int64)] for _ in range(3))
            for r in range(t.num_rows):
                row = {c: t[c][r].as_py() for c in ("dim", "tile_a", "tile_b")} | {c: t[c][r].as_buffer() for c in t.schema.names if pa.types.is_binary(t[c].type)}
                dim, same = row["dim"], row["tile_a"] == row["tile_b"]
                if last is None or last[0] != (dim, row["tile_a"]):
                    last = (dim, row["tile_a"]), side(row, "a", dim, True)
                id_a, weight_a, a, lead_a = last[1]
                id_b, weight_b, b, lead_b = side(row, "b", dim, False)
                lead_b = np.ascontiguousarray(lead_b.T)
                at, n = (0, len(a)) if same else (len(a), len(a) + len(b))
                name = np.sort(id_a if same else np.concatenate([id_a, id_b]))
                place = np.searchsorted(name, id_a if same else np.concatenate([id_a, id_b]))
                low, count = np.arange(n), np.zeros(n)
                for lo in range(0, len(a), 256):
                    near = lead_a[lo : lo + 256] @ lead_b
                    if near.min() > budget:
                        continue
                    near = near <= budget
                    i, j = lo + np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                    ok = a[i] @ b[j].T >= threshold
                    if same:
                        ok &= i[:, None] != j
                    count[i] += ok @ weight_b[j]
                    if not same:
                        count[at + j] += weight_a[i] @ ok
                    u, v = np.nonzero(ok)
                    _join(low, place[i[u]], place[at + j[v]])
                found = np.flatnonzero(count)
                ids.append(name[place[found]])
                least.append(name[low[place[found]]])
                others.append(np.rint(count[found]).astype(np.int64))
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(ids), "b": np.concatenate(least), "others": np.concatenate(others)})

    return compare


def near_links(classes: DataFrame, threshold: float, crowd: int = TILE) -> DataFrame:
    """Rows a, b, others of classes (cls, dim, embedding, weight) that link with others.

    Classes link if their cosine is ``threshold`` or more. The sum of ``others`` over a
    class's rows is the weight of all classes that it links with; links a, b connect what
    links connect. Tiles have up to ``crowd`` classes.
    """
    kind = np.float32 if classes.schema["embedding"].dataType.elementType == T.FloatType() else np.float64
    files = max(classes.sparkSession.sparkContext.defaultParallelism, -(-classes.count() // (crowd * TILES)))
    rows = classes.select("cls", "dim", "weight", "embedding").repartition(files)
    tiles = cut(rows.mapInArrow(_tiles(crowd, kind), "dim int, tile long, ids binary, weights binary, vectors binary"))
    left, right = (tiles.select(F.col("dim").alias(f"dim_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in ("tile", "ids", "weights", "vectors"))) for x in "ab")
    # of two tiles each comes first as often as the other, so tasks are even
    even = F.pmod(F.xxhash64(F.least("tile_a", "tile_b"), F.greatest("tile_a", "tile_b")), F.lit(2)) == 0
    once = F.when(even, F.col("tile_a") <= F.col("tile_b")).otherwise(F.col("tile_a") >= F.col("tile_b"))
    pairs = left.join(right.hint("shuffle_replicate_nl"), (F.col("dim_a") == F.col("dim_b")) & once).withColumnRenamed("dim_a", "dim").drop("dim_b")
    return pairs.mapInArrow(_compare(threshold, kind), "a long, b long, others long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows with a cosine of ``threshold`` or more to it. Null,
    empty and zero vectors, and those with null or non-finite components, link with
    nothing and are kept. Vectors of different lengths do not link. Rows with equal
    vectors link with each other, also where ids repeat; rows of a null id count as links
    of others and name no component. Other columns are ignored; an empty table gives an
    empty result.
    """
    x = F.col("embedding")
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable").select("vec_id", "embedding")
    # rows find their class by a 128-bit digest of the vector, which moves less than vectors do
    digest = [F.xxhash64("embedding").alias("cls"), F.xxhash64(F.lit(1), "embedding").alias("more")]
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    classes = cut(classes.select("*", F.size("embedding").alias("dim"), *digest))
    links = cut(near_links(classes, threshold))
    linked = links.groupBy("a").agg(F.sum("others").alias("others"))
    part = components(links)
    named = classes.join(part, classes.cls == part.node, "left").select("cls", "more", "least", "weight", F.coalesce("component", "cls").alias("component"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(names, "component").join(linked, named.cls == linked.a, "left")
    facts = facts.select("cls", "more", "component_id", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    found = good.select("vec_id", *digest).join(facts, ["cls", "more"]).select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
