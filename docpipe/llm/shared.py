"""Pieces that several operators share: shared folder, tokens, tallies, components."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20


# --- shared folder -----------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from ``spark.checkpoint.dir``. Only a local master, where there is
    but one machine, gets a folder of its own when that is unset.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="docpipe-")
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir().rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already; the folder is scratch space
        pass


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there.

    Losing an executor later costs nothing, as the files are not on executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docpipe-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


# --- joins -------------------------------------------------------------------

#: Most rows of numbers that a join may broadcast, about 17 MB as a table of hashes.
MOST_SENT = 250_000


def merged(df: DataFrame) -> DataFrame:
    """``df`` for a sort merge join, whatever size Spark takes it for.

    For tables that grow with the input: below its threshold, which is 10 MB of a file or a
    shuffle, Spark would build a table of hashes several times as large in the driver, and
    keep it there until the driver happens to collect its garbage.
    """
    return df.hint("merge")


def sent(df: DataFrame) -> DataFrame:
    """A written table of numbers for a join with texts, which stay where they are up to ``MOST_SENT`` rows."""
    return F.broadcast(df) if df.count() <= MOST_SENT else merged(df)


# --- columns -----------------------------------------------------------------


def crc_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(F.encode(text, "UTF-8")) % n).cast("int")


def crc_mod_py(doc_id, n: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups_for(df: DataFrame, text: str = "text", group_mb: int = 24, least: int = 64) -> int:
    """How many groups the texts are dealt into so that one holds about ``group_mb``."""
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return int(max(least, -(-total // (group_mb << 20))))


def settled(df: DataFrame, spread: bool = False) -> DataFrame:
    """Rows that come in the same order whenever they are read: ``df``, written first if it shuffles.

    ``spread`` also writes a table of fewer partitions than there are cores, dealt to all cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        return cut(df.repartition(cores))
    return cut(df) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def chunk_numbers(text, before: int, size: int) -> tuple[np.ndarray, int]:
    """Which chunk of about ``size`` bytes each text of a batch falls into, and the bytes so far.

    It depends on the texts before in the partition, not on how they come in batches.
    """
    off = utf8(text)[1]
    return (before + off[:-1]) // size, before + int(off[-1])


def dealt(df: DataFrame, key: str, groups: int, each: int = 4) -> DataFrame:
    """Rows dealt by ``key``, about ``each`` groups a task, where the session's setting would make them more."""
    n = -(-groups // each)
    return df.repartition(n, key) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def digest_at(*of: Column) -> Column:
    """Place of a row in the order of digests, from 0 to 1."""
    return F.xxhash64(*of, F.lit("sample")).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))


def choose(kind: Column, by: dict, none: float) -> Column:
    """The number that ``by`` has for a kind."""
    return F.coalesce(*(F.when(kind == F.lit(k), F.lit(float(v))) for k, v in by.items()), F.lit(none))


def size_caps(slim: DataFrame, budget: int) -> dict:
    """For each kind: the size up to which texts count for a sample of ``budget`` bytes.

    A sixteenth of the budget where texts up to that hold half of it, so that a sample has
    many texts; else that doubled until they do, or until it holds all texts of the kind.
    """
    least = max(budget // 16, 1)
    level = F.greatest(F.ceil(F.log2(F.col("_size") / F.lit(float(least)))), F.lit(0)).cast("int")
    sums = slim.where(F.col("_kind").isNotNull()).groupBy("_kind", F.when(F.col("_size") > least, level).otherwise(0).alias("level")).agg(F.sum("_size").alias("bytes")).collect()
    caps = {}
    for kind in {r["_kind"] for r in sums}:
        room = budget // 2
        for r in sorted((r for r in sums if r["_kind"] == kind), key=lambda r: r["level"]):
            if room > 0:
                caps[kind] = least << r["level"]
            room -= r["bytes"]
    return caps


def digest_limits(slim: DataFrame, budget: int, caps: dict | None = None) -> tuple[dict, dict]:
    """For each kind: up to which place texts fit in ``budget`` bytes, and its rows.

    ``slim`` has a row for each text: _at (its ``digest_at``), _kind, _size. Limits come from
    byte counts of at most 4096 digest ranges a kind, over all rows; rows of one digest count
    once. Texts above their kind's cap (``size_caps``; a sixteenth of the budget where it is
    not given) do not count: a sample must leave them out. With caps, a kind whose every text
    is longer than the budget still has one of them.
    """
    slim = slim.where(F.col("_kind").isNotNull()).groupBy("_kind", "_at").agg(F.max("_size").alias("_size"), F.count("*").alias("_n"))
    slim = cut(slim)
    facts = slim.groupBy("_kind").agg(F.sum("_size").alias("bytes"), F.sum("_n").alias("n")).collect()
    share = {r["_kind"]: min(1.0, 1.5 * budget / max(r["bytes"], 1)) for r in facts}
    if not facts:
        return {}, {}
    at, kind = F.col("_at"), F.col("_kind")
    fits = F.col("_size") <= (choose(kind, caps, 0.0) if caps else budget // 16)
    small = slim.where(fits & (at < choose(kind, share, 0.0)))
    ranges = small.groupBy("_kind", F.floor(at / choose(kind, share, 1.0) * 4096).cast("int").alias("part")).agg(F.sum("_size").alias("bytes")).collect()
    limit = {}
    for k in share:
        room, limit[k] = budget, 0.0
        for r in sorted((r for r in ranges if r["_kind"] == k), key=lambda r: r["part"]):
            room -= r["bytes"]
            if room < 0:
                break
            limit[k] = (r["part"] + 1) / 4096 * share[k]
    if caps and (none := [k for k in share if not limit[k]]):
        firsts = slim.where(fits & kind.isin(none)).groupBy("_kind").agg(F.min("_at").alias("first")).collect()
        limit |= {r["_kind"]: float(np.nextafter(r["first"], 2.0)) for r in firsts}
    return limit, {r["_kind"]: r["n"] for r in facts}


# --- tokens ------------------------------------------------------------------

_POWERS: list = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int):
    if len(_POWERS[0]) < n + 1:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(max(n, _CHUNK) + 1, b, _U)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=_U)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column, one after the other, and the texts' offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


class Words:
    """Words of a column of texts: 64-bit hashes, byte spans and words per text.

    ``breaks`` tells for each of 256 bytes whether it stands between words.
    """

    def __init__(self, column, lower: bool = True, breaks: np.ndarray = _SPACE):
        buf, off = utf8(column)
        buf = _LOWER[buf] if lower else buf
        word = ~breaks[buf]
        before, after = np.zeros_like(word), np.zeros_like(word)
        before[1:], after[:-1] = word[:-1], word[1:]
        edges = off[(off > 0) & (off < len(buf))]
        before[edges] = False
        after[edges - 1] = False
        self.buf, self.off = buf, off
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, off)
        self.counts = np.diff(self.first)
        self.hashes = _hash_spans(buf, self.starts, self.ends)

    def text(self, i: int) -> bytes:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes()


def _hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK)))
        at, n = starts[i], int(ends[j - 1] - starts[i])
        up, down = _powers(n)
        total = np.zeros(n + 1, _U)
        np.cumsum((buf[at : at + n].astype(_U) + _U(1)) * up[:n], out=total[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def word_hash(word: bytes) -> int:
    """The hash that ``Words`` gives to a single word."""
    n = len(word)
    return int(_hash_spans(np.frombuffer(word, np.uint8), np.array([0]), np.array([n]))[0])


def ngram_hashes(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of n entries of ``h``; text borders are the caller's affair."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    acc = np.full(m, salt, _U)
    for k in range(n):
        acc = acc * _U(0x5851F42D4C957F2D) + h[k : k + m]
    return mix(acc)


# --- tallies over groups and buckets -----------------------------------------
# A tally asks one question about each of very many keys ("how often in all groups?")
# without moving a row for each occurrence. Documents are dealt into groups; a group
# sends every distinct key once, to the bucket that owns the key's range; the bucket
# answers in the order of the question. However frequent a key is, it is one entry a
# group, so no bucket is larger than others. Keys are sorted and sent by byte planes,
# whose upper ones all but vanish under Spark's compression.


def planes(x: np.ndarray, n: int = 8) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def unplane(data: bytes, n: int = 8) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(n, -1)
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, :n] = rows.T
    return out.view("<u8").ravel()


def slices(keys: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """The buckets that own some of the sorted keys, each with its keys' place.

    Buckets without keys are left out, so a group's entries never outnumber its keys,
    however many buckets there are.
    """
    if not len(keys):
        return []
    owner = ((keys >> _U(32)) * _U(buckets)) >> _U(32)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return [(int(owner[i]), slice(int(i), int(j))) for i, j in zip(first, [*first[1:], len(keys)])]


def signed(x: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones of the same order."""
    return x.astype(np.int64).view(_U) ^ _U(1 << 63)


def trim() -> None:
    """Give freed memory back to the system: a worker's next tasks, or other workers, need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


# --- connected components ----------------------------------------------------


#: Most nodes, but for one batch, that a task holds when it turns links into stars.
STAR_NODES = 500_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from each linked node: columns node, component.

    ``links`` holds pairs of 64-bit integers. Large-star and small-star rounds run until
    nothing changes. Before and after the links meet in a shuffle, at the start and in each
    round, every partition replaces its own links by spanning stars, ``STAR_NODES`` nodes at a
    time, which changes no component and saves rounds. Every step is an aggregate or a join
    on even keys, each round's links are written to the shared folder, and none are
    gathered in one place. Links from a node to itself and nulls are left out.
    """

    def contract(batches):
        parent: dict[int, int] = {}

        def root(x):
            while (p := parent.get(x, x)) != x:
                parent[x] = parent.get(p, p)
                x = p
            return x

        def stars():
            found = [(x, r) for x in parent if (r := root(x)) != x]
            parent.clear()
            return pa.RecordBatch.from_pydict({"u": pa.array([x for x, _ in found], pa.int64()), "v": pa.array([r for _, r in found], pa.int64())})

        for t in batches:
            for x, y in zip(t["u"].to_pylist(), t["v"].to_pylist()):
                parent.setdefault(x, x)
                parent.setdefault(y, y)
                if (r := root(x)) != (s := root(y)):
                    parent[max(r, s)] = min(r, s)
            if len(parent) >= STAR_NODES:
                yield stars()
        yield stars()

    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    now = cut(pairs.mapInArrow(contract, "u long, v long").distinct().mapInArrow(contract, "u long, v long"))
    state = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new[0] == 0 or tuple(new) == state:
            break
        state = tuple(new)
        side = merged if new[0] > MOST_SENT // 10 else lambda df: df  # a few links: as Spark likes
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(side(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(side(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
        now = cut(small.distinct().mapInArrow(contract, "u long, v long"))
    return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), F.least("u", "component").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
