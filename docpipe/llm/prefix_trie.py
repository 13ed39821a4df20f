"""Prefix tries over conversations: which beginnings are shared, and what sharing saves.

A conversation is a path of turns. Each turn gets a digest of role and text, each prefix a
digest of its last turn and the prefix before it, so texts are read once and never move.

Conversations are dealt by the digest of their first turn. Where the conversations below a
prefix hold more turns than one task should build, they are dealt by the next turn instead,
and so on until every subtrie is small: since sizes only fall along a path, one aggregate over
all prefixes tells for each conversation at which depth that ends. Small subtries are built
as pointer dictionaries inside ``applyInPandas`` and summed in one postorder pass. The few
prefixes above them (``large`` ones) are summed among themselves by pointer doubling, in as
many rounds as the logarithm of their depth. However many conversations share a prefix, and
however long they are, no task holds more than one small subtrie.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

#: Ids that one row carries at most on the way to the digest of a prefix's ends.
ENDS_BLOCK = 4096
#: Most turns of a small subtrie, on any input.
MOST_TURNS = 200_000
#: Large prefixes are broadcast up to this many (16 bytes each).
FEW = 1_000_000

ROOT = bytes(16)
_NODE = "node binary, conv_id long, depth int, above binary, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that name a turn's role and text."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """Columns conv_id, place (from 1), turns (of the conversation), digest, chars.

    Turns come in the order of ``turn`` (nulls first), ties by digest; repeated rows stay.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"), F.length(text).cast("long").alias("chars"))
    one = Window.partitionBy("conv_id")
    place = F.row_number().over(one.orderBy(F.col("turn").asc_nulls_first(), "digest"))
    return slim.select("conv_id", place.alias("place"), F.count("*").over(one).cast("int").alias("turns"), "digest", "chars")


def spliced(turns: DataFrame, heads: Column, base: Column, most: int) -> DataFrame:
    """Turns of conversations whose first ``heads`` (``most`` at most) turns are another's.

    Conversation ``base`` lends as many of its first turns as it has; the conversation's own
    turns after its first ``heads`` follow. A conversation left without turns stays as one
    row of a null place. ``heads`` and ``base`` are columns over ``conv_id``.
    """
    lent = turns.where(F.col("place") <= most).withColumn("h", heads).withColumn("base", base)
    lent = lent.where("conv_id = base").groupBy("base").agg(F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("lent"))
    convs = turns.where("place = 1").select("conv_id", "turns", heads.alias("h"), base.alias("base")).join(lent, "base", "left")
    none = F.array().cast("array<struct<place:int,digest:binary,chars:bigint>>")
    convs = convs.withColumn("head", F.slice(F.coalesce("lent", none), F.lit(1), F.col("h")))
    convs = cut(convs.select("conv_id", "h", "head", (F.size("head") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("length")))
    first = convs.select("conv_id", "length", F.inline_outer("head")).select("conv_id", "length", "place", "digest", "chars").where("place is not null or length = 0")
    moved = convs.select("conv_id", "h", "length", F.size("head").alias("n"))
    own = turns.join(moved, "conv_id").where("place > h").select("conv_id", "length", (F.col("place") - F.col("h") + F.col("n")).alias("place"), "digest", "chars")
    return first.union(own)


def _chain(batches):
    """Adds each prefix's digest to turns that come by conversation, in order, a row for the root before them."""
    conv, node = None, ROOT
    names = ["conv_id", "left", "depth", "node", "above", "chars", "ends"]
    for t in batches:
        out = []
        columns = (t[c].to_pylist() for c in ("conv_id", "length", "place", "digest", "chars"))
        for c, length, place, digest, chars in zip(*columns):
            if c != conv:
                conv, node = c, ROOT
                out.append((c, length + 1, 0, ROOT, None, 0, length == 0))
            if place is not None:
                above, node = node, hashlib.blake2b(node + digest, digest_size=16).digest()
                out.append((c, length + 1 - place, place, node, above, chars, place == length))
        columns = list(zip(*out)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=names)


def ends_digest(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def build_subtrie(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of small subtries, from the rows (conv_id, depth, node, above, chars, ends) of a bucket."""
    rows = rows.sort_values(["conv_id", "depth"], kind="stable")
    children: list[dict[bytes, int]] = []
    least, depth, convs, chars, names, above, ends, parent = [], [], [], [], [], [], [], []
    top: dict[bytes, int] = {}
    conv, at = None, -1
    for c, d, name, up, n, end in zip(*(rows[x] for x in ("conv_id", "depth", "node", "above", "chars", "ends"))):
        if c != conv:
            conv, at = c, -1
        step = top if at < 0 else children[at]
        into = step.get(name)
        if into is None:
            into = step[name] = len(children)
            children.append({})
            for x, v in ((least, c), (depth, d), (convs, 0), (chars, n), (names, name), (above, up), (ends, []), (parent, at)):
                x.append(v)
        at = into
        convs[at] += 1
        if end:
            ends[at].append(c)
    leaves, saved = [0] * len(children), [0] * len(children)
    stack = [(k, False) for k in top.values()]
    while stack:
        k, done = stack.pop()
        if not done:
            stack.append((k, True))
            stack.extend((x, False) for x in children[k].values())
            continue
        leaves[k] += not children[k]
        saved[k] += (convs[k] - 1) * chars[k]
        if parent[k] >= 0:
            leaves[parent[k]] += leaves[k]
            saved[parent[k]] += saved[k]
    return pd.DataFrame({
        "node": names, "conv_id": least, "depth": depth, "above": above,
        "parent_conv_id": pd.array([None if p < 0 else least[p] for p in parent], "Int64"), "n_convs": convs, "n_children": [len(x) for x in children],
        "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": [ends_digest(x) for x in ends],
    })


def _digest_blocks(batches):
    """One digest of ids a node, from rows (node, block, ids) that come in order of node and block."""
    held, digest, some = None, None, False

    def row():
        return pa.RecordBatch.from_pydict({"node": pa.array([held], pa.binary()), "ends_sha256": pa.array([digest.hexdigest()])})

    for t in batches:
        for node, ids in zip(t["node"].to_pylist(), t["ids"].to_pylist()):
            if node != held:
                if held is not None:
                    yield row()
                held, digest, some = node, hashlib.sha256(), False
            digest.update((b"," if some else b"") + ids.encode())
            some = True
    if held is not None:
        yield row()


def _sum_upwards(large: DataFrame, few: bool) -> DataFrame:
    """Sums of leaves and saved over the subtree of each large prefix: columns node, n_leaves, saved.

    In round i every prefix knows its ancestor 2^i levels up and its sums over the 2^i levels
    below; what lies 2^i levels below it sends its own sums up. Each round is an aggregate and
    a join over one row a prefix.
    """
    now = cut(large.select("node", F.col("above").alias("up"), "n_leaves", "saved"))
    while now.where("up is not null").limit(1).count():
        sent = now.where("up is not null").groupBy("up").agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        ups = now.select(F.col("node").alias("up"), F.col("up").alias("next"))
        now = cut(
            now.join(F.broadcast(ups) if few else ups, "up", "left").join(sent.withColumnRenamed("up", "node"), "node", "left")
            .select("node", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
        )
    return now.select("node", "n_leaves", "saved")


def prefix_trie(turns: DataFrame, most_turns: int | None = None) -> DataFrame:
    """The trie of all conversations, one row a prefix (node), from rows as ``spliced`` gives them.

    Columns: node and above (digests of the prefix and of its parent, null for the root),
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``most_turns`` bounds the turns of a subtrie that one task
    builds; by default it follows the input, so that tasks are even, up to ``MOST_TURNS``.

    Null ids name no conversation and are left out; an empty table has no root; equal
    conversations are members of one path each; other columns are ignored.
    """
    spark = turns.sparkSession
    chained = turns.select("conv_id", F.col("length").cast("long").alias("length"), F.col("place").cast("int").alias("place"), "digest", "chars").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    chained = cut(chained.mapInArrow(_chain, "conv_id long, left long, depth int, node binary, above binary, chars long, ends boolean"))
    total = chained.count()
    most_turns = most_turns or max(64, min(MOST_TURNS, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))

    prefixes = chained.groupBy("node", "above").agg(F.min("depth").alias("depth"), F.min("chars").alias("chars"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("left").alias("turns"))
    large = cut(prefixes.where((F.col("turns") > most_turns) | (F.col("depth") == 0)))
    names = large.select("node", F.lit(True).alias("is_large"))
    few = large.count() <= FEW
    if few:
        marked = chained.join(F.broadcast(names), "node", "left")
    else:  # a large prefix is a frequent key: its name goes to 64 places, its rows to one of them
        marked = chained.withColumn("salt", F.pmod(F.col("conv_id"), F.lit(64)).cast("int")).join(names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63)))), ["node", "salt"], "left").drop("salt")

    # small subtries: a conversation's turns below its large prefixes go where its first of them goes
    below = marked.where("is_large is null").withColumn("unit", F.first("node").over(Window.partitionBy("conv_id").orderBy("depth")))
    bucket = F.pmod(F.xxhash64("unit"), F.lit(total // most_turns + 1)).alias("bucket")
    small = cut(below.select(bucket, "conv_id", "depth", "node", "above", "chars", "ends").groupBy("bucket").applyInPandas(build_subtrie, _NODE))

    # large prefixes: what hangs below each directly, then sums along the way up
    hanging = small.where("parent_conv_id is null").groupBy("above").agg(F.count("*").alias("k"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    inner = large.where("above is not null").groupBy("above").agg(F.count("*").alias("k_large"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    direct = large.join(hanging.withColumnRenamed("above", "node"), "node", "left").join(inner.withColumnRenamed("above", "node"), "node", "left")
    direct = cut(direct.select(*large.columns, (n("k") + n("k_large")).alias("n_children"), (n("l") + F.when(n("k") + n("k_large") == 0, 1).otherwise(0)).alias("n_leaves"), (n("s") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    sums = _sum_upwards(direct, few)

    ending = marked.where("is_large and ends").select("node", "conv_id", F.floor(F.col("conv_id") / ENDS_BLOCK).alias("block"))
    blocks = ending.groupBy("node", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    digests = blocks.repartition("node").sortWithinPartitions("node", "block").mapInArrow(_digest_blocks, "node binary, ends_sha256 string")
    least = cut(large.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv")))
    least = F.broadcast(least) if few else least
    upper = (
        direct.drop("n_leaves", "saved").join(sums, "node").join(digests, "node", "left").join(least, "above", "left")
        .select("node", "conv_id", "depth", "above", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(ends_digest([]))).alias("ends_sha256"), F.col("above_conv").alias("parent_conv_id"))
    )
    lower = small.join(least, "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv")).select(upper.columns)
    return upper.union(lower)


def stitched_trie(conversations: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text) after conversation c took over
    the first crc32(c) mod ``heads`` turns of conversation c - c mod ``every``."""
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % heads).cast("int")
    turns = cut(turns_in_order(conversations))
    return prefix_trie(spliced(turns, h, F.col("conv_id") - F.col("conv_id") % every, heads - 1))


