"""Mixing sources to target weights by Pareto order sampling, in SQL functions only.

Every document is wanted ``target / size of its source`` times. The whole part of that
is allotted for certain. The rest is the inclusion probability of one more copy: within
its source a document gets the rank of its random odds divided by its inclusion odds,
and the lowest ranks are taken until the source's size, in words, is reached. A
document's random number is a digest of its id, so a rerun takes the same documents. Rows
without an id, and rows that share one, get numbers of their own from their text and place.

A source may hold a third of all rows, so no task ranks a whole source. Ranks fall into
narrow ranges; the words in each range are summed, running totals over the ranges find
the one in which the target falls, and only that range's documents are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, cut


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def random_number(name: Column, salt: str = "") -> Column:
    """In (0, 1), from the first 12 hexadecimal digits of an MD5 digest."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), name)), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of sources: columns source, source_size, target.

    ``sizes`` has a row for each source (source, source_size). Sources in order of code
    points, null last, get ``weights`` in turn and share ``total`` times all sizes. A
    target stops at ``most`` times the source's size and the excess goes to the others
    by weight, until none is above. In the order of ``most * size / weight`` the sources
    that stop come first, so running sums find them all at once.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(float(total)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = weighed.withColumn("level", left / weight)
    stops = level.withColumn("stops", F.col("cap") <= F.col("weight") * F.col("level"))
    # past the first source that does not stop the level only falls
    rest = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)
    return stops.select("source", "source_size", F.when(F.col("stops"), F.col("cap")).otherwise(F.col("weight") * rest).alias("target"))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0, importance: str | None = None, range_rows: int = 20_000, salt: str = "", carry: list[str] | None = None) -> DataFrame:
    """How much of each document the mix takes: doc_id, size, source_size, target, copies, taken.

    ``taken`` is in words, repeats counted: ``copies`` times the size. ``importance``
    may name a column of positive factors by which documents of a source differ in
    their inclusion odds; without it they are alike.

    A null text has size 0 and copies are still allotted, though they take no word. A
    null source is a source of its own, last in order. Rows without an id, and rows that
    share one, are ranked by their texts' digests too, and equal rows each by its own number. ``carry`` names columns
    to pass on; others are ignored. An empty table gives an empty result.
    """
    factor = F.coalesce(F.col(importance).cast("double"), F.lit(1.0)) if importance else F.lit(1.0)
    rest = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(None).cast("boolean")
    slim = cut(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), size_in_words(F.col(text).cast("string")).alias("size"), factor.alias("factor"), rest.alias("rest"),
        F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("digest"), F.monotonically_increasing_id().alias("row"),
    ))
    alike = slim.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    many = alike.groupBy("doc_id").agg(F.sum("n").alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    alike = cut(alike.where("doc_id is null").union(alike.join(many, "doc_id").select("doc_id", "digest", "n")).select(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), "n"))
    few = alike.count() <= 100_000  # rows of some fifty bytes each
    slim = slim.join(F.broadcast(alike) if few else alike, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest")), "left")
    own = F.concat_ws(":", "doc_id", "digest", F.when(F.col("n") > 1, F.col("row")))
    slim = slim.withColumn("name", F.when(F.col("n").isNull(), F.col("doc_id").cast("string")).otherwise(own))
    sources = cut(source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, total, most))
    ranges = max(16, -(-slim.count() // range_rows))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = slim.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    rows = rows.select("doc_id", "name", "rest", F.col("d.source").alias("source"), "size", "factor", "source_size", "target", F.floor(wanted).cast("long").alias("whole"), wanted.alias("wanted"))
    rows = rows.withColumn("inclusion", F.col("wanted") - F.col("whole"))
    u = random_number(F.col("name"), salt)
    odds = u / (F.lit(1.0) - u)
    # equal inclusion odds within a source only scale its ranks; factors set documents apart
    rows = rows.withColumn("rank", odds * (F.lit(1.0) - F.col("inclusion")) / (F.greatest(F.col("inclusion"), F.lit(1e-12)) * F.col("factor")))
    unscaled = F.col("rank") * F.greatest(F.col("inclusion"), F.lit(1e-12)) / (F.lit(1.0) - F.col("inclusion"))
    rows = rows.withColumn("part", F.least(F.lit(ranges - 1), F.floor(unscaled / (unscaled + 1) * ranges)).cast("long"))

    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"), F.max("target").alias("target"), F.max("source_size").alias("of"), F.max("whole").alias("whole"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0))).withColumn("room", F.col("target") - F.col("whole") * F.col("of"))
    parts = parts.select(F.col("source").alias("in_source"), F.col("part").alias("in_part"), "before", "room", F.when(F.col("before") >= F.col("room"), "none").when(F.col("before") + F.col("words") <= F.col("room"), "all").otherwise("some").alias("takes"))
    rows = rows.join(parts, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("part") == F.col("in_part")), "left")

    in_order = Window.partitionBy("source", "part").orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = rows.where("takes = 'some'")
    tied = F.sum("size").over(Window.partitionBy("source", "part", "rank"))
    upto_here = F.col("before") + F.sum("size").over(in_order)
    # a document is in if at least half of it, with those of its rank, fits
    edge = edge.withColumn("extra", F.when(upto_here - tied / F.lit(2.0) <= F.col("room"), 1).otherwise(0))
    sure = rows.where("takes <> 'some' or takes is null").withColumn("extra", F.when(F.col("takes") == "all", 1).otherwise(0))
    copies = F.col("whole") + F.when(F.col("inclusion") > 0, F.col("extra")).otherwise(0)
    both = sure.unionByName(edge)
    passed = [F.col("rest")[c].alias(c) for c in carry or [] if c not in ("doc_id", "size", "source_size", "target", "copies", "taken")]
    return both.select("doc_id", *passed, "size", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
