"""Corpus pipeline: from the documents table to a training mix.

Each stage takes the rows that its predecessor kept and returns the columns of documents;
the last one adds what the mix takes of each row. An id names a document: rows that share
one are one document's repeated rows, of which near-duplicate removal keeps one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.llm.decontaminate import overlaps
from docpipe.llm.mixing import mix_sources
from docpipe.llm.near_copies import near_copies
from docpipe.llm.shared import components, cut, merged
from docpipe.llm.simhash import duplicate_links
from docpipe.llm.substring_dedup import dedup_substrings
from docpipe.llm.toxicity import scorer, train_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose toxicity score is 0.5 or more."""
    model = train_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(scorer(model)(F.col("text")) < 0.5)


def row_key(docs: DataFrame) -> Column:
    """A 64-bit name of a row: rows of equal columns share it, ids or not."""
    return F.xxhash64(*(x for c in docs.columns for x in (F.col(c), F.col(c).isNull())))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one of smallest id.

    Linked are texts with fingerprints within two bits, and texts whose five-word shingles
    have a Jaccard similarity of 0.8 or more. Rows with a null id are compared like any
    other and stay only where their group has no id. Of several rows left with one id, and
    of rows with a null id, the one of smallest row key stays.
    """
    rows = docs.withColumn("_row", row_key(docs))
    of = components(duplicate_links(rows, "_row").union(near_copies(rows, "_row")))
    ids = rows.select("_row", "doc_id").distinct()
    best = ids.join(merged(of), ids._row == of.node, "left").withColumn("part", F.coalesce("component", "_row")).groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("best")).select("best.*")
    named = best.where("not none").groupBy("doc_id").agg(F.min("_row").alias("_row")).select("_row")
    kept = cut(named.union(best.where("none").select("_row")))
    return rows.join(merged(kept), "_row", "left_semi").dropDuplicates(["_row"]).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that start earlier in the corpus.

    A document that loses words keeps the others, one blank between; one that loses all
    its words goes; any other keeps its text as it is.
    """
    found = dedup_substrings(docs, carry=docs.columns)
    found = found.where((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    text = F.when(F.col("n_removed") == 0, F.col("rest.text")).otherwise(F.col("kept_text"))
    new = {"text": text, "n_chars": F.when(F.col("n_removed") == 0, F.col("rest.n_chars")).otherwise(F.length("kept_text").cast("long"))}
    return found.select(*(new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out rows whose text overlaps a benchmark item, with or without an id."""
    rows = docs.withColumn("_row", row_key(docs))
    hit = overlaps(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="_row").select(F.col("doc_id").alias("_row")).distinct()
    hit = cut(hit)
    few = hit.count() <= 1_000_000  # keys of eight bytes each
    return rows.join(F.broadcast(hit) if few else hit, "_row", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, and what the mix takes of each: copies, and words taken."""
    return mix_sources(docs, carry=docs.columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: The stages hold a fitted model and graph components, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
