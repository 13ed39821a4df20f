"""The document plan over a stream of files: stateless parsing, late repeats dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.pipeline import enhance_records, parse_documents
from ..schemas import ParsingConfig
from ..sources.files import file_stem


def read_stream(spark: SparkSession, directory: str, glob: str = "*.txt", files_per_trigger: int = 1000) -> DataFrame:
    """Text files as they arrive: doc_id, text, status, arrived."""
    rows = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).text(directory, wholetext=True)
    path = F.col("_metadata.file_path")
    return rows.select(file_stem(path).alias("doc_id"), F.col("value").alias("text"), F.lit("extracted").alias("status"), F.col("_metadata.file_modification_time").alias("arrived"))


def parse_stream(stream: DataFrame, config: ParsingConfig = ParsingConfig(), within: str = "1 hour") -> DataFrame:
    """Parsed and enhanced records; a document that comes again within the watermark counts once."""
    once = stream.withWatermark("arrived", within).dropDuplicatesWithinWatermark(["doc_id"])
    return enhance_records(parse_documents(once.drop("arrived"), config))
