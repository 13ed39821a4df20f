"""File sinks: export tables, reports, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.merge import completeness_rows, export_rows
from .document_files import write_document_files

FAILED_PARSE = ("doc_id", "error", "extraction_method", "confidence_score", "completeness_score", "processing_time")
FAILED_FETCH = ("doc_id", "error", "status_code", "patient", "received_on")
FAILED_EXTRACTION = ("doc_id", "error", "quality_score", "extraction_method")
TRACKING = ("doc_id", "patient_status", "order_status", "remarks")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def _columns(df: DataFrame, names) -> DataFrame:
    """Those columns as strings; absent ones and nulls are empty."""
    return df.select(*((F.coalesce(F.col(n).cast("string"), F.lit("")) if n in df.columns else F.lit("")).alias(n) for n in names))


def write_export(parsed: DataFrame, path: str, timestamp: Column, group_id: str = "") -> None:
    """The export table, and failed rows beside it in ``<path>_failed`` with the same header."""
    table = export_rows(parsed, timestamp, group_id)
    write_csv(table, path)
    failed = parsed.where("status = 'failed'").select(F.col("doc_id").alias("Document_ID"), timestamp.alias("Timestamp"), F.lit("FAILED").alias("API_Status"), F.col("error").alias("Error_Message"), F.lit("Parsing failed").alias("Remarks"))
    write_csv(_columns(failed, table.columns), f"{path}_failed")


def write_failed_parses(parsed: DataFrame, path: str, timestamp: Column) -> None:
    write_csv(_columns(parsed.where("status = 'failed'").withColumn("timestamp", timestamp), (*FAILED_PARSE, "timestamp")), path)


def write_failed_fetches(fetched: DataFrame, path: str) -> None:
    write_csv(_columns(fetched.where("status <> 'success'"), FAILED_FETCH), path)


def write_failed_extractions(extracted: DataFrame, path: str) -> None:
    write_csv(_columns(extracted.where("status <> 'extracted'"), FAILED_EXTRACTION), path)


def write_tracking(tracking: DataFrame, path: str) -> None:
    write_csv(_columns(tracking, TRACKING), path)


def write_completeness(parsed: DataFrame, path: str, timestamp: Column) -> None:
    """The document's id stands in the first column only, as files cannot repeat a name."""
    write_csv(completeness_rows(parsed, timestamp).drop("doc_id"), path)


def write_invalid_rows(validated: DataFrame, path: str) -> None:
    """Invalid worklist rows with their errors in one column."""
    bad = validated.where("not is_valid").withColumn("errors", F.concat_ws("; ", "errors"))
    write_csv(bad.drop("is_valid"), path)


def write_results(df: DataFrame, path: str) -> None:
    """JSON lines, a row a line."""
    df.write.mode("overwrite").json(path)


def write_json_per_document(parsed: DataFrame, path: str, fanout: int = 1) -> None:
    """One JSON file for each document, ``<doc_id>_parsed.json``; of a document's rows the last by ordinal."""
    order = F.col("ordinal") if "ordinal" in parsed.columns else None
    write_document_files(parsed, F.col("doc_id"), F.to_json(F.struct(*parsed.columns)), path, "_parsed.json", fanout, order)


def write_texts(extracted: DataFrame, path: str, fanout: int = 1) -> None:
    """One text file for each document, ``<doc_id>.txt``."""
    write_document_files(extracted, F.col("doc_id"), F.col("text"), path, ".txt", fanout)


def write_report(lines: DataFrame, path: str) -> None:
    """A report of one text column (``value``)."""
    lines.coalesce(1).write.mode("overwrite").text(path)
