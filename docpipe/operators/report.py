"""Quality reports as aggregates over parsed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.standardize import full_name
from ..schemas import ORDER_FIELDS, PATIENT_FIELDS, blank

# Bounds of the buckets, of field ratings and of recommendations.
CONFIDENCE_BOUNDS = (0.8, 0.5)
COMPLETENESS_BOUNDS = (0.7, 0.4)
GOOD, FAIR = 70, 30


def rate(part: Column, whole: Column) -> Column:
    """Percent; a whole of zero counts as one."""
    return part / F.greatest(whole, F.lit(1)) * 100


def summary(parsed: DataFrame) -> DataFrame:
    """One row: totals, rates, averages, buckets and times."""
    ok = F.col("status") == "parsed"
    conf, compl, t = F.col("confidence_score"), F.col("completeness_score"), F.col("processing_time")
    over_ok = lambda c: F.coalesce(F.avg(F.when(ok, c)), F.lit(0.0))
    (hi, mid), (chi, cmid) = CONFIDENCE_BOUNDS, COMPLETENESS_BOUNDS
    one = parsed.agg(
        F.count("*").alias("total"), F.count_if(ok).alias("parsed"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(ok & (F.col("source") == "structured")).alias("structured"), F.count_if(ok & (F.col("source") == "llm")).alias("secondary"),
        over_ok(conf).alias("avg_confidence"), over_ok(compl).alias("avg_completeness"),
        F.count_if(ok & (conf >= hi)).alias("high_confidence"), F.count_if(ok & (conf >= mid) & (conf < hi)).alias("medium_confidence"), F.count_if(ok & (conf < mid)).alias("low_confidence"),
        F.count_if(ok & (compl >= chi)).alias("high_completeness"), F.count_if(ok & (compl >= cmid) & (compl < chi)).alias("medium_completeness"), F.count_if(ok & (compl < cmid)).alias("low_completeness"),
        F.coalesce(F.sum(t), F.lit(0.0)).alias("time_total"), F.coalesce(F.avg(t), F.lit(0.0)).alias("time_avg"), F.min(F.when(t > 0, t)).alias("time_min"), F.max(t).alias("time_max"),
    )
    return one.withColumns({"parsed_pct": rate(F.col("parsed"), F.col("total")), "failed_pct": rate(F.col("failed"), F.col("total"))})


def recommendations(one_row: DataFrame) -> DataFrame:
    """Advice that the summary's figures call for, as an array column."""
    c = F.col
    ok = c("parsed") > 0
    rules = [
        (ok & (c("avg_confidence") < 0.6), "Average confidence is low - consider improving text extraction quality"),
        (ok & (c("avg_completeness") < 0.5), "Average completeness is low - review field extraction patterns"),
        (ok & (c("structured") / F.greatest(c("parsed"), F.lit(1)) < 0.7), "Many documents required LLM fallback - consider enhancing structured parser"),
        (ok & (c("failed") / F.greatest(c("total"), F.lit(1)) > 0.2), "High failure rate - review text extraction and preprocessing"),
        (ok & (c("time_avg") > 10.0), "Processing time is high - consider optimization"),
        (ok & (c("avg_confidence") >= 0.8) & (c("avg_completeness") >= 0.7), "Excellent extraction quality achieved!"),
        (~ok, "No successful extractions - review extraction pipeline"),
    ]
    return one_row.withColumn("recommendations", F.array_compact(F.array(*(F.when(w, m) for w, m in rules))))


def _unpivoted(parsed: DataFrame) -> DataFrame:
    """(ordinal, record, field, position, value) of all fields of parsed rows; one pass, no join."""
    p, o = F.col("patient"), F.col("order")
    cells = [F.struct(F.lit("patient").alias("record"), F.lit(f).alias("field"), F.lit(k).alias("position"), F.trim(p[f]).alias("value")) for k, f in enumerate(PATIENT_FIELDS)]
    cells += [F.struct(F.lit("order").alias("record"), F.lit(f).alias("field"), F.lit(k).alias("position"), F.trim(o[f]).alias("value")) for k, f in enumerate(ORDER_FIELDS)]
    first = F.get(o["episode_diagnoses"], F.lit(0))
    listed = F.when(F.size(o["episode_diagnoses"]) > 0, F.when(blank(first["diagnosis_description"]), " ").otherwise(first["diagnosis_description"])).otherwise("")
    cells.append(F.struct(F.lit("order").alias("record"), F.lit("episode_diagnoses").alias("field"), F.lit(len(ORDER_FIELDS)).alias("position"), listed.alias("value")))
    return parsed.where("status = 'parsed'").select("ordinal", F.explode(F.array(*cells)).alias("c")).select("ordinal", "c.*")


def fill_rates(parsed: DataFrame) -> DataFrame:
    """(record, field, filled, total, percentage, rating), best first."""
    rows = _unpivoted(parsed).groupBy("record", "field").agg(F.min("position").alias("position"), F.count_if(F.col("value") != "").alias("filled"), F.count("*").alias("total"))
    pct = F.col("filled") / F.col("total") * 100
    rating = F.when(pct >= GOOD, "Good").when(pct >= FAIR, "Fair").otherwise("Poor")
    return rows.withColumn("percentage", pct).withColumn("rating", rating).orderBy("record", F.desc("percentage"), "position").drop("position")


def field_samples(parsed: DataFrame, n: int = 3, masked: bool = False) -> DataFrame:
    """(record, field, samples): the first ``n`` values of each field by ordinal.

    Ranks are cut to ``n`` in each task before anything moves. ``masked`` shows letters
    and digits as x and 9.
    """
    value = F.col("value")
    if masked:
        value = F.regexp_replace(F.regexp_replace(value, r"\p{L}", "x"), r"\d", "9")
    rows = _unpivoted(parsed).where(F.trim("value") != "").select("record", "field", "ordinal", value.alias("value"))
    w = Window.partitionBy("record", "field").orderBy("ordinal")
    top = rows.withColumn("k", F.row_number().over(w)).where(F.col("k") <= n)
    return top.groupBy("record", "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda x: x["value"]), ", ").alias("samples"))


def failure_counts(parsed: DataFrame) -> DataFrame:
    """Failed rows by what their error says before the first colon."""
    return parsed.where("status = 'failed'").groupBy(F.substring_index("error", ":", 1).alias("error_type")).agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "error_type")


def method_counts(parsed: DataFrame) -> DataFrame:
    return parsed.where("status = 'parsed'").groupBy("extraction_method").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "extraction_method")


def low_fields(rates: DataFrame, fields=("patient_fname", "patient_lname", "dob", "order_date", "physician_name"), below: float = 30) -> DataFrame:
    """Critical fields that few documents have."""
    return rates.where(F.col("field").isin(*fields) & (F.col("percentage") < below)).select("record", "field", "percentage")


def fetch_summary(fetched: DataFrame) -> DataFrame:
    """Counts, rates (two decimals) and sizes of a fetch."""
    ok = F.col("status") == "success"
    one = fetched.agg(F.count("*").alias("total"), F.count_if(ok).alias("success"), F.coalesce(F.sum(F.when(ok, F.col("file_size"))), F.lit(0)).alias("bytes"))
    return one.withColumns({"failed": F.col("total") - F.col("success"), "success_rate": F.round(rate(F.col("success"), F.col("total")), 2), "total_mb": F.round(F.col("bytes") / (1024 * 1024), 2), "avg_kb": F.round(F.col("bytes") / 1024 / F.greatest(F.col("success"), F.lit(1)), 2)})


def extraction_summary(extracted: DataFrame) -> DataFrame:
    """Counts by method, average quality and characters of an extraction."""
    ok = F.col("status") == "extracted"
    method = F.col("extraction_method")
    return extracted.agg(
        F.count("*").alias("total"), F.count_if(ok).alias("extracted"), F.count_if(ok & (method == "digital")).alias("digital"), F.count_if(ok & (method == "ocr")).alias("ocr"),
        F.coalesce(F.avg(F.when(ok, F.col("quality_score"))), F.lit(0.0)).alias("avg_quality"), F.coalesce(F.sum(F.when(ok, F.col("text_length"))), F.lit(0)).cast("long").alias("total_chars"),
    )


def worklist_summary(validated: DataFrame) -> DataFrame:
    one = validated.agg(F.count("*").alias("total"), F.count_if("is_valid").alias("valid"))
    return one.withColumns({"invalid": F.col("total") - F.col("valid"), "success_rate": F.round(rate(F.col("valid"), F.col("total")), 1)})


def report_text(one_row: DataFrame, title: str) -> DataFrame:
    """The figures of a one-row summary as lines of text."""
    lines = [F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in one_row.columns]
    return one_row.select(F.concat_ws("\n", F.lit(title), F.lit("=" * len(title)), *lines).alias("value"))


#: Invalid rows that a validation report names. Fixed value.
NAMED_ROWS = 20


def validation_report(validated: DataFrame, title: str = "Input Reader - Validation Report") -> DataFrame:
    """A worklist's validation as text (``value``): its figures, and the first invalid rows with their errors."""
    bad = validated.where("not is_valid").select("row_number", F.array_join("errors", ", ").alias("said")).orderBy("row_number").limit(NAMED_ROWS)
    named = bad.agg(F.array_sort(F.collect_list(F.struct("row_number", "said"))).alias("named"))
    one = worklist_summary(validated).crossJoin(named)  # one row each
    lines = F.transform("named", lambda r: F.concat(F.lit("Row "), r["row_number"], F.lit(": "), r["said"]))
    more = F.when(F.col("invalid") > NAMED_ROWS, F.array(F.concat(F.lit("... and "), F.col("invalid") - NAMED_ROWS, F.lit(" more invalid rows")))).otherwise(F.array().cast("array<string>"))
    head = F.array(F.lit(title), F.lit("=" * 40), F.lit(""), *(F.concat(F.lit(f"{n} rows: "), F.col(c).cast("string")) for n, c in (("Total", "total"), ("Valid", "valid"), ("Invalid", "invalid"))), F.concat(F.lit("Success rate: "), F.col("success_rate").cast("string"), F.lit("%")))
    tail = F.when(F.col("invalid") > 0, F.concat(F.array(F.lit(""), F.lit("Invalid Rows:"), F.lit("-" * 20)), lines, more)).otherwise(F.array().cast("array<string>"))
    return one.select(F.array_join(F.concat(head, tail), "\n").alias("value"))


def fields_enhanced(before: DataFrame, after: DataFrame) -> DataFrame:
    """(ordinal, n): how many patient and order fields were blank before and are filled after."""
    filled = lambda record, fields: [F.when(blank(F.col(f"b.{record}")[f]) & ~blank(F.col(f"a.{record}")[f]), 1).otherwise(0) for f in fields]
    plain = [f for f in ORDER_FIELDS if f != "episode_diagnoses"]
    listed = F.when((F.size(F.col("b.order.episode_diagnoses")) <= 0) & (F.size(F.col("a.order.episode_diagnoses")) > 0), 1).otherwise(0)
    each = [*filled("patient", PATIENT_FIELDS), *filled("order", plain), listed]
    return before.alias("b").join(after.alias("a"), F.col("b.ordinal") == F.col("a.ordinal")).select(F.col("b.ordinal").alias("ordinal"), F.aggregate(F.array(*each), F.lit(0), lambda x, y: x + y).alias("n"))


def processing_statistics(parsed: DataFrame, groups: DataFrame, enhanced: DataFrame, key: str = "group_id") -> DataFrame:
    """Totals of a run in one row: documents, successes, second extractions, duplicate groups, enhanced fields and their mean."""
    one = parsed.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "parsed").alias("successful"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("source") == "llm").alias("second_extractions"))
    one = one.crossJoin(groups.agg(F.countDistinct(key).alias("duplicates_found"))).crossJoin(enhanced.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("fields_enhanced")))  # one row each
    total = F.greatest(F.col("total"), F.lit(1))
    return one.withColumns({"success_rate": rate(F.col("successful"), F.col("total")), "second_rate": rate(F.col("second_extractions"), F.col("total")), "average_enhancements": F.col("fields_enhanced") / total})


def summary_line(row: Column) -> Column:
    """A parsed record in one line; of a failed one, why."""
    p, o = row["patient"], row["order"]
    name = full_name(p["patient_fname"], F.lit(""), p["patient_lname"])
    number = F.when(o["order_no"] != "", F.concat(F.lit("Order #"), o["order_no"])).otherwise("No order number")
    told = F.format_string("%s - %s (Confidence: %.2f)", name, number, F.coalesce(row["confidence_score"], F.lit(0.0)))
    return F.when(row["status"] != "parsed", F.concat(F.lit("Failed: "), F.coalesce(row["error"], F.lit("")))).otherwise(told)
