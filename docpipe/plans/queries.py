"""Registered queries over whole tables: rendered order documents, records, reports.

Documents are rendered from orders and customers, line by line, so that SQL over the
source columns says what extraction must give back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, encoding
from ..functions import text as T
from ..operators import extract, lookup, merge, report, resolve, score, similar, validation
from ..schemas import COMPLETENESS_COLUMNS, EXPORT_COLUMNS, ORDER, ORDER_FIELDS, PATIENT, PATIENT_FIELDS, record, settle, with_fields

from ..scratch import spread
from ..sources import files
from . import pipeline

LAST = ("Abel", "Baker", "Carter", "Dalton", "Ellis", "Fuller", "Gibson")
FIRST = ("Alan", "Beth", "Carla", "Oscar", "Emil")
FACILITIES = ("Alpha Care", "Beta Care", "Gamma Care", "delta care")
TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values, k: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.pmod(k, F.lit(len(values))).cast("int"))


def sql_pick(values, k: str) -> str:
    return "CASE " + " ".join(f"WHEN {k} % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up facts of each customer."""
    k = F.col("c_custkey")
    dob = F.date_add(F.lit("1940-01-01").cast("date"), (k * 37 % 20000).cast("int"))
    phone = F.format_string("(%03d) %03d-%04d", 200 + k % 700, 100 + k * 7 % 900, k % 10000)
    return table(spark, sf_dir, "customer").select("c_custkey", pick(LAST, k).alias("last"), pick(FIRST, k).alias("first"), dob.alias("dob"), F.when(k % 2 == 0, "MALE").otherwise("FEMALE").alias("sex"), F.concat(F.lit("HH"), F.lpad(k.cast("string"), 11, "0")).alias("mrn"), phone.alias("phone"))


def diagnosis_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lines of each order, from the parts of its line items (a handful an order)."""
    n = F.col("l_partkey")
    code = F.concat(F.char(65 + n % 26), F.lpad((F.floor(n / 26) % 100).cast("string"), 2, "0"), F.lit("."), n % 10)
    line = F.concat(code, F.lit(" Chronic trouble "), n % 97, F.lit(" (E)"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", line.alias("line")))).alias("lines"))
    return lines.select("o_orderkey", F.array_join(F.col("lines.line"), "\n").alias("coded"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ordinal, text, status of one document for each order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    rows = o.join(people(spark, sf_dir), o.o_custkey == F.col("c_custkey")).join(diagnosis_lines(spark, sf_dir), "o_orderkey", "left")
    k = F.col("o_orderkey")
    loose = lambda c: F.date_format(c, "M/d/yyyy")
    lines = F.concat_ws(
        "\n", F.lit("Page 1 of 2"), F.lit("PATIENT INFORMATION"), F.concat(F.lit("Patient: "), F.col("last"), F.lit(", "), F.col("first")), F.concat(F.lit("DOB: "), loose(F.col("dob"))),
        F.concat(F.lit("Patient's Gender: "), F.col("sex")), F.concat(F.lit("MR#: "), F.col("mrn")), F.concat(F.lit("Phone: "), F.col("phone")), F.lit("Faxed on Monday"), F.lit("ORDERS"),
        F.concat(F.lit("The Order Number: "), F.lpad(k.cast("string"), 8, "0")), F.concat(F.lit("The Order Date: "), loose(F.col("d"))),
        F.when(k % 5 != 0, F.concat(F.lit("SOC Date: "), loose(F.date_sub("d", 10)))), F.when(k % 3 != 0, F.concat(F.lit("Certification Period: "), loose(F.col("d")), F.lit(" to "), loose(F.date_add("d", 59)))),
        F.lit("CONFIDENTIAL"), F.lit("DIAGNOSES"), F.col("coded"),
    )
    return rows.select(F.concat(F.lit("D"), k).alias("doc_id"), k.alias("ordinal"), lines.alias("text"), F.lit("extracted").alias("status"))


_PEOPLE = f"""people AS (
  SELECT c_custkey, {sql_pick(LAST, 'c_custkey')} AS last, {sql_pick(FIRST, 'c_custkey')} AS first,
         DATE '1940-01-01' + (c_custkey * 37 % 20000)::INTEGER AS dob, CASE WHEN c_custkey % 2 = 0 THEN 'MALE' ELSE 'FEMALE' END AS sex,
         'HH' || lpad(c_custkey::VARCHAR, 11, '0') AS mrn,
         '(' || lpad((200 + c_custkey % 700)::VARCHAR, 3, '0') || ') ' || lpad((100 + c_custkey * 7 % 900)::VARCHAR, 3, '0') || '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone
  FROM customer)"""


def order_doc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settle(spread(order_documents(spark, sf_dir)), {"clean": T.preprocess(F.col("text"))})
    docs = settle(docs, {"sec": T.sections(F.col("clean"))})
    got = extract.with_records(docs.withColumns({"a": F.col("sec.HEADER"), "b": F.concat_ws("\n", "sec.ORDERS", "sec.DIAGNOSES")}), "a", "b")
    p, o = F.col("patient"), F.col("order")
    listed = o["episode_diagnoses"]
    codes, texts = (F.array_join(listed[c], "; ") for c in ("diagnosis_code", "diagnosis_description"))
    return got.select("doc_id", p["patient_lname"].alias("lname"), p["patient_fname"].alias("fname"), p["dob"].alias("dob"), p["patient_sex"].alias("sex"), p["medical_record_no"].alias("mrn"), p["phone_number"].alias("phone"), o["order_no"].alias("order_no"), o["order_date"].alias("order_date"), o["start_of_care"].alias("soc"), o["episode_start_date"].alias("episode_start"), o["episode_end_date"].alias("episode_end"), o["primary_diagnosis"].alias("primary_diagnosis"), F.size(listed).cast("long").alias("n_diagnoses"), codes.alias("diagnosis_codes"), texts.alias("diagnosis_texts"))


_ORDER_DOC_SQL = f"""WITH {_PEOPLE}, d AS (
  SELECT o_orderkey AS k, o_orderdate::DATE AS d, p.* FROM orders JOIN people p ON o_custkey = c_custkey),
coded AS (
  SELECT l_orderkey, l_linenumber AS n, l_partkey AS part, chr((65 + l_partkey % 26)::INTEGER) || lpad((l_partkey // 26 % 100)::VARCHAR, 2, '0') || '.' || l_partkey % 10 AS code,
         'Chronic trouble ' || l_partkey % 97 AS words FROM lineitem),
listed AS (
  SELECT l_orderkey, count(*)::BIGINT AS n_diagnoses, string_agg(code, '; ' ORDER BY n, part) AS codes, string_agg(words, '; ' ORDER BY n, part) AS texts, arg_min(words, (n, part)) AS main
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, code ORDER BY n, part) AS turn FROM coded) WHERE turn = 1 GROUP BY l_orderkey)
SELECT 'D' || k AS doc_id, coalesce(main, '') AS primary_diagnosis, coalesce(n_diagnoses, 0) AS n_diagnoses, coalesce(codes, '') AS diagnosis_codes, coalesce(texts, '') AS diagnosis_texts, last AS lname, first AS fname, strftime(dob, '%m/%d/%Y') AS dob, sex, mrn, phone, lpad(k::VARCHAR, 8, '0') AS order_no,
       strftime(d, '%m/%d/%Y') AS order_date, CASE WHEN k % 5 <> 0 THEN strftime(d - 10, '%m/%d/%Y') ELSE '' END AS soc,
       CASE WHEN k % 3 <> 0 THEN strftime(d, '%m/%d/%Y') WHEN k % 5 <> 0 THEN strftime(d - 10, '%m/%d/%Y') ELSE '' END AS episode_start,
       CASE WHEN k % 3 <> 0 THEN strftime(d + 59, '%m/%d/%Y') WHEN k % 5 <> 0 THEN strftime(d + 49, '%m/%d/%Y') ELSE '' END AS episode_end
FROM d LEFT JOIN listed ON l_orderkey = k"""


# --- records made from keys ---------------------------------------------------


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed records of orders: which fields are filled follows from the key."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    rows = o.join(people(spark, sf_dir), o.o_custkey == F.col("c_custkey"))
    k = F.col("o_orderkey")
    some = lambda n, v: F.when(k % n != 0, v).otherwise("")
    day = F.date_format("d", "MM/dd/yyyy")
    code = F.concat(F.lit("I"), F.lpad((k % 100).cast("string"), 2, "0"))
    listed = F.when(k % 6 != 0, F.array(F.struct(code.alias("diagnosis_code"), F.concat(F.lit("Condition "), k % 9).alias("diagnosis_description"), F.lit("other").alias("diagnosis_type"), F.lit("ICD-10").alias("icd_version")))).otherwise(F.array().cast("array<struct<diagnosis_code:string,diagnosis_description:string,diagnosis_type:string,icd_version:string>>"))
    patient = record(PATIENT, {"patient_fname": some(4, F.col("first")), "patient_lname": some(7, F.col("last")), "dob": some(3, F.date_format("dob", "MM/dd/yyyy")), "patient_sex": F.when(k % 11 == 0, "M").otherwise(F.col("sex")), "medical_record_no": some(5, F.col("mrn")), "phone_number": some(2, F.col("phone")), "account_number": some(2, F.lpad(k.cast("string"), 9, "0"))})
    order = record(ORDER, {"order_no": some(8, k.cast("string")), "order_date": F.when(k % 9 == 0, F.date_format("d", "M/d/yyyy")).otherwise(day), "episode_start_date": some(10, day), "physician_name": some(2, F.lit("Jane Roe, MD")), "primary_diagnosis": some(3, F.concat(code, F.lit(" trouble"))), "start_of_care": some(4, day), "episode_diagnoses": listed})
    ok = k % 13 != 0
    status = F.when(ok, "parsed").otherwise("failed")
    error = F.when(ok, "").when(k % 2 == 0, F.concat(F.lit("Timeout: order "), k)).otherwise("No valid text extracted")
    method = F.when(~ok, "none").when(k % 4 == 1, "enhanced_llm").when(k % 4 == 2, "enhanced_structured_fallback").otherwise("enhanced_structured")
    source = F.when(~ok, "none").when(k % 4 == 1, "llm").otherwise("structured")
    facts = rows.select(F.concat(F.lit("D"), F.floor(k / 2)).alias("doc_id"), k.alias("ordinal"), source.alias("source"), status.alias("status"), error.alias("error"), ((k % 10) / 10.0).alias("confidence_score"), ((k % 8) / 8.0).alias("completeness_score"), method.alias("extraction_method"), ((k % 4) * 0.5).alias("processing_time"), patient.alias("patient"), order.alias("order"))
    return settle(facts, {"patient": F.col("patient"), "order": F.col("order")})


_RECORDS = f"""{_PEOPLE}, r AS (
  SELECT o_orderkey AS k, o_orderdate::DATE AS d, 'D' || (o_orderkey // 2) AS doc_id, o_orderkey AS ordinal,
    CASE WHEN o_orderkey % 4 <> 0 THEN first ELSE '' END AS fname, CASE WHEN o_orderkey % 7 <> 0 THEN last ELSE '' END AS lname,
    CASE WHEN o_orderkey % 3 <> 0 THEN strftime(dob, '%m/%d/%Y') ELSE '' END AS dob, CASE WHEN o_orderkey % 11 = 0 THEN 'M' ELSE sex END AS sex,
    CASE WHEN o_orderkey % 5 <> 0 THEN mrn ELSE '' END AS mrn, CASE WHEN o_orderkey % 2 <> 0 THEN phone ELSE '' END AS phone,
    CASE WHEN o_orderkey % 2 <> 0 THEN lpad(o_orderkey::VARCHAR, 9, '0') ELSE '' END AS account,
    CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey::VARCHAR ELSE '' END AS order_no,
    CASE WHEN o_orderkey % 9 = 0 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) ELSE strftime(o_orderdate, '%m/%d/%Y') END AS order_date,
    CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE '' END AS episode_start,
    CASE WHEN o_orderkey % 2 <> 0 THEN 'Jane Roe, MD' ELSE '' END AS physician,
    'I' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') AS code,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'I' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || ' trouble' ELSE '' END AS primary_diagnosis,
    CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE '' END AS soc,
    o_orderkey % 6 <> 0 AS listed, o_orderkey % 13 <> 0 AS ok,
    CASE WHEN o_orderkey % 13 <> 0 THEN '' WHEN o_orderkey % 2 = 0 THEN 'Timeout: order ' || o_orderkey ELSE 'No valid text extracted' END AS error,
    CASE WHEN o_orderkey % 13 = 0 THEN 'none' WHEN o_orderkey % 4 = 1 THEN 'enhanced_llm' WHEN o_orderkey % 4 = 2 THEN 'enhanced_structured_fallback' ELSE 'enhanced_structured' END AS method,
    (o_orderkey % 10) / 10.0::DOUBLE AS conf, (o_orderkey % 8) / 8.0::DOUBLE AS compl, (o_orderkey % 4) * 0.5::DOUBLE AS t
  FROM orders JOIN people ON o_custkey = c_custkey)"""
_FILLED_P = " + ".join(f"(CASE WHEN {c} <> '' THEN 1 ELSE 0 END)" for c in ("fname", "lname", "dob", "sex", "mrn", "phone", "account"))
_FILLED_O = " + ".join(f"(CASE WHEN {c} <> '' THEN 1 ELSE 0 END)" for c in ("order_no", "order_date", "episode_start", "physician", "primary_diagnosis", "soc"))
_CRITICAL = " + ".join(f"(CASE WHEN {c} <> '' THEN 1 ELSE 0 END)" for c in ("fname", "lname", "dob", "mrn", "sex", "order_no", "order_date", "episode_start", "soc", "physician", "primary_diagnosis"))


def completeness_score(spark, sf_dir):
    p, o = F.col("patient"), F.col("order")
    return records(spark, sf_dir).select("ordinal", score.patient_completeness(p).alias("patient_completeness"), score.order_completeness(o).alias("order_completeness"), score.completeness(p, o).alias("completeness"))


def confidence_score(spark, sf_dir):
    p, o = F.col("patient"), F.col("order")
    return records(spark, sf_dir).select("ordinal", F.round(score.confidence(p, o, 0.8), 9).alias("structured"), F.round(score.confidence(p, o, 0.7), 9).alias("secondary"))


def parse_decision(spark, sf_dir):
    p, o = F.col("patient"), F.col("order")
    conf, compl = F.col("confidence_score") * 0.5, F.col("completeness_score") * 0.4
    success = score.structured_success(p, o, conf, compl)
    better = F.col("ordinal") % 17 == 0
    d = score.decide(F.col("status") == "parsed", success, conf, compl, better)
    return records(spark, sf_dir).select("ordinal", d["source"].alias("source"), d["status"].alias("status"), d["extraction_method"].alias("method"), d["error"].alias("error"))


def fill_missing_merge(spark, sf_dir):
    rows = records(spark, sf_dir)
    other = record(PATIENT, {"patient_fname": F.lit("Second"), "dob": F.lit("01/01/1901"), "email": F.lit("a@b.c"), "medical_record_no": F.lit(" ")})
    m = merge.fill_missing(F.col("patient"), other, PATIENT)
    return rows.select("ordinal", *(m[f].alias(f) for f in ("patient_fname", "patient_lname", "dob", "email", "medical_record_no")))


def anti_new_diagnoses(spark, sf_dir):
    one = lambda code, desc: F.struct(F.lit(code).alias("diagnosis_code"), F.lit(desc).alias("diagnosis_description"), F.lit("secondary").alias("diagnosis_type"), F.lit("").alias("icd_version"))
    new = F.array(one("", "CONDITION 3"), one("Z1", "Other"), one("Z2", "Other"))
    both = merge.append_diagnoses(F.col("order.episode_diagnoses"), new)
    return records(spark, sf_dir).select("ordinal", F.array_join(F.transform(both, lambda d: d["diagnosis_description"]), "|").alias("descriptions"))


def diagnosis_slots6(spark, sf_dir):
    o = F.col("order")
    s = merge.diagnosis_slots(o["primary_diagnosis"], F.lit("no code"), o["episode_diagnoses"])
    return records(spark, sf_dir).select("ordinal", *(F.get(s, F.lit(k)).alias(f"slot{k + 1}") for k in range(6)))


def export_41(spark, sf_dir):
    return merge.export_rows(records(spark, sf_dir), F.lit(TS))


def completeness_report(spark, sf_dir):
    rows = merge.completeness_rows(records(spark, sf_dir), F.lit(TS))
    return rows.select("Document_ID", "Fields_Present", "Fields_Missing", "Pct_Complete", "Patient_ID", "Diagnosis_1", "Diagnosis_2")


def valid_invalid_split(spark, sf_dir):
    v = validation.validate_parsed(records(spark, sf_dir))
    return v.select("ordinal", "is_valid", F.concat_ws("; ", "errors").alias("errors"))


def first_per_doc(spark, sf_dir):
    return resolve.first_per_document(records(spark, sf_dir)).select("doc_id", "ordinal")


def dup_keys(spark, sf_dir):
    return records(spark, sf_dir).select("ordinal", F.explode(resolve.duplicate_keys(F.col("patient"))).alias("key")).groupBy("key").agg(F.count("*").alias("n"), F.min("ordinal").alias("first"))


def dup_groups(spark, sf_dir):
    return resolve.group_by_components(records(spark, sf_dir))


def dup_groups_greedy(spark, sf_dir):
    return resolve.group_greedily(records(spark, sf_dir))


def dup_merge_best(spark, sf_dir):
    """Groups are the documents here, so that SQL can say who merges with whom."""
    rows = records(spark, sf_dir)
    groups = rows.select("ordinal", F.col("doc_id").alias("group_id"))
    p = F.col("patient")
    return resolve.merge_groups(rows, groups).select("doc_id", "ordinal", p["patient_fname"].alias("fname"), p["dob"].alias("dob"), p["phone_number"].alias("phone"), "confidence_score")


def dup_members(spark, sf_dir):
    rows = records(spark, sf_dir)
    return resolve.in_groups(rows, resolve.group_by_components(rows)).select("ordinal", "doc_id")


def dup_report(spark, sf_dir):
    rows = records(spark, sf_dir)
    groups = rows.select("ordinal", F.col("doc_id").alias("group_id"))
    return resolve.duplicate_report(rows, groups).select("group_id", "size", "members")


def existing_patients_anti(spark, sf_dir):
    known = people(spark, sf_dir).where("c_custkey % 2 = 0").select(F.lower("mrn").alias("m"))
    return resolve.not_known(records(spark, sf_dir), known, F.col("patient.medical_record_no"), "m").select("ordinal")


ENDINGS, SECOND = ("son", "ette", "y", "lyn"), ("Mary", "Jo", "Anna")


def similar_pairs_theta(spark, sf_dir):
    """Customers under varied first names, some without birth date or number; every hundredth asks."""
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.col("first")).when(k % 3 == 1, F.concat("first", pick(ENDINGS, k))).otherwise(F.concat(pick(SECOND, k), F.lit(" "), F.col("first")))
    rows = people(spark, sf_dir).select(k.alias("ordinal"), record(PATIENT, {"patient_fname": name, "dob": F.when(k % 4 == 0, F.date_format("dob", "MM/dd/yyyy")), "medical_record_no": F.when(k % 5 == 0, F.concat(F.lit("HH"), F.lpad((k % 500).cast("string"), 6, "0")))}).alias("patient"))
    return similar.similar_patients(rows.where("ordinal % 100 = 0"), rows).select("query_ordinal", F.col("rank").cast("long").alias("rank"), "ordinal", F.round("score", 9).alias("score"))


def worklist_rows(spark, sf_dir) -> DataFrame:
    """A worklist of customers: some ids twice, some values missing or wrong."""
    k = F.col("c_custkey")
    date = F.when(k % 9 == 0, "13/45/2025").when(k % 9 == 1, "").otherwise(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")), "M/d/yyyy"))
    base = people(spark, sf_dir).select(F.concat(F.lit("D"), k % 1000).alias("doc_id"), F.concat("last", F.lit(", "), "first").alias("patient"), date.alias("received_on"), F.when(k % 10 == 0, " ").otherwise("new").alias("status"), pick(FACILITIES, k).alias("facility"), k.alias("row_number"))
    return base


def worklist_validate(spark, sf_dir):
    v = validation.validate_worklist(worklist_rows(spark, sf_dir))
    return v.select("row_number", "doc_id", "patient", "received_on", "is_valid", F.concat_ws("; ", "errors").alias("errors"))


def worklist_summary(spark, sf_dir):
    return report.worklist_summary(validation.validate_worklist(worklist_rows(spark, sf_dir))).select("total", "valid", "invalid", "success_rate")


def worklist_last_wins(spark, sf_dir):
    return lookup.keyed_last(worklist_rows(spark, sf_dir).select("doc_id", "patient", "row_number"), "doc_id", "row_number").select("doc_id", "patient", "row_number")


def header_canonicalize(spark, sf_dir):
    names = ["ID", "document_id", "Patient Name", "patient_name", "Received-On", "SOC", "Other"]
    got = files.canonical_headers(names)
    rows = table(spark, sf_dir, "region").select("r_regionkey")
    return rows.select("r_regionkey", F.explode(F.array(*(F.struct(F.lit(a).alias("header"), F.lit(b).alias("canonical")) for a, b in zip(names, got)))).alias("h")).select("r_regionkey", "h.header", "h.canonical")


def lookup_join_fallback_key(spark, sf_dir):
    k = F.col("o_orderkey")
    left = table(spark, sf_dir, "orders").select(k.alias("k"), F.concat((k % 2000).cast("string"), F.when(k % 3 == 0, "_digital").when(k % 3 == 1, "_OCR_2").otherwise("")).alias("doc_id"))
    side = people(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("ID"), "last")
    from ..functions.standardize import base_doc_id

    got = lookup.join_with_fallback(left, side, F.col("doc_id"), base_doc_id(F.col("doc_id")), "ID", "w")
    return got.select("k", F.col("w.ID").alias("id"), F.col("w.last").alias("last"))


def company_lookup_case_insensitive(spark, sf_dir):
    companies = spark.createDataFrame([("Alpha Care", "c1", 0), ("BETA CARE", "c2", 1), ("beta care", "c3", 2), ("Delta Care", "c4", 3)], "agency string, company_id string, ordinal long")
    left = worklist_rows(spark, sf_dir).select("row_number", "facility")
    return lookup.company_lookup(left, companies, F.col("facility")).select("row_number", "company_id")


def backfill_rules(spark, sf_dir):
    w = worklist_rows(spark, sf_dir)
    last = lookup.keyed_last(w.select("doc_id", "patient", "received_on", "facility", "row_number"), "doc_id", "row_number")
    work = last.select(F.col("doc_id").alias("ID"), F.col("patient").alias("Patient"), F.col("received_on").alias("Received On"), F.col("facility").alias("Facility"))
    p, o = F.col("patient"), F.col("order")
    return lookup.backfill(records(spark, sf_dir), work).select("ordinal", p["patient_fname"].alias("fname"), p["medical_record_no"].alias("mrn"), o["order_no"].alias("order_no"), o["order_date"].alias("order_date"), o["episode_start_date"].alias("episode_start"), o["episode_end_date"].alias("episode_end"), o["start_of_care"].alias("soc"), o["primary_diagnosis"].alias("diagnosis"), F.size(o["episode_diagnoses"]).alias("listed"), o["ordering_facility"].alias("facility"))


def tracking_remarks(spark, sf_dir):
    k = F.col("o_orderkey")
    ps, os_ = pick((201, 200, 500), k), pick((201, 409, 400, 200), k)
    msg = F.when(k % 2 == 0, "bad request").otherwise("")
    return table(spark, sf_dir, "orders").select(k.alias("k"), lookup.remarks(lookup.patient_accepted(ps), lookup.order_accepted(os_), ps, os_, msg).alias("remarks"))


def api_overwrite(spark, sf_dir):
    other = F.struct(*((F.when(F.col("ordinal") % 2 == 0, "New") if f == "city" else F.lit("")).alias(f) for f in PATIENT_FIELDS))
    got = lookup.overwrite(F.col("patient"), other, PATIENT_FIELDS)
    return records(spark, sf_dir).select("ordinal", got["city"].alias("city"), got["patient_lname"].alias("lname"))


def bucket_histogram(spark, sf_dir):
    s = report.summary(records(spark, sf_dir))
    return s.select("total", "parsed", "failed", "structured", "secondary", "high_confidence", "medium_confidence", "low_confidence", "high_completeness", "medium_completeness", "low_completeness", F.round("avg_confidence", 9).alias("avg_confidence"), F.round("avg_completeness", 9).alias("avg_completeness"), F.round("parsed_pct", 9).alias("parsed_pct"), "time_total", F.round("time_avg", 9).alias("time_avg"), "time_min", "time_max")


def summary_recommendations(spark, sf_dir):
    return report.recommendations(report.summary(records(spark, sf_dir))).select(F.concat_ws("|", "recommendations").alias("recommendations"))


def fill_rate_by_field(spark, sf_dir):
    return report.fill_rates(records(spark, sf_dir)).select("record", "field", "filled", "total", F.round("percentage", 9).alias("percentage"), "rating")


def low_fill_fields(spark, sf_dir):
    return report.low_fields(report.fill_rates(records(spark, sf_dir)), below=70).select("record", "field")


def field_samples_top3(spark, sf_dir):
    return report.field_samples(records(spark, sf_dir)).where("field in ('patient_fname', 'dob', 'order_no', 'physician_name', 'episode_diagnoses')")


def field_samples_masked(spark, sf_dir):
    return report.field_samples(records(spark, sf_dir), masked=True).where("field in ('medical_record_no', 'phone_number')")


def error_prefix_counts(spark, sf_dir):
    return report.failure_counts(records(spark, sf_dir))


def method_counts(spark, sf_dir):
    return report.method_counts(records(spark, sf_dir))


def fetch_summary(spark, sf_dir):
    f = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 10 == 0, "failed").otherwise("success").alias("status"), F.octet_length("text").cast("long").alias("file_size"))
    return report.fetch_summary(f)


def document_extraction(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(None).cast("binary").alias("pdf_buffer"), F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("content"), F.lit("success").alias("status"))
    return files.extract_text(d)


def render_pdf(text: Column) -> Column:
    """A PDF file of one page whose lines are the text's; codes are UTF-16, so any character can be shown."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit("<"), F.hex(F.encode(x, "UTF-16BE")), F.lit("> Tj T*")))
    content = F.concat(F.lit("BT /F1 10 Tf 12 TL 50 780 Td\n"), F.array_join(lines, "\n"), F.lit("\nET"))
    unicode = "1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <FFFF> <0000> endbfrange"
    objects = ("<</Type /Catalog /Pages 2 0 R>>", "<</Type /Pages /Kids [3 0 R] /Count 1>>", "<</Type /Page /Parent 2 0 R /Contents 4 0 R /Resources <</Font <</F1 5 0 R>> >> >>", None, "<</Type /Font /Subtype /Type0 /BaseFont /Plain /Encoding /Identity-H /DescendantFonts [7 0 R] /ToUnicode 6 0 R>>", f"<</Length {len(unicode)}>> stream\n{unicode}\nendstream", "<</Type /Font /Subtype /CIDFontType2 /BaseFont /Plain /DW 500>>")
    parts = [F.concat(F.lit(f"\n{k} 0 obj "), F.concat(F.lit("<</Length "), F.length(content).cast("string"), F.lit(">> stream\n"), content, F.lit("\nendstream")) if x is None else F.lit(x), F.lit(" endobj")) for k, x in enumerate(objects, 1)]
    return F.encode(F.concat(F.lit("%PDF-1.7"), *parts, F.lit("\ntrailer <</Root 1 0 R>>\n%%EOF")), "UTF-8")


def pdf_text_roundtrip(spark, sf_dir):
    """Every text is written as a PDF file and read back."""
    d = spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").cast("string").alias("doc_id"), render_pdf(F.coalesce("text", F.lit(""))).alias("pdf_buffer"), F.lit(None).cast("string").alias("content"))
    got = files.extract_text(settle(d, {"pdf_buffer": F.col("pdf_buffer")}))
    return got.select("doc_id", "status", "extraction_method", F.col("text_length").cast("long").alias("text_length"), F.md5("text").alias("text_md5"))


def validation_report_text(spark, sf_dir):
    rows = worklist_rows(spark, sf_dir)
    return report.validation_report(validation.validate_worklist(rows))


def processing_statistics(spark, sf_dir):
    """Statistics of the records, as if a second reading had found every third one's city."""
    rows = records(spark, sf_dir)
    p = F.col("patient")
    after = rows.withColumn("patient", F.struct(*(F.when(F.col("ordinal") % 3 == 0, "Troy").otherwise(p[f]).alias(f) if f == "city" else p[f].alias(f) for f in PATIENT_FIELDS)).cast(PATIENT))
    groups = rows.select("ordinal", F.col("doc_id").alias("group_id"))
    one = report.processing_statistics(rows, groups, report.fields_enhanced(rows, after))
    return one.select("total", "successful", "failed", "second_extractions", "duplicates_found", F.col("fields_enhanced").cast("long").alias("fields_enhanced"), *(F.round(c, 6).alias(c) for c in ("success_rate", "second_rate", "average_enhancements")))


def record_summary_line(spark, sf_dir):
    rows = records(spark, sf_dir)
    return rows.select("ordinal", report.summary_line(F.struct(*rows.columns)).alias("line"))


def engine_choice(spark, sf_dir):
    """Three engines' qualities, made from the document's number."""
    k = F.col("doc_id")
    one = lambda name, n: F.struct(((k % n) / float(n)).alias("quality"), F.lit(name).alias("method"))
    best = files.best_engine(one("first", 10), one("second", 7), one("ocr", 3))
    return table(spark, sf_dir, "documents").select("doc_id", best["method"].alias("method"), F.round(best["quality"], 9).alias("quality"))


#: Forms of a date: in Spark's patterns, with text around it in quotes.
FREE_FORMS = ("d MMMM yyyy", "MMMM d'th', yyyy", "'the' d'th of' MMMM yyyy", "EEEE, MMMM d, yyyy", "yyyy MMM d", "yyyyMMdd", "yyyy-MM-dd'T'10:20:30", "M/d/yyyy '10:30 AM'", "dd-MMM-yyyy", "yyyy.MM.dd", "EEE d MMM yyyy 'at 9:05'", "MMM. d, yyyy")


def date_free_form(spark, sf_dir):
    """Every order's date, written in one of twelve forms, some with a month's name alone or no date at all."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    written = F.lit("no date")
    for i, form in enumerate(FREE_FORMS):
        written = F.when(k % 14 == i, F.date_format(d, form)).otherwise(written)
    written = F.when(k % 14 == 12, F.date_format(d, "MMMM yyyy")).otherwise(written)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(dates.normalize_worklist_date(written), F.lit("none")).alias("date"))


def encoding_detect(spark, sf_dir):
    """Texts as bytes, in Latin-1 where that has all their characters, and back by what the bytes look like.

    A reader drops the mark before UTF-8, so a text that begins with that character gets one more.
    """
    text = F.coalesce("text", F.lit(""))
    marked = F.when(text.startswith("\ufeff"), F.concat(F.lit("\ufeff"), text)).otherwise(text)
    raw = F.when(F.rlike(text, F.lit(r"^[\x00-\x7F\xA0-\xFF]*\z")), F.encode(text, "ISO-8859-1")).otherwise(F.encode(marked, "UTF-8"))
    d = settle(spread(table(spark, sf_dir, "documents")).select("doc_id", raw.alias("raw")), {"got": encoding.decoded(F.col("raw"))})
    return d.select("doc_id", F.col("got.encoding").alias("encoding"), F.md5("got.text").alias("text_md5"), (F.col("got.confidence") >= encoding.LEAST).alias("sure"))


def extraction_summary(spark, sf_dir):
    s = report.extraction_summary(document_extraction(spark, sf_dir))
    return s.select("total", "extracted", "digital", "ocr", F.round("avg_quality", 9).alias("avg_quality"), "total_chars")


def document_router(spark, sf_dir):
    return document_extraction(spark, sf_dir).select("doc_id", "status", "extraction_method", "error", F.round("quality_score", 9).alias("quality_score"))


def doc_quality_score(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    ascii_only = F.regexp_replace("text", r"[^\x00-\x7F]", "x")
    return d.select("doc_id", F.round(T.quality(ascii_only), 6).alias("quality"), F.round(T.length_quality(F.col("text")), 9).alias("length_quality"))


def doc_scanned_flag(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.looks_scanned(F.col("text")).alias("scanned"), F.round(T.distinct_line_share(F.col("text")), 9).alias("distinct_lines"))


def doc_phone_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", extract.phone_number(F.col("text")).alias("phone"))


def records_standardize(spark, sf_dir):
    """Records written in other cases and forms, put in standard ones."""
    rows, p = records(spark, sf_dir), F.col("patient")
    other = {"patient_fname": F.lower(p["patient_fname"]), "patient_lname": F.upper(p["patient_lname"]), "patient_sex": F.lower(p["patient_sex"]), "phone_number": F.regexp_replace(p["phone_number"], r"\D", "")}
    rows = settle(rows, {"patient": with_fields(p, PATIENT, other)})
    got = settle(rows, {"s": merge.standardize_records(F.col("patient"), F.col("order"))})
    a, b = F.col("s.patient"), F.col("s.order")
    return got.select("ordinal", a["patient_fname"].alias("fname"), a["patient_lname"].alias("lname"), a["dob"].alias("dob"), a["patient_sex"].alias("sex"), a["phone_number"].alias("phone"), b["order_date"].alias("order_date"), b["physician_name"].alias("physician"))


def best_engine(spark, sf_dir):
    k = F.col("c_custkey")
    three = F.array(*(F.struct((k * m % 7 / 7).alias("quality"), F.lit(n).alias("engine")) for m, n in ((1, "a"), (3, "b"), (5, "c"))))
    return table(spark, sf_dir, "customer").select("c_custkey", files.best_of(three)["engine"].alias("engine"))


def full_pipeline_report(spark, sf_dir):
    """The whole plan over rendered documents: parse, enhance, merge, fill, validate, count."""
    w = worklist_rows(spark, sf_dir)
    last = lookup.keyed_last(w.select("doc_id", "patient", "received_on", "facility", "row_number"), "doc_id", "row_number")
    work = last.select(F.col("doc_id").alias("ID"), F.col("patient").alias("Patient"), F.col("received_on").alias("Received On"), F.col("facility").alias("Facility"))
    got = pipeline.run(order_documents(spark, sf_dir), work)
    return got.validated.select("doc_id", "status", "extraction_method", F.size("errors").alias("n_errors"), F.col("order.order_no").alias("order_no"), F.col("patient.medical_record_no").alias("mrn"))


QUERIES = {f.__name__: f for f in (
    order_doc_roundtrip, completeness_score, confidence_score, parse_decision, fill_missing_merge, anti_new_diagnoses, diagnosis_slots6, export_41, completeness_report, valid_invalid_split, first_per_doc, dup_keys, dup_groups, dup_groups_greedy,
    dup_merge_best, dup_members, dup_report, existing_patients_anti, similar_pairs_theta, worklist_validate, worklist_summary, worklist_last_wins, header_canonicalize, lookup_join_fallback_key, company_lookup_case_insensitive, backfill_rules,
    tracking_remarks, api_overwrite, bucket_histogram, summary_recommendations, fill_rate_by_field, low_fill_fields, field_samples_top3, field_samples_masked, error_prefix_counts, method_counts, fetch_summary, extraction_summary, document_router, pdf_text_roundtrip, date_free_form, encoding_detect, validation_report_text, processing_statistics, record_summary_line, engine_choice,
    doc_quality_score, doc_scanned_flag, doc_phone_extract, records_standardize, best_engine, full_pipeline_report,
)}

_DUP = """keys AS (
  SELECT ordinal, unnest(list_filter([
    CASE WHEN trim(fname || ' ' || lname) <> '' AND dob <> '' THEN 'name_dob:' || upper(trim(fname || ' ' || lname)) || ':' || dob END,
    CASE WHEN mrn <> '' THEN 'mrn:' || mrn END,
    CASE WHEN lname <> '' AND dob <> '' THEN 'lastname_dob:' || upper(lname) || ':' || dob END], lambda x: x IS NOT NULL)) AS key
  FROM r)"""
_SLOTS = "list_concat(CASE WHEN primary_diagnosis <> '' THEN [code] ELSE [] END, {second} CASE WHEN listed THEN [code] ELSE [] END, ['', '', '', '', '', ''])"
_FIELD_SQL = {"fname": "patient_fname", "lname": "patient_lname", "dob": "dob", "sex": "patient_sex", "mrn": "medical_record_no", "phone": "phone_number", "account": "account_number"}
_ORDER_FIELD_SQL = {"order_no": "order_no", "order_date": "order_date", "episode_start": "episode_start_date", "physician": "physician_name", "primary_diagnosis": "primary_diagnosis", "soc": "start_of_care"}
_CELLS = " UNION ALL ".join(
    [f"SELECT 'patient' AS record, '{n}' AS field, ordinal, {c} AS value FROM r WHERE ok" for c, n in _FIELD_SQL.items()]
    + [f"SELECT 'order' AS record, '{n}' AS field, ordinal, {c} AS value FROM r WHERE ok" for c, n in _ORDER_FIELD_SQL.items()]
    + ["SELECT 'order' AS record, 'episode_diagnoses' AS field, ordinal, CASE WHEN listed THEN 'Condition ' || k % 9 ELSE '' END AS value FROM r WHERE ok"]
)
_RATES = f"cells AS ({_CELLS}), rates AS (SELECT record, field, count(*) FILTER (WHERE value <> '') AS filled, count(*) AS total, count(*) FILTER (WHERE value <> '') / count(*)::DOUBLE * 100 AS percentage FROM cells GROUP BY ALL)"
_SAMPLES = "SELECT record, field, string_agg({value}, ', ' ORDER BY ordinal) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY record, field ORDER BY ordinal) AS n FROM cells WHERE value <> '') WHERE n <= 3 AND field IN ({fields}) GROUP BY ALL"
_WORK = f"""{_PEOPLE}, w AS (
  SELECT c_custkey AS row_number, 'D' || (c_custkey % 1000) AS doc_id, last || ', ' || first AS patient, CASE WHEN c_custkey % 10 = 0 THEN ' ' ELSE 'new' END AS status,
    CASE WHEN c_custkey % 9 = 0 THEN '13/45/2025' WHEN c_custkey % 9 = 1 THEN '' ELSE strftime(DATE '2024-01-01' + (c_custkey % 300)::INTEGER, '%m/%d/%Y') END AS received, {sql_pick(FACILITIES, 'c_custkey')} AS facility
  FROM people)"""
_LINES = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^[\\s]+|[\\s]+$', '', 'g'))), lambda x: x <> '')"
_ERRORS = "list_filter([" + ", ".join(
    [f"CASE WHEN {c} = '' THEN 'Missing patient field: ''{n}''' END" for c, n in (("fname", "patient_fname"), ("lname", "patient_lname"), ("dob", "dob"), ("mrn", "medical_record_no"), ("sex", "patient_sex"))]
    + ["CASE WHEN sex NOT IN ('MALE', 'FEMALE') THEN 'Invalid patient_sex ''' || sex || ''' (allowed: MALE/FEMALE)' END"]
    + [f"CASE WHEN {c} = '' THEN 'Missing order field: ''{n}''' END" for c, n in (("order_no", "order_no"), ("order_date", "order_date"), ("episode_start", "episode_start_date"), ("soc", "start_of_care"), ("physician", "physician_name"), ("primary_diagnosis", "primary_diagnosis"))]
    + ["CASE WHEN NOT regexp_full_match(order_date, '\\d{2}/\\d{2}/\\d{4}') THEN 'Invalid date format in ''order_date'': ''' || order_date || ''' (expected MM/DD/YYYY)' END"]
) + "], lambda x: x IS NOT NULL)"
_EXPORT = {"Document_ID": "doc_id", "Timestamp": f"'{TS}'", "Patient_ID": "CASE WHEN account LIKE '0%' THEN '''' || account ELSE account END", "Patient_First_Name": "fname", "Patient_Last_Name": "lname", "Patient_DOB": "dob", "Patient_Sex": "sex", "Medical_Record_No": "mrn", "Patient_Phone": "phone", "Order_Number": "order_no", "Order_Date": "order_date", "Start_Of_Care": "soc", "Episode_Start_Date": "episode_start", "SOC_Episode": "soc", "Start_Episode": "episode_start", **{f"Diagnosis_{k}": f"slots[{k}]" for k in range(1, 7)}, "API_Status": "'SUCCESS'", "Error_Message": "error", "Remarks": "printf('Confidence: %.3f, Completeness: %.3f, Method: %s', conf, compl, method)"}
_PRESENT = "2 + " + " + ".join(f"(CASE WHEN {c} <> '' THEN 1 ELSE 0 END)" for c in ("CASE WHEN mrn <> '' THEN mrn ELSE account END", "fname", "lname", "dob", "sex", "mrn", "phone", "order_no", "order_date", "soc", "episode_start", "primary_diagnosis")) + " + (CASE WHEN listed THEN 1 ELSE 0 END)"

ORACLE_SQL = {
    "order_doc_roundtrip": _ORDER_DOC_SQL,
    "completeness_score": f"WITH {_RECORDS}, f AS (SELECT ordinal, ({_FILLED_P}) / 27.0::DOUBLE AS p, ({_FILLED_O} + CASE WHEN listed THEN 1 ELSE 0 END) / 30.0::DOUBLE AS o FROM r) SELECT ordinal, p AS patient_completeness, o AS order_completeness, p * 0.6::DOUBLE + o * 0.4::DOUBLE AS completeness FROM f",
    "confidence_score": f"WITH {_RECORDS}, f AS (SELECT ordinal, ({_FILLED_P}) / 27.0::DOUBLE * 0.4::DOUBLE + ({_FILLED_O} + CASE WHEN listed THEN 1 ELSE 0 END) / 30.0::DOUBLE * 0.4::DOUBLE + ({_CRITICAL}) / 11.0::DOUBLE * 0.2::DOUBLE AS q FROM r) SELECT ordinal, round(0.8::DOUBLE * q, 9) AS structured, round(0.7::DOUBLE * q, 9) AS secondary FROM f",
    "parse_decision": f"""WITH {_RECORDS}, f AS (SELECT *, conf * 0.5::DOUBLE AS c, compl * 0.4::DOUBLE AS m, fname <> '' OR lname <> '' OR dob <> '' AS named FROM r),
      g AS (SELECT *, (c > 0.15::DOUBLE AND m > 0.1::DOUBLE AND named) OR (c > 0.3::DOUBLE AND m > 0.2::DOUBLE) AS success FROM f)
      SELECT ordinal, CASE WHEN NOT ok THEN 'none' WHEN k % 17 = 0 THEN 'llm' ELSE 'structured' END AS source,
        CASE WHEN NOT ok THEN 'failed' WHEN k % 17 = 0 OR success OR c > 0.1::DOUBLE OR m > 0.15::DOUBLE THEN 'parsed' ELSE 'failed' END AS status,
        CASE WHEN NOT ok THEN 'none' WHEN k % 17 = 0 THEN 'enhanced_llm' WHEN success THEN 'enhanced_structured' WHEN c > 0.1::DOUBLE OR m > 0.15::DOUBLE THEN 'enhanced_structured_fallback' ELSE 'enhanced_structured_failed' END AS method,
        CASE WHEN NOT ok THEN 'No valid text extracted' WHEN k % 17 = 0 OR success THEN '' WHEN c > 0.1::DOUBLE OR m > 0.15::DOUBLE THEN CASE WHEN c <= 0.3::DOUBLE * 0.8::DOUBLE THEN 'Low confidence extraction' ELSE '' END ELSE 'Low confidence extraction' END AS error FROM g""",
    "fill_missing_merge": f"WITH {_RECORDS} SELECT ordinal, CASE WHEN fname <> '' THEN fname ELSE 'Second' END AS patient_fname, lname AS patient_lname, CASE WHEN dob <> '' THEN dob ELSE '01/01/1901' END AS dob, 'a@b.c' AS email, CASE WHEN mrn <> '' THEN mrn ELSE ' ' END AS medical_record_no FROM r",
    "anti_new_diagnoses": f"WITH {_RECORDS} SELECT ordinal, CASE WHEN listed THEN 'Condition ' || k % 9 || '|' ELSE '' END || CASE WHEN listed AND k % 9 = 3 THEN '' ELSE 'CONDITION 3|' END || 'Other|Other' AS descriptions FROM r",
    "diagnosis_slots6": f"WITH {_RECORDS}, s AS (SELECT ordinal, {_SLOTS.format(second=chr(91) + chr(39) * 2 + chr(93) + ',')} AS slots FROM r) SELECT ordinal, " + ", ".join(f"slots[{k}] AS slot{k}" for k in range(1, 7)) + " FROM s",
    "export_41": f"WITH {_RECORDS}, s AS (SELECT *, {_SLOTS.format(second='')} AS slots, row_number() OVER (PARTITION BY doc_id ORDER BY ordinal) AS n FROM r WHERE ok) SELECT " + ", ".join(f"{_EXPORT.get(c, repr(''))} AS {c}" for c in EXPORT_COLUMNS) + " FROM s WHERE n = 1",
    "completeness_report": f"WITH {_RECORDS}, s AS (SELECT *, {_PRESENT} AS present, list_concat(CASE WHEN primary_diagnosis <> '' THEN [primary_diagnosis] ELSE [] END, CASE WHEN listed THEN [code] ELSE [] END, ['', '']) AS slots FROM r) SELECT doc_id AS Document_ID, present::INTEGER AS Fields_Present, ({len(COMPLETENESS_COLUMNS)} - present)::INTEGER AS Fields_Missing, round(present / {len(COMPLETENESS_COLUMNS)}.0::DOUBLE * 100, 1) AS Pct_Complete, CASE WHEN mrn <> '' THEN mrn ELSE account END AS Patient_ID, slots[1] AS Diagnosis_1, slots[2] AS Diagnosis_2 FROM s",
    "valid_invalid_split": f"WITH {_RECORDS}, e AS (SELECT ordinal, {_ERRORS} AS errors FROM r) SELECT ordinal, len(errors) = 0 AS is_valid, array_to_string(errors, '; ') AS errors FROM e",
    "first_per_doc": f"WITH {_RECORDS} SELECT doc_id, min(ordinal) AS ordinal FROM r GROUP BY doc_id",
    "dup_keys": f"WITH {_RECORDS}, {_DUP} SELECT key, count(*) AS n, min(ordinal) AS first FROM keys GROUP BY key",
    "dup_merge_best": f"""WITH {_RECORDS}, s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY conf DESC, ordinal) AS n FROM r)
      SELECT doc_id, max(CASE WHEN n = 1 THEN ordinal END) AS ordinal, coalesce(arg_min(fname, n) FILTER (WHERE fname <> ''), '') AS fname, coalesce(arg_min(dob, n) FILTER (WHERE dob <> ''), '') AS dob, coalesce(arg_min(phone, n) FILTER (WHERE phone <> ''), '') AS phone, max(conf) AS confidence_score FROM s GROUP BY doc_id""",
    "dup_members": f"WITH {_RECORDS}, {_DUP} SELECT ordinal, doc_id FROM r WHERE ordinal IN (SELECT ordinal FROM keys WHERE key IN (SELECT key FROM keys GROUP BY key HAVING count(DISTINCT ordinal) > 1))",
    "dup_groups": f"""WITH RECURSIVE {_RECORDS}, {_DUP}, least AS (SELECT key, min(ordinal) AS low FROM keys GROUP BY key HAVING count(DISTINCT ordinal) > 1),
      links AS (SELECT DISTINCT ordinal AS a, low AS b FROM keys JOIN least USING (key)), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
      reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
      SELECT a AS ordinal, min(b) AS group_id FROM reach GROUP BY a""",
    "dup_groups_greedy": f"""WITH {_RECORDS}, {_DUP}, kinds AS (SELECT ordinal, key, split_part(key, ':', 1) AS kind FROM keys),
      first AS (SELECT ordinal, key, kind FROM kinds QUALIFY row_number() OVER (PARTITION BY ordinal ORDER BY CASE kind WHEN 'name_dob' THEN 0 WHEN 'mrn' THEN 1 ELSE 2 END) = 1),
      by_mrn AS (SELECT key, min(ordinal) AS since FROM first WHERE kind = 'mrn' GROUP BY key),
      taken AS (SELECT ordinal FROM kinds JOIN by_mrn USING (key) WHERE since < ordinal),
      founded AS (SELECT key, since FROM by_mrn UNION ALL SELECT key, min(ordinal) FROM first WHERE kind = 'name_dob' AND ordinal NOT IN (SELECT ordinal FROM taken) GROUP BY key),
      joined AS (SELECT ordinal, key AS group_key FROM kinds JOIN founded USING (key) WHERE since <= ordinal QUALIFY row_number() OVER (PARTITION BY ordinal ORDER BY CASE kind WHEN 'name_dob' THEN 0 ELSE 1 END) = 1)
      SELECT ordinal, group_key FROM joined QUALIFY count(*) OVER (PARTITION BY group_key) > 1""",
    "similar_pairs_theta": f"""WITH RECURSIVE {_PEOPLE}, p AS (
        SELECT c_custkey AS k, upper(CASE c_custkey % 3 WHEN 0 THEN first WHEN 1 THEN first || {sql_pick(ENDINGS, 'c_custkey')} ELSE {sql_pick(SECOND, 'c_custkey')} || ' ' || first END) AS name,
               CASE WHEN c_custkey % 4 = 0 THEN strftime(dob, '%m/%d/%Y') ELSE '' END AS born, CASE WHEN c_custkey % 5 = 0 THEN lpad((c_custkey % 500)::VARCHAR, 6, '0') ELSE '' END AS number FROM people),
      names AS (SELECT DISTINCT name FROM p), pairs AS (SELECT a.name AS x, b.name AS y FROM names a, names b),
      starts AS (SELECT x, y, i.i, j.j FROM pairs, LATERAL (SELECT unnest(range(1, length(x) + 1)) AS i) i, LATERAL (SELECT unnest(range(1, length(y) + 1)) AS j) j WHERE substr(x, i.i, 1) = substr(y, j.j, 1)),
      blocks AS (SELECT x, y, i, j, l.l FROM starts, LATERAL (SELECT unnest(range(1, length(x) + 1)) AS l) l WHERE i + l.l - 1 <= length(x) AND j + l.l - 1 <= length(y) AND substr(x, i, l.l) = substr(y, j, l.l)),
      parts(x, y, xa, xb, ya, yb) AS (
        SELECT x, y, 1, length(x), 1, length(y) FROM pairs
        UNION ALL
        SELECT x, y, CASE WHEN side = 0 THEN xa ELSE i + l END, CASE WHEN side = 0 THEN i - 1 ELSE xb END, CASE WHEN side = 0 THEN ya ELSE j + l END, CASE WHEN side = 0 THEN j - 1 ELSE yb END
        FROM (SELECT s.*, b.i, b.j, b.l, row_number() OVER (PARTITION BY s.x, s.y, s.xa, s.xb, s.ya, s.yb ORDER BY b.l DESC, b.i, b.j) AS n
              FROM parts s JOIN blocks b ON b.x = s.x AND b.y = s.y AND b.i >= s.xa AND b.i + b.l - 1 <= s.xb AND b.j >= s.ya AND b.j + b.l - 1 <= s.yb) t, (VALUES (0), (1)) v(side)
        WHERE n = 1),
      matched AS (SELECT s.x, s.y, s.xa, s.xb, s.ya, s.yb, max(b.l) AS l FROM parts s JOIN blocks b ON b.x = s.x AND b.y = s.y AND b.i >= s.xa AND b.i + b.l - 1 <= s.xb AND b.j >= s.ya AND b.j + b.l - 1 <= s.yb GROUP BY ALL),
      ratios AS (SELECT x, y, 2.0::DOUBLE * coalesce(sum(l), 0) / (length(x) + length(y)) AS ratio FROM pairs LEFT JOIN matched USING (x, y) GROUP BY x, y),
      alike AS (SELECT x, y, CASE WHEN split_part(x, ' ', -1) = split_part(y, ' ', -1) THEN least(1.0::DOUBLE, ratio + 0.2::DOUBLE) ELSE ratio END AS s FROM ratios),
      scored AS (
        SELECT q.k AS query_ordinal, e.k AS ordinal,
               (0.4::DOUBLE * s + CASE WHEN q.born <> '' AND q.born = e.born THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN q.number <> '' AND q.number = e.number THEN 0.2::DOUBLE ELSE 0 END)
               / (0.4::DOUBLE + CASE WHEN q.born <> '' AND e.born <> '' THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN q.number <> '' AND e.number <> '' THEN 0.2::DOUBLE ELSE 0 END) AS score
        FROM p q JOIN p e ON q.k % 100 = 0 JOIN alike ON x = q.name AND y = e.name)
      SELECT query_ordinal, row_number() OVER (PARTITION BY query_ordinal ORDER BY score DESC, ordinal) AS rank, ordinal, round(score, 9) AS score FROM scored WHERE score > 0.7::DOUBLE""",
    "dup_report": f"""WITH {_RECORDS} SELECT doc_id AS group_id, count(*) AS size, string_agg('Document: ' || doc_id || ', Name: ' || CASE WHEN fname <> '' THEN fname ELSE 'Unknown' END || ', DOB: ' || CASE WHEN dob <> '' THEN dob ELSE 'Unknown' END || ', MRN: ' || CASE WHEN mrn <> '' THEN mrn ELSE 'Unknown' END || ', Confidence: ' || printf('%.2f', conf), chr(10) ORDER BY ordinal) AS members FROM r GROUP BY doc_id""",
    "existing_patients_anti": f"WITH {_RECORDS} SELECT ordinal FROM r WHERE mrn = '' OR mrn NOT IN (SELECT mrn FROM people WHERE c_custkey % 2 = 0)",
    "worklist_validate": f"""WITH {_WORK}, e AS (SELECT *, list_filter([CASE WHEN received = '' THEN 'Missing received_on' WHEN received = '13/45/2025' THEN 'Invalid date format in received_on' END, CASE WHEN trim(status) = '' THEN 'Missing status' END], lambda x: x IS NOT NULL) AS errors FROM w)
      SELECT row_number, doc_id, patient, CASE WHEN received <> '' THEN received END AS received_on, len(errors) = 0 AS is_valid, array_to_string(errors, '; ') AS errors FROM e""",
    "worklist_summary": f"WITH {_WORK}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE received NOT IN ('', '13/45/2025') AND trim(status) <> '') AS valid FROM w) SELECT total, valid, total - valid AS invalid, round(valid / greatest(total, 1)::DOUBLE * 100, 1) AS success_rate FROM c",
    "worklist_last_wins": f"WITH {_WORK} SELECT doc_id, arg_max(patient, row_number) AS patient, max(row_number) AS row_number FROM w GROUP BY doc_id",
    "header_canonicalize": "SELECT r_regionkey, header, canonical FROM region, (VALUES ('ID', 'doc_id'), ('document_id', 'document_id'), ('Patient Name', 'patient'), ('patient_name', 'patient'), ('Received-On', 'received_on'), ('SOC', 'soc'), ('Other', 'Other')) v(header, canonical)",
    "lookup_join_fallback_key": f"WITH {_PEOPLE} SELECT o_orderkey AS k, c_custkey::VARCHAR AS id, last FROM orders LEFT JOIN people ON c_custkey = o_orderkey % 2000",
    "company_lookup_case_insensitive": f"WITH {_WORK} SELECT row_number, CASE facility WHEN 'Alpha Care' THEN 'c1' WHEN 'Beta Care' THEN 'c2' WHEN 'delta care' THEN 'c4' END AS company_id FROM w",
    "backfill_rules": f"""WITH {_RECORDS}, w AS (SELECT 'D' || (c_custkey % 1000) AS wid, arg_max(first, c_custkey) AS wfirst, max(c_custkey) AS ck FROM people GROUP BY 1),
      x AS (SELECT r.*, w.wid, w.wfirst, {sql_pick(FACILITIES, 'w.ck')} AS wfac, CASE WHEN w.ck % 9 < 2 THEN '' ELSE strftime(DATE '2024-01-01' + (w.ck % 300)::INTEGER, '%m/%d/%Y') END AS wdate, CASE WHEN episode_start <> '' THEN episode_start ELSE order_date END AS es FROM r LEFT JOIN w ON r.doc_id = w.wid)
      SELECT ordinal, CASE WHEN fname <> '' THEN fname ELSE coalesce(wfirst, '') END AS fname, CASE WHEN mrn <> '' THEN mrn ELSE coalesce(wid, '') END AS mrn,
        CASE WHEN wid IS NOT NULL THEN substr(wid, 2) WHEN order_no <> '' THEN order_no ELSE substr(doc_id, 2) END AS order_no,
        strftime(d, '%m/%d/%Y') AS order_date, es AS episode_start, strftime(d + 59, '%m/%d/%Y') AS episode_end, CASE WHEN soc <> '' THEN soc ELSE es END AS soc,
        CASE WHEN primary_diagnosis <> '' THEN primary_diagnosis WHEN listed THEN 'Condition ' || k % 9 ELSE '' END AS diagnosis,
        CASE WHEN listed OR primary_diagnosis <> '' THEN 1 ELSE 0 END::INTEGER AS listed, coalesce(wfac, '') AS facility FROM x""",
    "tracking_remarks": """WITH s AS (SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 201 WHEN 1 THEN 200 ELSE 500 END AS p, CASE o_orderkey % 4 WHEN 0 THEN 201 WHEN 1 THEN 409 WHEN 2 THEN 400 ELSE 200 END AS o FROM orders)
      SELECT k, CASE WHEN p = 500 THEN CASE WHEN k % 2 = 0 THEN 'Patient push failed: bad request' ELSE 'Patient push failed (see API for details)' END
        WHEN o = 400 THEN CASE WHEN k % 2 = 0 THEN 'Order push failed: bad request' ELSE 'Order push failed (see API for details)' END
        WHEN o = 409 THEN 'Patient created successfully, order already exists (duplicate order)' WHEN p = 201 AND o = 201 THEN 'Patient and order both created successfully'
        ELSE 'Patient and order push succeeded (patient_status=' || p || ', order_status=' || o || ')' END AS remarks FROM s""",
    "api_overwrite": f"WITH {_RECORDS} SELECT ordinal, CASE WHEN ordinal % 2 = 0 THEN 'New' ELSE '' END AS city, lname FROM r",
    "bucket_histogram": f"""WITH {_RECORDS} SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS parsed, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE ok AND k % 4 <> 1) AS structured, count(*) FILTER (WHERE ok AND k % 4 = 1) AS secondary,
        count(*) FILTER (WHERE ok AND k % 10 >= 8) AS high_confidence, count(*) FILTER (WHERE ok AND k % 10 BETWEEN 5 AND 7) AS medium_confidence, count(*) FILTER (WHERE ok AND k % 10 < 5) AS low_confidence,
        count(*) FILTER (WHERE ok AND k % 8 >= 6) AS high_completeness, count(*) FILTER (WHERE ok AND k % 8 BETWEEN 4 AND 5) AS medium_completeness, count(*) FILTER (WHERE ok AND k % 8 < 4) AS low_completeness,
        round(avg(conf) FILTER (WHERE ok), 9) AS avg_confidence, round(avg(compl) FILTER (WHERE ok), 9) AS avg_completeness, round(count(*) FILTER (WHERE ok) / count(*)::DOUBLE * 100, 9) AS parsed_pct, sum(t) AS time_total, round(avg(t), 9) AS time_avg, min(t) FILTER (WHERE t > 0) AS time_min, max(t) AS time_max FROM r""",
    "summary_recommendations": f"WITH {_RECORDS}, s AS (SELECT avg(conf) FILTER (WHERE ok) AS a, avg(compl) FILTER (WHERE ok) AS b, count(*) FILTER (WHERE ok AND k % 4 <> 1) / count(*) FILTER (WHERE ok)::DOUBLE AS st FROM r) SELECT array_to_string(list_filter([CASE WHEN a < 0.6 THEN 'Average confidence is low - consider improving text extraction quality' END, CASE WHEN b < 0.5 THEN 'Average completeness is low - review field extraction patterns' END, CASE WHEN st < 0.7 THEN 'Many documents required LLM fallback - consider enhancing structured parser' END], lambda x: x IS NOT NULL), '|') AS recommendations FROM s",
    "fill_rate_by_field": f"""WITH {_RECORDS}, {_RATES}, every AS (SELECT 'patient' AS record, unnest({list(PATIENT_FIELDS)}) AS field UNION ALL SELECT 'order', unnest({[*ORDER_FIELDS, 'episode_diagnoses']})),
      whole AS (SELECT record, field, coalesce(filled, 0) AS filled, (SELECT max(total) FROM rates) AS total, coalesce(percentage, 0::DOUBLE) AS percentage FROM every LEFT JOIN rates USING (record, field))
      SELECT record, field, filled, total, round(percentage, 9) AS percentage, CASE WHEN percentage >= 70 THEN 'Good' WHEN percentage >= 30 THEN 'Fair' ELSE 'Poor' END AS rating FROM whole""",
    "low_fill_fields": f"WITH {_RECORDS}, {_RATES} SELECT record, field FROM rates WHERE field IN ('patient_fname', 'patient_lname', 'dob', 'order_date', 'physician_name') AND percentage < 70",
    "field_samples_top3": f"WITH {_RECORDS}, {_RATES} " + _SAMPLES.format(value="value", fields="'patient_fname', 'dob', 'order_no', 'physician_name', 'episode_diagnoses'"),
    "field_samples_masked": f"WITH {_RECORDS}, {_RATES} " + _SAMPLES.format(value="regexp_replace(regexp_replace(value, '[A-Za-z]', 'x', 'g'), '[0-9]', '9', 'g')", fields="'medical_record_no', 'phone_number'"),
    "error_prefix_counts": f"WITH {_RECORDS} SELECT split_part(error, ':', 1) AS error_type, count(*) AS documents FROM r WHERE NOT ok GROUP BY 1",
    "method_counts": f"WITH {_RECORDS} SELECT method AS extraction_method, count(*) AS documents FROM r WHERE ok GROUP BY 1",
    "fetch_summary": "WITH s AS (SELECT count(*) AS total, count(*) FILTER (WHERE doc_id % 10 <> 0) AS success, coalesce(sum(strlen(text)) FILTER (WHERE doc_id % 10 <> 0), 0)::BIGINT AS bytes FROM documents) SELECT total, success, bytes, total - success AS failed, round(success / greatest(total, 1)::DOUBLE * 100, 2) AS success_rate, round(bytes / 1048576.0::DOUBLE, 2) AS total_mb, round(bytes / 1024.0::DOUBLE / greatest(success, 1), 2) AS avg_kb FROM s",
    "extraction_summary": "WITH s AS (SELECT text, doc_id % 7 <> 0 AND regexp_replace(text, '\\s', '', 'g') <> '' AS ok FROM documents) SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS extracted, 0::BIGINT AS digital, 0::BIGINT AS ocr, round(avg(least(length(text) / 5000.0::DOUBLE, 1)) FILTER (WHERE ok), 9) AS avg_quality, (sum(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) FILTER (WHERE ok))::BIGINT AS total_chars FROM s",
    "pdf_text_roundtrip": r"""WITH s AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM documents)
      SELECT doc_id::VARCHAR AS doc_id, CASE WHEN t <> '' THEN 'extracted' ELSE 'failed' END AS status, CASE WHEN t <> '' THEN 'digital' ELSE 'none' END AS extraction_method, length(t)::BIGINT AS text_length, md5(t) AS text_md5 FROM s""",
    "date_free_form": "SELECT o_orderkey, CASE o_orderkey % 14 WHEN 13 THEN 'none' WHEN 12 THEN strftime(o_orderdate, '%m/01/%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END AS date FROM orders",
    "encoding_detect": r"""SELECT doc_id, CASE WHEN regexp_full_match(t, '[\x00-\x7F]*') THEN 'ascii' WHEN regexp_full_match(t, '[\x00-\x7F\x{A0}-\x{FF}]*') THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding, md5(t) AS text_md5, true AS sure
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "validation_report_text": f"""WITH {_WORK}, e AS (SELECT row_number AS n, list_filter([CASE WHEN received = '' THEN 'Missing received_on' WHEN received = '13/45/2025' THEN 'Invalid date format in received_on' END, CASE WHEN trim(status) = '' THEN 'Missing status' END], lambda x: x IS NOT NULL) AS errors FROM w),
      c AS (SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid FROM e), bad AS (SELECT n, array_to_string(errors, ', ') AS said FROM e WHERE len(errors) > 0 ORDER BY n LIMIT 20)
      SELECT 'Input Reader - Validation Report' || chr(10) || repeat('=', 40) || chr(10) || chr(10) || 'Total rows: ' || total || chr(10) || 'Valid rows: ' || valid || chr(10) || 'Invalid rows: ' || (total - valid) || chr(10) || 'Success rate: ' || round(valid / greatest(total, 1)::DOUBLE * 100, 1) || '%'
        || CASE WHEN total > valid THEN chr(10) || chr(10) || 'Invalid Rows:' || chr(10) || repeat('-', 20) || chr(10) || (SELECT string_agg('Row ' || n || ': ' || said, chr(10) ORDER BY n) FROM bad) ELSE '' END
        || CASE WHEN total - valid > 20 THEN chr(10) || '... and ' || (total - valid - 20) || ' more invalid rows' ELSE '' END AS value FROM c""",
    "processing_statistics": f"""WITH {_RECORDS} SELECT count(*) AS total, count(*) FILTER (ok) AS successful, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (ok AND k % 4 = 1) AS second_extractions, count(DISTINCT doc_id) AS duplicates_found, count(*) FILTER (k % 3 = 0) AS fields_enhanced,
      round(count(*) FILTER (ok) / count(*)::DOUBLE * 100, 6) AS success_rate, round(count(*) FILTER (ok AND k % 4 = 1) / count(*)::DOUBLE * 100, 6) AS second_rate, round(count(*) FILTER (k % 3 = 0) / count(*)::DOUBLE, 6) AS average_enhancements FROM r""",
    "record_summary_line": f"WITH {_RECORDS} SELECT ordinal, CASE WHEN NOT ok THEN 'Failed: ' || error ELSE concat_ws(' ', nullif(fname, ''), nullif(lname, '')) || ' - ' || CASE WHEN order_no <> '' THEN 'Order #' || order_no ELSE 'No order number' END || ' (Confidence: ' || printf('%.2f', conf) || ')' END AS line FROM r",
    "engine_choice": """WITH q AS (SELECT doc_id, (doc_id % 10) / 10.0::DOUBLE AS a, (doc_id % 7) / 7.0::DOUBLE AS b, (doc_id % 3) / 3.0::DOUBLE AS c FROM documents), two AS (SELECT *, a > 0 AND a < 0.6 AND b > a AS second, CASE WHEN a > 0 AND a < 0.6 AND b > a THEN b ELSE a END AS best FROM q)
      SELECT doc_id, CASE WHEN best < 0.25 AND c > best THEN 'ocr' WHEN second THEN 'second' ELSE 'first' END AS method, round(CASE WHEN best < 0.25 AND c > best THEN c ELSE best END, 9) AS quality FROM two""",
    "records_standardize": f"WITH {_RECORDS} SELECT ordinal, fname, lname, dob, CASE sex WHEN 'M' THEN 'MALE' ELSE sex END AS sex, phone, strftime(d, '%m/%d/%Y') AS order_date, CASE WHEN physician <> '' THEN 'Jane Roe Md' ELSE '' END AS physician FROM r",
    "doc_phone_extract": r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
      SELECT doc_id, CASE WHEN regexp_matches(t, '(?i)Phone:?\s*\((\d{3})\)\s*(\d{3})-(\d{4})') THEN '(' || regexp_extract(t, '(?i)Phone:?\s*\((\d{3})\)\s*(\d{3})-(\d{4})', 1) || ') ' || regexp_extract(t, '(?i)Phone:?\s*\((\d{3})\)\s*(\d{3})-(\d{4})', 2) || '-' || regexp_extract(t, '(?i)Phone:?\s*\((\d{3})\)\s*(\d{3})-(\d{4})', 3)
        WHEN regexp_matches(t, '\((\d{3})\)\s*(\d{3})-(\d{4})') THEN '(' || regexp_extract(t, '\((\d{3})\)\s*(\d{3})-(\d{4})', 1) || ') ' || regexp_extract(t, '\((\d{3})\)\s*(\d{3})-(\d{4})', 2) || '-' || regexp_extract(t, '\((\d{3})\)\s*(\d{3})-(\d{4})', 3)
        ELSE regexp_extract(t, '(?i)(?:phone|tel|telephone):?\s*(\(?\d{3}\)?[-.\s]*\d{3}[-.\s]*\d{4})', 1) END AS phone FROM t""",
    "document_router": "WITH s AS (SELECT doc_id, text, doc_id % 7 <> 0 AND regexp_replace(text, '\\s', '', 'g') <> '' AS ok FROM documents) SELECT doc_id::VARCHAR AS doc_id, CASE WHEN ok THEN 'extracted' ELSE 'failed' END AS status, CASE WHEN ok THEN 'pre_extracted' ELSE 'none' END AS extraction_method, CASE WHEN ok THEN '' ELSE 'No text could be extracted' END AS error, CASE WHEN ok THEN round(least(length(text) / 5000.0::DOUBLE, 1), 9) ELSE 0::DOUBLE END AS quality_score FROM s",
    "doc_quality_score": r"""WITH a AS (SELECT doc_id, text, regexp_replace(regexp_replace(text, '[^\x00-\x7F]', 'x', 'g'), '^\s+|\s+$', '', 'g') AS t FROM documents),
      b AS (SELECT doc_id, text, length(t) AS n, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) / greatest(length(t), 1)::DOUBLE AS l, length(regexp_replace(t, '[^0-9]', '', 'g')) / greatest(length(t), 1)::DOUBLE AS f, length(regexp_replace(t, '[^\s\x0b]', '', 'g')) / greatest(length(t), 1)::DOUBLE AS s, length(regexp_replace(t, '[^.,;:()\[\]{}/_@#$%^&*+=<>?!"''-]', '', 'g')) / greatest(length(t), 1)::DOUBLE AS p FROM a)
      SELECT doc_id, round(CASE WHEN n = 0 THEN 0 WHEN n < 10 THEN 0.1 ELSE least(CASE WHEN l BETWEEN 0.4 AND 0.8 THEN 0.4 WHEN l > 0.2 THEN 0.2 ELSE 0 END + CASE WHEN f BETWEEN 0.05 AND 0.3 THEN 0.2 ELSE 0 END + CASE WHEN s BETWEEN 0.1 AND 0.25 THEN 0.2 ELSE 0 END + CASE WHEN p BETWEEN 0.02 AND 0.15 THEN 0.1 ELSE 0 END + CASE WHEN n > 500 THEN 0.1 WHEN n > 200 THEN 0.05 ELSE 0 END, 1) END::DOUBLE, 6) AS quality, round(least(length(text) / 5000.0::DOUBLE, 1), 9) AS length_quality FROM b""",
    "doc_scanned_flag": f"WITH s AS (SELECT doc_id, text, {_LINES} AS lines FROM documents), u AS (SELECT doc_id, text, CASE WHEN len(lines) > 0 THEN len(list_distinct(lines)) / len(lines)::DOUBLE END AS share FROM s) SELECT doc_id, length(text) < 100 OR coalesce(share < 0.3, false) OR (NOT regexp_matches(lower(text), 'patient|name|dob|date of birth|address|diagnosis|medical|record') AND length(text) < 500) AS scanned, round(share, 9) AS distinct_lines FROM u",
    "best_engine": "SELECT c_custkey, CASE WHEN c_custkey % 7 >= c_custkey * 3 % 7 AND c_custkey % 7 >= c_custkey * 5 % 7 THEN 'a' WHEN c_custkey * 3 % 7 >= c_custkey * 5 % 7 THEN 'b' ELSE 'c' END AS engine FROM customer",
}
