"""Sources, sinks, connectors, plans and the stream."""

import base64
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from docpipe.operators import report
from docpipe.plans import cases, pipeline, queries, registry
from docpipe.schemas import ORDER, PATIENT, record
from docpipe.sources import files, http, sinks
from docpipe.streaming import documents

DOC = "PATIENT INFORMATION\nPatient: Smith, Alan\nDOB: 1/5/1950\nMR#: HH00000000012\nORDERS\nThe Order Number: 12345678\nThe Order Date: 5/1/2024\nSOC Date: 4/20/2024\nDIAGNOSES\nsee chart"


def test_csv_encodings_tokens_and_limit(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('ID,Patient Name,Received On,document_id\n1,"Müller, Ann",5/1/2024,N/A\n2,NULL,,x\n'.encode("latin-1"))
    rows = files.read_worklist(spark, str(tmp_path / "a.csv"))
    assert rows.columns == ["doc_id", "patient", "received_on", "document_id"]
    assert [tuple(r) for r in rows.collect()] == [("1", "Müller, Ann", "5/1/2024", None), ("2", None, None, "x")]
    assert files.read_worklist(spark, str(tmp_path / "a.csv"), max_rows=1).count() == 1
    with pytest.raises(Exception, match="(?i)path"):
        files.read_worklist(spark, str(tmp_path / "none.csv")).collect()


def test_lookup_json(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"Alpha": "1", "Beta": "2"}))
    assert [tuple(r) for r in files.read_lookup(spark, str(tmp_path / "c.json")).orderBy("ordinal").collect()] == [("Alpha", "1", 0), ("Beta", "2", 1)]
    assert files.read_lookup(spark, str(tmp_path / "none.json")).count() == 0


def test_directories(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1.4 a")
    (tmp_path / "9320001_ocr.txt").write_text("two\nlines")
    (tmp_path / "other.bin").write_bytes(b"no")
    assert [(r.doc_id, r.file_name, r.file_size) for r in files.read_pdfs(spark, str(tmp_path)).collect()] == [("x", "x.pdf", 10)]
    assert [(r.doc_id, r.content) for r in files.read_texts(spark, str(tmp_path), "932*.txt").collect()] == [("9320001_ocr", "two\nlines")]
    mock = files.mock_pdfs(spark, 3).orderBy("doc_id").collect()
    assert [r.file_size for r in mock] == [10240, 11264, 12288] and bytes(mock[0].pdf_buffer).startswith(b"%PDF")


def test_router_prefers_text_then_extractor(spark):
    docs = spark.createDataFrame([("a", None, "some text"), ("b", bytearray(b"%PDF x"), None), ("c", None, " ")], "doc_id string, pdf_buffer binary, content string")
    plain = {r.doc_id: r for r in files.extract_text(docs).collect()}
    assert (plain["a"].extraction_method, plain["b"].status, plain["c"].error) == ("pre_extracted", "failed", "No text could be extracted")
    read = lambda raw: F.struct(F.decode(raw, "UTF-8").alias("text"), F.lit("digital").alias("method"))
    got = {r.doc_id: r for r in files.extract_text(docs, read).collect()}
    assert got["b"].text == "%PDF x" and got["b"].is_scanned and not got["a"].is_scanned


def test_fetch_and_push_with_retries(spark, tmp_path):
    body = json.dumps({"isSuccess": True, "value": {"documentBuffer": base64.b64encode(b"%PDF-1").decode()}})
    log = str(tmp_path / "calls")

    def send(doc_id):
        with open(log, "a") as f:
            f.write(doc_id + "\n")
        if doc_id == "down":
            raise ConnectionError("refused")
        return {"ok": (200, body), "gone": (200, json.dumps({"isSuccess": False, "errorCode": "NOT_FOUND", "errorMessage": "x"})), "bad": (404, ""), "busy": (503, "")}[doc_id]

    ids = spark.createDataFrame([(x,) for x in ("ok", "gone", "bad", "busy", "down")], "doc_id string")
    got = {r.doc_id: r for r in http.fetch(ids, send, retries=2, pause=0).collect()}
    assert (got["ok"].status, bytes(got["ok"].pdf_buffer)) == ("success", b"%PDF-1")
    assert [got[k].status_code for k in ("gone", "bad", "busy", "down")] == [404, 404, 503, -1]
    calls = Path(log).read_text().split()
    assert calls.count("busy") == 2 and calls.count("bad") == 1
    pushed = http.push(spark.createDataFrame([("k1", "{}")], "k string, j string"), "j", "k", lambda key, payload: (201, key)).collect()
    assert [tuple(r) for r in pushed] == [("k1", 201, "k1")]


def test_sinks_round_trip(spark, tmp_path):
    rows = queries.records(spark, "/root/testdata/sf0.001").where("ordinal < 60")
    out = str(tmp_path)
    sinks.write_export(rows, f"{out}/export", F.lit("now"))
    back = spark.read.option("header", True).csv(f"{out}/export")
    assert len(back.columns) == 41 and back.count() == rows.where("status = 'parsed'").select("doc_id").distinct().count()
    assert spark.read.option("header", True).csv(f"{out}/export_failed").columns == back.columns
    sinks.write_failed_parses(rows, f"{out}/failed", F.lit("now"))
    assert spark.read.option("header", True).csv(f"{out}/failed").count() == rows.where("status = 'failed'").count()
    sinks.write_json_per_document(rows.limit(3), f"{out}/json")
    assert json.loads(spark.read.text(f"{out}/json").first().value)["status"]
    sinks.write_completeness(rows, f"{out}/complete", F.lit("now"))
    assert spark.read.option("header", True).csv(f"{out}/complete").columns[0] == "Fields_Present"
    sinks.write_report(report.report_text(report.summary(rows), "Summary"), f"{out}/report")
    assert spark.read.text(f"{out}/report").first().value == "Summary"
    sinks.write_results(rows.select("doc_id"), f"{out}/results")
    sinks.write_failed_fetches(spark.createDataFrame([("a", "failed")], "doc_id string, status string"), f"{out}/fetches")
    assert spark.read.option("header", True).csv(f"{out}/fetches").columns == list(sinks.FAILED_FETCH)


def test_secondary_extractor_fills_gaps(spark):
    docs = spark.createDataFrame([("a", DOC, "extracted"), ("b", "", "extracted"), ("c", None, "failed")], "doc_id string, text string, status string")
    second = lambda t: F.struct(record(PATIENT, {"email": F.lit("x@y.z"), "dob": F.lit("01/01/1900"), "city": F.lit("Troy"), "state": F.lit("NY"), "zip_code": F.lit("1"), "ssn": F.lit("2"), "phone_number": F.lit("3"), "address": F.lit("4")}).alias("patient"), record(ORDER, {}).alias("order"))
    got = {r.doc_id: r for r in pipeline.parse_documents(docs, secondary=second).collect()}
    assert (got["a"].patient.dob, got["a"].patient.email, got["a"].extraction_method) == ("01/05/1950", "x@y.z", "enhanced_llm")
    assert [(got[k].status, got[k].error) for k in "bc"] == [("failed", "No valid text extracted")] * 2


def test_flagship_plan_stays_in_the_jvm(spark):
    plan = registry.QUERIES[registry.FLAGSHIP](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_stream_agrees_with_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d1.txt").write_text(DOC)
    stream = documents.parse_stream(documents.read_stream(spark, str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("parsed_stream").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = spark.table("parsed_stream").collect()
    batch = pipeline.enhance_records(pipeline.parse_documents(spark.createDataFrame([("d1", DOC, "extracted")], "doc_id string, text string, status string"))).first()
    assert len(got) == 1 and got[0].patient == batch.patient and got[0].order == batch.order


def test_registry_is_complete():
    found, oracle = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracle) <= set(found) and registry.FLAGSHIP in found
    assert set(cases.CASES) <= set(oracle)
