"""Requests with a ledger, the second extractor, files for documents, encodings."""

import json
import os
import threading
import time
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from docpipe.functions import encoding
from docpipe.functions.dates import infer_date
from docpipe.plans import pipeline, queries
from docpipe.sources import extractor, files, http, sinks
from docpipe.sources.calls import TokenBucket, resumable, windowed
from docpipe.sources.document_files import file_name


def test_window_keeps_order_and_bounds_calls():
    now, most, lock = 0, 0, threading.Lock()

    def call(k):
        nonlocal now, most
        with lock:
            now += 1
            most = max(most, now)
        time.sleep(0.002 * (k % 5))
        with lock:
            now -= 1
        return k * k

    assert list(windowed(range(40), call, 4)) == [(k, k * k) for k in range(40)]
    assert 1 < most <= 4
    slow = list(windowed(range(3), lambda k: time.sleep(5 if k == 1 else 0) or k, 3, seconds=0.3, late="late"))
    assert slow == [(0, 0), (1, "late"), (2, 2)]
    with pytest.raises(ZeroDivisionError):
        list(windowed([1, 0], lambda k: 1 / k, 2))


def test_token_bucket():
    limit, began = TokenBucket(50.0, burst=5), time.monotonic()
    for _ in range(15):
        limit.take()
    assert 0.15 < time.monotonic() - began < 1.5
    TokenBucket(None).take()


def _sender(log):
    def send(i, body=None):
        with open(f"{log}/{i}", "a") as f:
            f.write("x")
        if i == "killer" and not os.path.exists(f"{log}/killed"):
            Path(f"{log}/killed").write_text("")
            raise RuntimeError("the run ends here")
        if i.startswith("busy"):
            return 503, ""
        return (409, "there") if i == "known" else (200, f"reply {i} {body}")

    return send


def test_a_run_that_ends_is_resumed(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    ids = [f"i{k}" for k in range(120)] + ["killer", "known", "busy1"]
    rows = spark.createDataFrame([(i, f"p{i}") for i in ids + ids[:10]] + [(None, "x")], "id string, body string")
    once = lambda: resumable(rows, "id", _sender(str(log)), str(tmp_path / "ledger"), "body", buckets=6, window=3, tries=2, pause=0, flush_every=1)
    with pytest.raises(Exception, match="the run ends here"):
        once().collect()
    got = {r.id: r for r in once().collect()}
    assert set(got) == set(ids)
    sent = {i: len((log / i).read_text()) for i in ids}
    assert sent.pop("killer") == 2 and sent.pop("busy1") % 2 == 0  # two attempts in each run that reached it
    # what was under way in the window when the run ended may be sent again, nothing else
    assert max(sent.values()) <= 2 and sum(n == 2 for n in sent.values()) <= 3 * 4
    assert got["known"].final and got["i3"].body == "reply i3 pi3" and not got["busy1"].final
    before = dict(sent)
    again = {r.id: r.status_code for r in once().collect()}
    assert {i: len((log / i).read_text()) for i in before} == before  # finished ids are never sent again
    assert again["busy1"] == 503 and again["known"] == 409
    assert resumable(rows.limit(0), "id", _sender(str(log)), str(tmp_path / "other"), "body").count() == 0


def test_fetch_and_push_with_a_ledger(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    ids = spark.createDataFrame([("a",), ("busy",)], "doc_id string")
    for _ in range(2):
        got = {r.doc_id: r for r in http.fetch(ids, _sender(str(log)), retries=1, pause=0, ledger=str(tmp_path / "fetch")).collect()}
        assert got["a"].status_code == 200 and got["busy"].status_code == 503
    assert (len((log / "a").read_text()), len((log / "busy").read_text())) == (1, 2)
    rows = spark.createDataFrame([("known", "{}"), ("new", "{}")], "k string, j string")
    pushed = http.push(rows, "j", "k", _sender(str(log)), ledger=str(tmp_path / "push"))
    assert {r.key: r.ok for r in pushed.withColumn("ok", http.pushed(F.col("status_code"))).collect()} == {"known": True, "new": True}


def test_second_extractor(spark, tmp_path):
    calls = str(tmp_path / "calls")
    mode = extractor.Mode(prompt_chars=60, tokens=7, seconds=0.5, tries=2)

    def send(prompt, tokens, seconds):
        text = prompt.split("DOCUMENT\n")[1].split("\nEND OF")[0]
        with open(calls, "a") as f:
            f.write(text.split()[0] + "\n")
        assert tokens == 7 and len(text) <= 60
        if "hang" in text:
            time.sleep(5)
        if "refuse" in text:
            raise OSError("refused")
        if "flaky" in text and Path(calls).read_text().count("flaky") < 2:
            return "no JSON here"
        return f"Sure!\n```json\n{json.dumps({'dob': ' 1/2/1950 ', 'order_no': 17, 'physician_name': None, 'patient_fname': text.split()[0], 'extra': 1})}\n```"

    texts = [f"t{k} plain" for k in range(30)] + ["refuse x", "flaky x", "hang x", "", " ", None, "long " + "y" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string").coalesce(1)
    got = {r.k: r.s for r in df.select("k", extractor.second_extractor(send, mode, window=4)(F.col("text")).alias("s")).collect()}
    assert all(got[k].patient.patient_fname == f"t{k}" and got[k].patient.dob == "1/2/1950" and got[k].order.order_no == "17" and got[k].order.physician_name == "" for k in range(30))
    assert [got[k] is None for k in range(30, 37)] == [True, False, True, True, True, True, False]
    assert Path(calls).read_text().count("refuse") == 2 and Path(calls).read_text().count("flaky") == 2
    assert extractor.answer_fields("[1]") is None and extractor.answer_fields('{"dob": ') is None and extractor.answer_fields('x {"dob": true} y')["dob"] == ""
    assert len(extractor.prompt("z" * 20_000, extractor.SLOW)) < 13_000


def test_second_extractor_is_asked_only_where_needed(spark, tmp_path):
    asked = str(tmp_path / "asked")

    def send(prompt, tokens, seconds):
        with open(asked, "a") as f:
            f.write("x")
        return json.dumps({"patient_fname": "Zoe", "patient_lname": "Quill", "dob": "02/03/1950"})

    docs = spark.createDataFrame([("a", "nothing to find", "extracted"), ("b", "", "extracted"), ("c", None, "failed")], "doc_id string, text string, status string")
    got = {r.doc_id: r for r in pipeline.parse_documents(docs, secondary=extractor.second_extractor(send)).collect()}
    assert got["a"].patient.patient_lname == "Quill" and got["a"].extraction_method == "enhanced_llm"
    assert Path(asked).read_text() == "x" and got["b"].status == got["c"].status == "failed"


def test_one_file_for_each_document(spark, tmp_path):
    out = str(tmp_path / "out")
    n = 3_000
    df = spark.range(n).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("text of "), "id").alias("text"))
    odd = spark.createDataFrame([("a/b ü", "slash"), (".hidden", "dot"), (None, "nobody"), ("7", "zzz")], "doc_id string, text string")
    for _ in range(2):  # a rerun changes nothing
        sinks.write_texts(df.union(odd), out)
        names = {p.name for p in Path(out).iterdir() if p.name[0] not in "._"}
        assert names == {f"{k}.txt" for k in range(n)} | {file_name("a/b ü") + ".txt", "%2Ehidden.txt"}
        assert (Path(out) / "12.txt").read_text() == "text of 12" and (Path(out) / "7.txt").read_text() == "zzz"
        assert (Path(out) / "_SUCCESS").read_text() == str(n + 2) and not list((Path(out) / "_writing").iterdir())
    assert files.read_texts(spark, out).count() == n + 2
    sinks.write_texts(df.limit(50), f"{out}2", fanout=4)
    assert {p.parent.name for p in Path(f"{out}2").glob("*/*.txt")} == {"0000", "0001", "0002", "0003"}
    failing = df.withColumn("text", F.when(F.col("doc_id") == "5", F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_texts(failing, f"{out}3")
    assert not list(Path(f"{out}3").glob("_writing/*"))


def test_json_for_each_document_keeps_the_last(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, "later"), ("a", 1, "zz earlier"), ("b", 1, "x")], "doc_id string, ordinal long, note string")
    sinks.write_json_per_document(df, str(tmp_path / "json"))
    assert json.loads((tmp_path / "json" / "a_parsed.json").read_text())["note"] == "later"
    assert json.loads((tmp_path / "json" / "b_parsed.json").read_text()) == {"doc_id": "b", "ordinal": 1, "note": "x"}


SAMPLES = [
    (b"", "ascii", "UTF-8"), (b"plain,text\n1,2", "ascii", "UTF-8"), ("naïve café über straße, élève à l'école".encode(), "UTF-8", "UTF-8"), ("one é".encode(), "UTF-8", "UTF-8"),
    ("Müller größer Straße für Äpfel".encode("latin-1"), "ISO-8859-1", "ISO-8859-1"), ("élève à l'école où ça été".encode("latin-1"), "ISO-8859-1", "ISO-8859-1"),
    ("“Café” – naïve’s €5".encode("cp1252"), "windows-1252", "windows-1252"), (b"\xef\xbb\xbfid,name", "UTF-8", "UTF-8"), ("idé".encode("utf-16"), "UTF-16", "UTF-16"), (bytes(range(128, 256)) * 3, "windows-1252", "UTF-8"), (b"a\x81b\x8dc", "windows-1252", "UTF-8"),
]


def test_encodings():
    for data, found, used in SAMPLES:
        assert (encoding.detect(data)[0], encoding.choose(data)) == (found, used), data
    cut = ("é" * 20).encode()[:-1]
    assert encoding.choose(cut) == "UTF-8" and encoding.detect(cut)[1] > 0.9
    assert encoding.decode(b"\xef\xbb\xbfx") == "x"


def test_encoding_of_texts_whose_only_accent_ends_them(spark, tmp_path):
    texts = ["le thé", "é", "the\nÑ", "été", "10 €", "\ufeffř", "", None, "plain"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.encoding_detect(spark, str(tmp_path)).orderBy("doc_id")
    sql = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['encoding_detect']}) ORDER BY doc_id")
    assert [tuple(r) for r in got.collect()] == sql.fetchall()
    assert encoding.choose("the é".encode()[:-1], whole=False) == "UTF-8"


def test_encoded_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Straße für Müller".encode("latin-1"))
    (tmp_path / "b.txt").write_bytes("“Straße” für Müller’s €".encode("cp1252"))
    (tmp_path / "c.txt").write_bytes("Straße “ü”".encode())
    got = {r.doc_id: (r.content, r.encoding) for r in files.read_encoded_texts(spark, str(tmp_path)).collect()}
    assert got == {"a": ("Straße für Müller", "ISO-8859-1"), "b": ("“Straße” für Müller’s €", "windows-1252"), "c": ("Straße “ü”", "UTF-8")}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.csv").write_bytes("id,patient\n1,Müller größer\n".encode("cp1252"))
    assert files.sniff_encoding(spark, str(tmp_path / "in")) == "ISO-8859-1"
    assert files.read_worklist(spark, str(tmp_path / "in")).first().patient == "Müller größer"
    assert files.sniff_encoding(spark, str(tmp_path / "none*")) == "UTF-8"


def test_free_form_dates(spark):
    cases = {
        "4 March 2025": "03/04/2025", "March 4th, 2025": "03/04/2025", "the 4th of March 2025": "03/04/2025", "Tuesday, March 4, 2025": "03/04/2025", "Tue 4 Mar 25": "03/04/2025", "2025 Mar 4": "03/04/2025", "sept. 4 1999": "09/04/1999", "20250304": "03/04/2025",
        "2025-03-04T10:20:30Z": "03/04/2025", "3/4/2025 10:30 AM": "03/04/2025", "04-Mar-2025": "03/04/2025", "March 2025": "03/01/2025", "13/04/2025": "04/13/2025", "2025-13-04": "04/13/2025", "3/2025": "03/01/2025", "2025.03.04": "03/04/2025", "March 4 69": "03/04/1969", "May 5": None,
        "soon": None, "4 March 2025 maybe": None, "31 June 2025": None, "": None, "1 2 3 4": None, "March April 2025": None, "12345": None, "5%2025": None, "123456789012345678901234567890": None,
    }
    rows = spark.createDataFrame([(k,) for k in [*cases, None]], "d string")
    got = {r.d: r.v for r in rows.select("d", infer_date(F.col("d")).alias("v")).collect()}
    assert got == {**cases, None: None}
