"""File sources: worklists, lookups, documents, and their headers and encodings."""

from __future__ import annotations

import re
from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import SAMPLE, choose, decoded
from ..functions.text import squeeze, strip
from ..schemas import blank, let, settle

# What a header may be called, and what stands for no value.
HEADERS = {"id": "doc_id", "doc id": "doc_id", "patient": "patient", "patient name": "patient", "name": "patient", "received on": "received_on", "receivedon": "received_on", "status": "status", "physician": "physician", "doc type": "doc_type", "facility": "facility", "facility type": "facility_type", "agency": "agency", "soc": "soc", "start of care": "soc"}
NO_VALUE = ("", "NULL", "null", "None", "none", "N/A", "n/a", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "NA", "NaN", "nan")
PAYLOAD_FIELDS = ("document", "documentBuffer", "pdf_data", "file_data", "content", "data", "file", "pdf", "base64", "fileContent", "documentContent")


def canonical_headers(columns: Iterable[str]) -> list[str]:
    """Column names in canonical form; unknown ones stay as they are.

    Names are compared in lower case with ``_`` and ``-`` as blanks.
    """
    key = lambda c: re.sub(r"\s+", " ", c.lower().strip().replace("_", " ").replace("-", " "))
    return [HEADERS.get(key(c), c) for c in columns]


def sniff_encoding(spark: SparkSession, path: str, size: int = SAMPLE) -> str:
    """The encoding of a file, or of the first one of a folder or pattern, by its first bytes.

    Only those bytes are read; an empty file is UTF-8.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((x for x in fs.globStatus(pattern) or []), key=lambda x: x.getPath().toString())
    while found and found[0].isDirectory():
        inner = [x for x in fs.listStatus(found[0].getPath()) if not x.getPath().getName().startswith(("_", "."))]
        found = sorted(inner, key=lambda x: x.getPath().toString()) + found[1:]
    if not found:
        return "UTF-8"
    stream = fs.open(found[0].getPath())
    try:
        data = bytes(stream.readNBytes(size))
        return choose(data, whole=len(data) < size)
    finally:
        stream.close()


def read_csv(spark: SparkSession, path: str, max_rows: int | None = None, encoding: str | None = None) -> DataFrame:
    """All columns as strings, tokens for no value as null; a missing file raises an error."""
    rows = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').option("encoding", encoding or sniff_encoding(spark, path)).csv(path)
    rows = rows.select(*(F.when(~F.trim(F.col(f"`{c}`")).isin(*NO_VALUE), F.col(f"`{c}`")).alias(c) for c in rows.columns))
    return rows.limit(max_rows) if max_rows is not None else rows


def read_worklist(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """A CSV worklist with canonical headers."""
    rows = read_csv(spark, path, max_rows)
    return rows.toDF(*canonical_headers(rows.columns))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object as rows (agency, company_id, ordinal); an absent or unreadable file is an empty lookup."""
    empty = spark.createDataFrame([], "agency string, company_id string, ordinal long")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return empty
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("ordinal", "e"))
    return pairs.select(F.col("e.key").alias("agency"), F.col("e.value").alias("company_id"), F.col("ordinal").cast("long"))


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def read_pdfs(spark: SparkSession, directory: str) -> DataFrame:
    """Every *.pdf of a directory: doc_id (the file's stem), pdf_buffer, file_name, file_size."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(directory)
    path = F.col("path")
    return found.select(file_stem(path).alias("doc_id"), F.col("content").alias("pdf_buffer"), F.element_at(F.split(path, "/"), -1).alias("file_name"), F.col("length").alias("file_size"), F.lit("success").alias("status"))


def read_texts(spark: SparkSession, paths: str | list[str], glob: str = "*.txt", limit: int | None = None) -> DataFrame:
    """Text files, a row each: doc_id (the file's stem), content, status. A document in several folders has several rows."""
    found = spark.read.option("pathGlobFilter", glob).text(paths, wholetext=True).select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("path"))
    found = found.select(file_stem(F.col("path")).alias("doc_id"), "content", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.octet_length("content").cast("long").alias("file_size"), F.lit("success").alias("status"))
    return found.limit(limit) if limit is not None else found


def read_encoded_texts(spark: SparkSession, paths: str | list[str], glob: str = "*.txt") -> DataFrame:
    """Text files in any of the known encodings, a row each: doc_id, content, encoding, confidence, file_name, file_size, status."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    found = settle(found.select("path", "length", "content"), {"got": decoded(F.col("content"))})
    path = F.col("path")
    return found.select(file_stem(path).alias("doc_id"), F.col("got.text").alias("content"), F.col("got.encoding").alias("encoding"), F.col("got.confidence").alias("confidence"), F.element_at(F.split(path, "/"), -1).alias("file_name"), F.col("length").alias("file_size"), F.lit("success").alias("status"))


def mock_pdfs(spark: SparkSession, n: int) -> DataFrame:
    """Made-up documents for dry runs: ids MOCK_0..., sizes growing by 1024 bytes."""
    size = (F.col("id") + 10) * 1024
    return spark.range(n).select(F.concat(F.lit("MOCK_"), F.col("id")).alias("doc_id"), F.encode(F.rpad(F.lit("%PDF-1.4"), size.cast("int"), " "), "UTF-8").alias("pdf_buffer"), F.concat(F.lit("MOCK_"), F.col("id"), F.lit(".pdf")).alias("file_name"), size.alias("file_size"), F.lit("success").alias("status"))


def parse_id_list(c: Column) -> Column:
    """Ids parted by line breaks, blanks or commas."""
    return F.filter(F.split(c, r"[\n ,]"), lambda x: F.trim(x) != "")


def locate_payload(reply: Column) -> Column:
    """The encoded document in a JSON reply: its usual place, then other names in order, then any long text that looks encoded."""
    at = lambda path: F.when(F.get_json_object(reply, path) != "", F.get_json_object(reply, path))
    any_long = F.get(F.filter(F.map_values(F.from_json(reply, "map<string,string>")), lambda v: (F.length(v) > 100) & F.rlike(F.substring(v, 1, 100), F.lit(r"^[A-Za-z0-9+/=\s]+$"))), F.lit(0))
    return F.coalesce(at("$.value.documentBuffer"), *(at(f"$.{n}") for n in PAYLOAD_FIELDS), any_long)


def decode_payload(payload: Column) -> Column:
    """Struct pdf_buffer, is_pdf, error. Bytes without the PDF mark are kept."""
    raw = F.try_to_binary(payload, F.lit("base64"))
    error = F.when(payload.isNull(), "No PDF data found in response").when(raw.isNull(), "Base64 decode error").when(F.octet_length(raw) == 0, "Empty PDF buffer after decoding").otherwise("")
    return F.struct(F.when(F.octet_length(raw) > 0, raw).alias("pdf_buffer"), F.coalesce(F.startswith(raw, F.lit(b"%PDF")), F.lit(False)).alias("is_pdf"), error.alias("error"))


def reply_status(reply: Column) -> Column:
    """Struct status_code, error of a service's own error reply; null where it succeeded."""
    code = F.coalesce(F.get_json_object(reply, "$.errorCode"), F.lit("UNKNOWN_ERROR"))
    message = F.coalesce(F.get_json_object(reply, "$.errorMessage"), F.lit("No error message provided"))
    told = lambda status, head: F.struct(F.lit(status).alias("status_code"), F.concat(head, message).alias("error"))
    out = F.when(code.isin("NOT_FOUND", "DOCUMENT_NOT_FOUND"), told(404, F.lit("Document not found: "))).when(code.isin("ACCESS_DENIED", "UNAUTHORIZED"), told(401, F.lit("Access denied: "))).when(code.isin("INVALID_REQUEST", "BAD_REQUEST"), told(400, F.lit("Invalid request: "))).otherwise(told(200, F.concat(F.lit("API error ("), code, F.lit("): "))))
    return F.when(F.get_json_object(reply, "$.isSuccess") == "false", out)


def to_documents(fetched: DataFrame) -> DataFrame:
    """Rows with a document: its bytes if there are any, else its text."""
    rows = fetched.where("status = 'success' and (pdf_buffer is not null or coalesce(content, '') <> '')")
    return rows.withColumn("content", F.when(F.col("pdf_buffer").isNull(), F.col("content")))


#: Digital text below so many characters is given to OCR. Fixed value.
LEAST_DIGITAL = 200


def extract_text(documents: DataFrame, extractor=None, ocr=None) -> DataFrame:
    """doc_id, text, status, error, quality_score, extraction_method, is_scanned, text_length.

    A row with text passes as it is. Bytes are read as PDF (``sources.pdf``), their white
    space collapsed; text that looks scanned or has under 200 characters goes to ``ocr``, a
    column function from binary to text, and stays as it is where that is not given or finds
    nothing. ``extractor``, a column function from binary to struct(text, method), replaces both.
    """
    from ..functions.text import length_quality, looks_scanned
    from .pdf import digital_text

    raw = F.col("pdf_buffer")
    own = F.when(~blank(F.col("content")), F.struct(F.col("content").alias("text"), F.lit("pre_extracted").alias("method")))
    if extractor is not None:
        rows = documents.withColumn("_got", F.coalesce(own, F.when(raw.isNotNull(), extractor(raw)))).withColumns({"_scanned": looks_scanned(F.col("_got.text")), "_error": F.lit("")})
    else:
        # only rows that need it are read
        rows = settle(documents, {"_own": own, "_pdf": digital_text(F.when(blank(F.col("content")), raw))})
        text = squeeze(F.col("_pdf.text"))
        rows = settle(rows, {"_digital": text, "_weak": looks_scanned(F.col("_pdf.head")) | (F.length(text) < LEAST_DIGITAL)})
        read = F.when(F.col("_own").isNull() & F.col("_weak") & raw.isNotNull(), squeeze(ocr(raw))) if ocr is not None else F.lit(None).cast("string")
        rows = settle(rows, {"_seen": read})
        seen = ~blank(F.col("_seen"))
        got = F.coalesce("_own", F.when(seen, F.struct(F.col("_seen").alias("text"), F.lit("ocr").alias("method"))), F.struct(F.col("_digital").alias("text"), F.lit("digital").alias("method")))
        rows = rows.withColumns({"_got": got, "_scanned": F.col("_weak"), "_error": F.when(raw.isNotNull(), F.col("_pdf.error")).otherwise("")})
    text = F.col("_got.text")
    ok = ~blank(text)
    error = F.when(ok, "").when(F.col("_error") != "", F.concat(F.lit("No text could be extracted: "), "_error")).otherwise("No text could be extracted")
    return rows.select("doc_id", F.when(ok, text).otherwise("").alias("text"), F.when(ok, "extracted").otherwise("failed").alias("status"), error.alias("error"), F.when(ok, length_quality(text)).otherwise(0.0).alias("quality_score"), F.when(ok, F.col("_got.method")).otherwise("none").alias("extraction_method"), F.when(ok & (F.col("_got.method") != "pre_extracted"), F.col("_scanned")).otherwise(False).alias("is_scanned"), F.when(ok, F.length(strip(text))).otherwise(0).alias("text_length"))


def best_of(candidates: Column) -> Column:
    """Of an array of structs (quality, text, ...) the one of highest quality; the first on ties."""
    numbered = F.transform(candidates, lambda x, i: F.struct(x["quality"].alias("q"), (-i).alias("i"), x.alias("x")))
    return F.array_max(numbered)["x"]


# Below them a second engine, and OCR, are tried.
MEDIOCRE, UNREADABLE = 0.6, 0.25


def best_engine(first: Column, second: Column, ocr: Column) -> Column:
    """Of three engines' structs (quality, ...) the one to keep, in the order in which they are tried.

    The second counts where the first is mediocre but not empty, OCR where the better of
    both is unreadable; each only if it is better than what is there.
    """
    q = lambda x: F.coalesce(x["quality"], F.lit(0.0))
    two = F.when((q(first) > 0) & (q(first) < MEDIOCRE) & (q(second) > q(first)), second).otherwise(first)
    return let(two, lambda x: F.when((q(x) < UNREADABLE) & (q(ocr) > q(x)), ocr).otherwise(x))


def stem(path: str) -> str:
    return PurePosixPath(path).stem
