"""Text of hand-made PDF files."""

import base64
import zlib

import pytest
from pyspark.sql import functions as F

from docpipe.sources import files, pdf

FONT = b"<</Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding>>"


def stream(data, head=b"", packed=None):
    if packed == "flate":
        data, head = zlib.compress(data), head + b"/Filter /FlateDecode "
    if packed == "85":
        data, head = base64.a85encode(zlib.compress(data)) + b"~>", head + b"/Filter [/ASCII85Decode /FlateDecode] "
    return b"<<" + head + b"/Length %d>> stream\n" % len(data) + data + b"\nendstream"


def make(*contents, packed=None, fonts=(FONT,), more=(), trailer=b""):
    """A file with one page for each content; fonts are F0, F1, ..."""
    first = 3 + 2 * len(contents)
    names = b" ".join(b"/F%d %d 0 R" % (k, first + k) for k in range(len(fonts)))
    bodies = [b"<</Type /Catalog /Pages 2 0 R>>", b"<</Type /Pages /Resources <</Font <<" + names + b">> >> /Count %d /Kids [" % len(contents) + b" ".join(b"%d 0 R" % (3 + 2 * k) for k in range(len(contents))) + b"]>>"]
    for k, c in enumerate(contents):
        bodies += [b"<</Type /Page /Parent 2 0 R /Contents %d 0 R>>" % (4 + 2 * k), stream(c, packed=packed)]
    bodies += [*fonts, *more]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n" % k + b + b"\nendobj\n" for k, b in enumerate(bodies, 1)) + b"trailer <</Root 1 0 R " + trailer + b">>\n%%EOF"


def texts(data):
    pages, error = pdf.read_pages(data)
    assert error == ""
    return pages


@pytest.mark.parametrize("packed", [None, "flate", "85"])
def test_plain_and_packed(packed):
    one = b"BT /F0 12 Tf 14 TL 72 700 Td (Patient: Roe, \\(Jane\\)) Tj T* (DOB: 1/5/1990) Tj (caf\\351 \\\nx) ' ET"
    two = b"BT /F0 10 Tf 1 0 0 1 72 500 Tm [(Or) -20 (der) -600 (No) 10 (. 7)] TJ ET"
    assert texts(make(one, two, packed=packed)) == ["Patient: Roe, (Jane)\nDOB: 1/5/1990\ncafé x", "Order No. 7"]


def test_two_fonts_one_with_its_own_map():
    to = b"/CIDInit 1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <00480069> <0002> <20AC> endbfchar 2 beginbfrange <0010> <0012> <0061> <0020> <0021> [<0058> <0059>] endbfrange"
    wide = b"<</Type /Font /Subtype /Type0 /Encoding /Identity-H /DescendantFonts [<</DW 500 /W [1 [700 600] 16 18 400]>>] /ToUnicode 6 0 R>>"
    odd = b"<</Type /Font /Subtype /Type1 /Encoding <</Differences [1 /A /germandbls /uni0416 65 /fi]>> >>"
    content = b"BT /F0 10 Tf 0 0 Td <00010002001000110012 0020 0021> Tj /F1 10 Tf 0 -20 Td (\\001\\002\\003AB) Tj ET"
    # the map is the object after the fonts' first: number 6
    data = make(content.replace(b"/F1", b"/F2"), fonts=(wide, stream(to, packed="flate"), odd))
    assert texts(data) == ["Hi€abcXY\nAßЖfiB"]


def test_layout():
    moved = b"BT /F0 10 Tf 200 100 Td (right) Tj ET BT /F0 10 Tf 50 100.4 Td (left) Tj ET BT /F0 10 Tf 50 300 Td (top) Tj ET q 2 0 0 2 0 0 cm BT /F0 10 Tf 25 20 Td (low) Tj ET Q"
    assert texts(make(moved)) == ["top\nleft right\nlow"]
    spaced = b"BT /F0 10 Tf 50 0 Td (a) Tj 5 0 Td (b) Tj 30 0 Td (c) Tj ET"
    assert texts(make(spaced)) == ["ab c"]
    image = b"BI /W 1 /H 1 ID \x00(Tj\xff) EI BT /F0 9 Tf (after) Tj ET"
    assert texts(make(image)) == ["after"]


def test_forms_versions_and_object_streams():
    form = stream(b"BT /F0 10 Tf (in a form) Tj ET", b"/Type /XObject /Subtype /Form /Matrix [1 0 0 1 0 50] ")
    page = b"<</Type /Page /Contents 4 0 R /Resources <</Font <</F0 5 0 R>> /XObject <</X 6 0 R>> >> >>"
    bodies = {1: b"<</Type /Catalog /Pages 2 0 R>>", 2: b"<</Kids [3 0 R]>>", 3: page, 4: stream(b"BT /F0 10 Tf (old) Tj ET"), 5: FONT, 6: form}
    raw = b"%PDF-1.5\n" + b"".join(b"%d 0 obj %s endobj " % x for x in bodies.items())
    raw += b"4 0 obj " + stream(b"/X Do BT /F0 10 Tf (new) Tj ET", packed="flate") + b" endobj"
    assert texts(raw) == ["in a form\nnew"]
    packed = {1: bodies[1], 2: bodies[2], 3: page, 5: FONT}
    head, body = b"", b""
    for k, x in packed.items():
        head += b"%d %d " % (k, len(body))
        body += x + b" "
    raw = b"%PDF-1.5\n4 0 obj " + bodies[4] + b" endobj 9 0 obj " + stream(head + body, b"/Type /ObjStm /N 4 /First %d " % len(head), "flate") + b" endobj"
    assert texts(raw) == ["old"]


def test_damage_has_a_reason():
    assert pdf.read_pages(b"") == ([], "not a PDF")
    assert pdf.read_pages(make(b"", trailer=b"/Encrypt 9 0 R")) == ([], "encrypted")
    assert pdf.read_pages(b"%PDF-1.4 nothing") == ([], "no pages")
    good = make(b"BT /F0 9 Tf (one) Tj ET", b"BT /F0 9 Tf (two) Tj ET", packed="flate")
    bad = good.replace(zlib.compress(b"BT /F0 9 Tf (one) Tj ET"), b"x" * len(zlib.compress(b"BT /F0 9 Tf (one) Tj ET")))
    pages, error = pdf.read_pages(bad)
    assert pages == ["", "two"] and error.startswith("page 1")
    loop = b"%PDF-1.4 1 0 obj <</Type /Catalog /Pages 2 0 R>> endobj 2 0 obj <</Kids [2 0 R 3 0 R]>> endobj 3 0 obj 3 0 R endobj"
    assert pdf.read_pages(loop) == ([], "no pages")
    for cut in range(0, len(good), 17):  # whatever is left of a file, reading it ends
        pdf.read_pages(good[:cut])


def test_route_to_ocr(spark):
    long = b"BT /F0 10 Tf 12 TL 50 700 Td " + b"".join(b"(Patient line %d with a diagnosis) Tj T* " % k for k in range(12)) + b"ET"
    docs = [("long", make(long), None), ("short", make(b"BT /F0 9 Tf (Patient) Tj ET"), None), ("none", make(b""), None), ("own", make(long), "given text"), ("bad", b"%PDF x", None), ("null", None, None)]
    df = spark.createDataFrame([(a, bytearray(b) if b is not None else None, c) for a, b, c in docs], "doc_id string, pdf_buffer binary, content string")
    got = {r.doc_id: r for r in files.extract_text(df).collect()}
    assert {k: r.extraction_method for k, r in got.items()} == {"long": "digital", "short": "digital", "none": "none", "own": "pre_extracted", "bad": "none", "null": "none"}
    assert got["long"].text.startswith("Patient line 0 with a diagnosis Patient line 1") and not got["long"].is_scanned
    assert got["short"].is_scanned and got["bad"].error == "No text could be extracted: no pages"
    seen = {r.doc_id: r for r in files.extract_text(df, ocr=lambda raw: F.concat(F.lit("seen  "), F.octet_length(raw).cast("string"))).collect()}
    assert {k: r.extraction_method for k, r in seen.items()} == {"long": "digital", "short": "ocr", "none": "ocr", "own": "pre_extracted", "bad": "ocr", "null": "none"}
    assert seen["bad"].text == "seen 6" and seen["bad"].is_scanned


def test_directory_of_files(spark, tmp_path):
    (tmp_path / "a1.pdf").write_bytes(make(b"BT /F0 9 Tf (Hello) Tj ET", packed="flate"))
    rows = files.read_pdfs(spark, str(tmp_path)).withColumn("content", F.lit(None).cast("string"))
    assert [(r.doc_id, r.text) for r in files.extract_text(files.to_documents(rows)).collect()] == [("a1", "Hello")]
