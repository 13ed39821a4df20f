"""Functions applied to every order's case: an input chosen by the order's key, and what must come out.

The expectations are worked out by hand from the rules of each function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, standardize, text, validate
from ..operators import enhanced, extract
from ..scratch import spread
from ..sources import files


def _joined(c: Column) -> Column:
    return F.array_join(c, "|")


def _fields(c: Column, *names: str) -> Column:
    return F.concat_ws("|", *(F.coalesce(c[n], F.lit("")) for n in names))


def _diagnoses(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda d: F.concat_ws("/", d["diagnosis_code"], d["diagnosis_description"], d["diagnosis_type"])), "|")


def _flag(c: Column) -> Column:
    return c.cast("string")


DOC = "Page 1 of 3\nPATIENT DETAILS\nFaxed on 1/1/2024\nPtient one\nORDERS\nfirst\nCONFIDENTIAL copy\nORDERS\nhome-\n  care Da te\nDX: yes\nDIAGNOSIS\nI10\n"
CLEAN = "<HEADER>\nPATIENT DETAILS\nPatient one\n<ORDERS>\nORDERS\nfirst\n<ORDERS>\nORDERS\nhomecare Date\nDX: yes\n<DIAGNOSES>\nDIAGNOSIS\nI10"

#: name -> (function of a text column, [(input, expected)])
CASES: dict = {
    "date_standardize_multi_format": (dates.standardize_date, [("1/5/2024", "01/05/2024"), ("DOB: 3-7-1950", "03/07/1950"), ("2024-02-29", "02/29/2024"), ("02/30/2024", ""), ("May 5, 2025", "05/05/2025"), ("12 Sept 1999", "09/12/1999"), ("1.2.31", "01/02/1931"), ("1/2/30", "01/02/2030"), ("7 8 1988", "07/08/1988"), ("13/45/2025", ""), ("born 4/9/1960 age 64", "04/09/1960"), (" ", ""), ("June 31 2020", ""), ("Birthday: 6/1/1970 54 years old", "06/01/1970")]),
    "date_yy_pivot": (dates.normalize_extracted_date, [("1/5/49", "01/05/2049"), ("1/5/50", "01/05/1950"), ("02/31/2024", "02/31/2024"), ("5/21/2024 8:41 AM", "05/21/2024"), ("May 8, 2025", "05/08/2025"), ("soon", "soon"), ("1-2-1999", "01/02/1999")]),
    "date_worklist": (lambda c: F.coalesce(dates.normalize_worklist_date(c), F.lit("none")), [("5/1/2025", "05/01/2025"), ("05-01-25", "05/01/2025"), ("1.2.69", "01/02/1969"), ("1.2.68", "01/02/2068"), ("2025/3/4", "03/04/2025"), ("March 4, 2025", "03/04/2025"), ("Mar 4, 2025", "03/04/2025"), ("4 March 2025", "03/04/2025"), ("soon", "none"), ("March 32, 2025", "none"), ("02/30/2025", "none"), ("", "none")]),
    "date_backfill": (dates.normalize_backfill_date, [("5/1/2025", "05/01/2025"), ("21-May-2025", "05/21/2025"), ("2025-3-4", "03/04/2025"), ("1/2/69", "01/02/1969"), ("2025/3/4", ""), ("x", "")]),
    "date_match": (dates.normalize_match_date, [("01/05/1990", "01/05/1990"), ("1/5/2025", "15/20/2025"), ("010551", "01/05/1951"), ("010550", "01/05/2050"), ("1/15/99", "01/15/1999"), ("2024-01-05", "20/24/0105"), ("", "")]),
    "date_strict": (lambda c: _flag(dates.is_strict_date(c)), [("02/31/2024", "true"), ("2/3/2024", "false"), ("12/01/1999", "true"), ("13/01/1999", "false"), ("", "false")]),
    "date_reasonable": (lambda c: _flag(validate.reasonable_date(c)), [("1/1/2024", "true"), ("1/1/2025", "false"), ("1/1/1899", "false"), ("10/10/99", "true"), ("soon", "false"), ("", "false")]),
    "episode_end_plus_59": (lambda c: F.coalesce(dates.add_days(c, 59), F.lit("")), [("01/01/2024", "02/29/2024"), ("12/03/2023", "01/31/2024"), ("02/30/2024", ""), ("", "")]),
    "episode_pair_best": (lambda c: F.coalesce(_fields(dates.best_episode_pair(dates.all_dates(c)), "start", "end"), F.lit("")), [("1/1/2024 3/1/2024 4/1/2024", "01/01/2024|03/01/2024"), ("1/1/2024 1/20/2024", "|"), ("1-1-2024 and 2-20-2024, 4/20/2024", "02/20/2024|04/20/2024"), ("none", "|"), ("5/1/2024 5/1/2024 2/30/2024 6/28/2024", "05/01/2024|06/28/2024")]),
    "gender_standardize": (standardize.gender, [("m", "MALE"), (" Female. ", "FEMALE"), ("M/F", ""), ("male or female", ""), ("Mujer", "FEMALE"), ("unknown", ""), ("", "")]),
    "gender_from_name": (standardize.gender_from_name, [("john", "MALE"), (" Mary ", "FEMALE"), ("Zed", ""), ("", "")]),
    "phone_standardize": (standardize.phone, [("5085551234", "(508) 555-1234"), ("1-508-555-1234", "(508) 555-1234"), (" 555-1234 ", "555-1234"), ("2-508-555-1234", "2-508-555-1234"), ("", "")]),
    "ssn_standardize": (standardize.ssn, [("123456789", "123-45-6789"), ("123 45 6789", "123-45-6789"), (" 12 ", "12"), ("", "")]),
    "zip_standardize": (standardize.zip_code, [("02720", "02720"), ("027201234", "02720-1234"), ("02720-1234", "02720-1234"), ("MA 02720", "02720"), (" 1234 ", "1234"), ("", "")]),
    "state_standardize": (standardize.state, [("ma", "MA"), ("Rhode Island", "RI"), ("Ontario", "ON"), ("7", "7"), ("", "")]),
    "mrn_standardize": (standardize.mrn, [("ma 123456789", "MA123456789"), ("12345678", "12345678"), ("RLN00426061501", ""), ("123", ""), ("", "")]),
    "mrn_validate": (lambda c: _flag(validate.mrn(c)), [("MA1234", "true"), ("000000", "false"), ("123456", "true"), ("RECORD", "false"), ("12345", "false"), ("1234567890123456", "false"), ("", "false")]),
    "name_standardize": (standardize.name, [("mcdonald", "McDonald"), ("o'brien", "O'Brien"), ("smith jr", "Smith JR"), ("mary-ann  LEE!", "Mary-ann Lee"), ("iii", "III"), ("", "")]),
    "name_last_first": (standardize.last_first, [("smith, john a", "Smith, John A"), ("mary ann o'neil", "O'Neil, Mary Ann"), ("CHER", "Cher"), ("smith,", "Smith"), ("", "")]),
    "name_worklist_split": (lambda c: _fields(standardize.split_worklist_name(c), "fname", "lname"), [("SMITH, JOHN ALLAN", "John|Smith"), ("jane q roe", "Jane|Roe"), ("cher", "Cher|"), ("", "|")]),
    "name_match": (standardize.match_name, [("Mr. William Smith Jr.", "BILL SMITH"), ("dr robert o'neil, iii", "BOB O'NEIL"), ("Ann-Marie", "ANN-MARIE"), ("", "")]),
    "patient_name_validate": (lambda c: _flag(validate.patient_name(c)), [("Smith, John", "true"), ("Hyperlipidemia, unspecified", "false"), ("PRN", "false"), ("Drw, Str", "false"), ("Smith, I10 John", "false"), ("Grade, Anna", "false"), ("A", "false")]),
    "provider_validate": (lambda c: _flag(validate.provider(c)), [("Testcare Home Health", "true"), ("AM", "false"), ("RN", "false"), ("123456", "false"), ("a-1-2-3-4", "false"), ("", "false")]),
    "address_validate": (lambda c: _flag(validate.address(c)), [("12 Oak Street", "true"), ("ABC", "false"), ("MM/DD/YYYY", "false"), ("", "false")]),
    "identifier_match": (standardize.match_identifier, [("ma-12 34", "MA1234"), ("", "")]),
    "ssn_match": (standardize.match_ssn, [("123-45-6789", "123-45-6789"), ("000-45-6789", ""), ("12", ""), ("", "")]),
    "icd_extract": (standardize.icd_code, [("code I10 here", "I10"), ("M48.56XD collapsed", "M48.56XD"), ("i10", ""), ("", "")]),
    "leading_zeros": (standardize.protect_zeros, [("00123", "'00123"), ("123", "123"), ("0A", "0A"), ("", "")]),
    "diagnosis_clean": (standardize.diagnosis_description, [("Diagnosis: Heart  failure, ", "Heart failure"), ("Dx pain ICD: I10", "pain"), ("", "")]),
    "doc_id_base": (standardize.base_doc_id, [("123_digital", "123"), ("123_OCR_2", "123"), ("123", "123")]),
    "title_case": (text.title, [("mary-ann o'brien", "Mary-Ann O'Brien"), ("ABC 1st", "Abc 1St"), ("", "")]),
    "clean_ascii": (text.clean_ascii, [("a—b \t c\r\n\n\nd ", "a b c\nd"), ("", "")]),
    "clean_lines": (text.clean_lines, [("a\nlong  line\x0cnext one\n\n\n\nab\nend", "long line\nnext one\nend"), ("", "")]),
    "whitespace_collapse": (text.squeeze, [(" a\n\tb  c ", "a b c"), ("", "")]),
    "boilerplate_strip": (text.preprocess, [(DOC, CLEAN), ("x", "x"), ("", "")]),
    "section_split": (lambda c: _fields(text.sections(text.preprocess(c)), "HEADER", "ORDERS", "DIAGNOSES"), [(DOC, "PATIENT DETAILS\nPatient one|ORDERS\nhomecare Date\nDX: yes|DIAGNOSIS\nI10"), ("no section", "||"), ("", "||")]),
    "address_scrub": (text.scrub_address, [("1 Oak St isApprovalWrapper=1", "1 Oak St"), ("1 Oak St Fax Number 555 x", "1 Oak St  x"), ("", "")]),
    "patient_name_extract": (lambda c: _fields(extract.patient_name(c), "last_name", "first_name"), [("CLIENT: BAKER, ALAN", "BAKER|ALAN"), ("Patient: Smith, John A\nx", "Smith|John"), ("Carter, Beth ( MA250415113301 )", "Carter|Beth"), ("Patient: Hyperlipidemia, unspecified", "|"), ("nothing", "|")]),
    "dob_extract": (extract.dob, [("DOB: 1/5/1950", "01/05/1950"), ("Date of Birth: May 15, 1980", "05/15/1980"), ("born 1-5-49", "01/05/2049"), ("none", "")]),
    "gender_extract": (extract.gender, [("Patient's Gender: FEMALE", "FEMALE"), ("Sex: M", "MALE"), ("Sex: M or F", ""), ("Gender: Male or Female, circle one", ""), ("none", "")]),
    "mrn_extract": (extract.mrn, [("(MA250430076706)", "MA250430076706"), ("MR#: C0200089881701", "C0200089881701"), ("MR Number: 000000200", "000000200"), ("(1275520097)", "1275520097"), ("(0000000000)", ""), ("none", "")]),
    "medicare_extract": (extract.medicare_number, [("Patient's Medicare No. 1EG4TE5MK72 SOC", "1EG4TE5MK72"), ("Medicare: 1EG4TE5MK72", "1EG4TE5MK72"), ("none", "")]),
    "ssn_extract": (extract.ssn, [("SSN: 123-45-6789", "123-45-6789"), ("id 123456789 x", "123456789"), ("none", "")]),
    "gender_validate": (lambda c: _flag(validate.gender(c)), [("M", "true"), ("female", "true"), ("x", "false"), ("", "false")]),
    "order_number_extract": (extract.order_number, [("Order Number #1286414219", "1286414219"), ("Order Number: HOME PLAN 38031747", "38031747"), ("Order No. 1234567", "1234567"), ("Order 12", "")]),
    "order_date_extract": (extract.order_date, [("Order Date: 5/1/2024", "05/01/2024"), ("ordered: 5-1-24", "05/01/2024"), ("Visit Date: 1/2/2024 Order Date: 3/4/2024", "01/02/2024"), ("none", "")]),
    "period_extract": (lambda c: _fields(extract.certification_period(c), "start", "end"), [("Certification Period: 5/1/2024 to 6/29/2024", "05/01/2024|06/29/2024"), ("Episode Dates 4/14/2025 - 6/12/2025", "04/14/2025|06/12/2025"), ("SOC Date: 5/1/2024", "05/01/2024|06/29/2024"), ("on 1/1/2024 and on 3/1/2024", "01/01/2024|03/01/2024"), ("none", "|")]),
    "physician_extract": (extract.physician_name, [("Seen by Jane Q Roe, MD", "Jane Q Roe, MD"), ("none", "")]),
    "phone_extract": (extract.phone_number, [("Phone: (508) 555-1234", "(508) 555-1234"), ("call (401)555-9876", "(401) 555-9876"), ("tel 508.555.1234", "508.555.1234"), ("none", "")]),
    "address_extract": (extract.address, [("1215 MAIN ROAD TIVERTON, RI 02878", "1215 MAIN ROAD TIVERTON, RI 02878"), ("none", "")]),
    "city_state_zip": (lambda c: _fields(extract.city_state_zip(c, c), "city", "state", "zip_code"), [("12 OAK ST NORTH DARTMOUTH MA 02747", "North Dartmouth|MA|02747"), ("12 Oak St Tiverton, RI 2878", "Tiverton|RI|02878"), ("9, Tiverton, RI 02878 y", "Tiverton|RI|02878"), ("none", "||")]),
    "provider_extract": (extract.provider_name, [("Agency Name: Bristol Home Care", "Bristol Home Care"), ("none", "")]),
    "icd_extract_all": (lambda c: _diagnoses(extract.diagnoses(c)), [("M48.56XD Collapsed vertebra (E)", "M48.56XD/Collapsed vertebra/other"), ("I10 Essential hypertension\nE11.9 Diabetes", "I10/Essential hypertension/other|E11.9/Diabetes/other"), ("none", "")]),
    "ssn_enhanced": (enhanced.ssn, [("SSN: 123-45-6789", "123-45-6789"), ("Social Security Number: 000-45-6789", ""), ("none", "")]),
    "mrn_enhanced": (enhanced.mrn, [("MRN: 12345678", "12345678"), ("MRN: 0000\nChart #: A1234567", "A1234567"), ("none", "")]),
    "npi_enhanced": (enhanced.npi, [("NPI: 1234567890", "1234567890"), ("NPI 123", ""), ("none", "")]),
    "dob_enhanced": (enhanced.dob, [("Birth Date: 1.5.1950", "1.5.1950"), ("Personal\nseen\n3/4/1960", "3/4/1960"), ("Born 1/5/2031", ""), ("none", "")]),
    "episode_enhanced": (lambda c: _fields(enhanced.episode_dates(c), "start", "end"), [("Start Date: 1/2/2024\nEnd Date: 3/1/2024", "1/2/2024|3/1/2024"), ("2/1/2024 until 3/1/2024", "2/1/2024|3/1/2024"), ("none", "|")]),
    "diagnoses_enhanced": (lambda c: _diagnoses(enhanced.diagnoses(c)), [("Primary Diagnosis: Heart failure\n", "/Heart failure/primary|/Heart failure/secondary"), ("none", "")]),
    "insurance_enhanced": (enhanced.insurance, [("Insurance: Acme  Mutual\n", "Acme Mutual"), ("Payer: 12345", ""), ("none", "")]),
    "json_from_text": (lambda c: F.coalesce(enhanced.json_from_text(c), F.lit("none")), [('Sure: ```json\n{"dob": "1/1/1950"}\n``` ok', '{"dob": "1/1/1950"}'), ("{not json}", "none"), ("", "none")]),
    "id_list": (lambda c: _joined(files.parse_id_list(c)), [("1, 2\n3  4", "1|2|3|4"), ("", "")]),
    "payload_locate": (lambda c: F.coalesce(files.locate_payload(c), F.lit("none")), [('{"value": {"documentBuffer": "QQ=="}, "document": "x"}', "QQ=="), ('{"documentBuffer": "", "pdf": "UQ=="}', "UQ=="), ('{"other": "short"}', "none")]),
    "payload_decode": (lambda c: F.concat_ws("|", files.decode_payload(c)["is_pdf"].cast("string"), files.decode_payload(c)["error"]), [("JVBERi0xLjQ=", "true|"), ("QUJD", "false|"), ("", "false|Empty PDF buffer after decoding"), ("%%%", "false|Base64 decode error")]),
    "reply_status": (lambda c: F.coalesce(F.concat_ws("|", files.reply_status(c)["status_code"].cast("string"), files.reply_status(c)["error"]), F.lit("")), [('{"isSuccess": false, "errorCode": "NOT_FOUND", "errorMessage": "no"}', "404|Document not found: no"), ('{"isSuccess": false}', "200|API error (UNKNOWN_ERROR): No error message provided"), ('{"isSuccess": true}', "")]),
}


def query(name: str):
    function, rows = CASES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
        orders = spread(orders)
        inputs = F.get(F.array(*(F.lit(i) for i, _ in rows)), F.pmod("o_orderkey", F.lit(len(rows))).cast("int"))
        # the input is settled before a long function refers to it many times
        settled = orders.select("o_orderkey", F.inline(F.array(F.struct(inputs.alias("input")))))
        return settled.select("o_orderkey", function(F.col("input")).alias("value"))

    return run


def oracle(name: str) -> str:
    _, rows = CASES[name]
    quote = lambda s: "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    when = " ".join(f"WHEN {k} THEN {quote(e)}" for k, (_, e) in enumerate(rows))
    return f"SELECT o_orderkey, CASE o_orderkey % {len(rows)} {when} END AS value FROM orders"
