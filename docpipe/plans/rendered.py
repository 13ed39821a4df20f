"""Functions applied to values that are rendered from the tables.

Every order, with its customer, gives each function an input in one of several written forms;
SQL says from the same columns what must come out. Hand-worked inputs for the same functions
are in ``cases`` and run as tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import standardize, text
from ..operators import enhanced, merge
from ..scratch import spread
from ..schemas import ORDER, PATIENT, record, settle
from . import cases
from .queries import _PEOPLE, people, table


def numbers() -> dict:
    """Numbers drawn from an order's key k."""
    digits = lambda factor, n: F.lpad((F.col("k") * factor % 10**n).cast("string"), n, "0")
    return {"nine": digits(7_919, 9), "five": digits(31, 5), "four": digits(17, 4), "ten": F.concat(F.lit("1"), digits(7_919, 9))}


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order (k) with numbers drawn from the key, whether or not it has a customer."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).withColumns(numbers())


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order (k, day) with its customer's made-up facts, and numbers drawn from the key."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey"), F.col("o_orderdate").cast("date").alias("day"))
    rows = o.join(people(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    return rows.withColumns(numbers())


_FACTS = f"""{_PEOPLE}, f AS (
  SELECT o_orderkey AS k, o_orderdate::DATE AS day, p.*, lpad((o_orderkey * 7919 % 1000000000)::VARCHAR, 9, '0') AS nine, lpad((o_orderkey * 31 % 100000)::VARCHAR, 5, '0') AS five,
         lpad((o_orderkey * 17 % 10000)::VARCHAR, 4, '0') AS four, '1' || lpad((o_orderkey * 7919 % 1000000000)::VARCHAR, 9, '0') AS ten
  FROM orders JOIN people p ON o_custkey = c_custkey)"""
_KEYED = "f AS (SELECT o_orderkey AS k, lpad((o_orderkey * 7919 % 1000000000)::VARCHAR, 9, '0') AS nine FROM orders)"


def dated(column: str, *forms: str):
    """The date in the form that the key chooses; quoted parts of a form stand as they are."""

    def make(k):
        out = F.date_format(F.col(column), forms[0])
        for i, form in enumerate(forms[1:], 1):
            out = F.when(k % len(forms) == i, F.date_format(F.col(column), form)).otherwise(out)
        return out

    return make


def chosen(*forms):
    """The input that the key chooses: texts with {column} parts."""

    def make(k):
        built = [F.format_string(_pattern(x), *map(F.col, _names(x))) if _names(x) else F.lit(x) for x in forms]
        out = built[0]
        for i, x in enumerate(built[1:], 1):
            out = F.when(k % len(forms) == i, x).otherwise(out)
        return out

    return make


def _names(form: str) -> list[str]:
    return [p.split("}")[0] for p in form.split("{")[1:]]


def _pattern(form: str) -> str:
    for n in _names(form):
        form = form.replace("{" + n + "}", "\0", 1)
    return form.replace("%", "%%").replace("\0", "%s")


def by_key(*expected: str) -> str:
    """SQL of the outcome that the key chooses, in the order of the forms."""
    return "CASE k % " + str(len(expected)) + " " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(expected)) + " END"


def _of(column: str, form: str = "%m/%d/%Y") -> str:
    return f"strftime({column}, '{form}')"


def _pivot(column: str, last: int) -> str:
    """SQL of a date whose year was written with two digits."""
    return f"(strftime({column}, '%m/%d/') || (CASE WHEN year({column}) % 100 <= {last} THEN 2000 ELSE 1900 END + year({column}) % 100))"


_DASHED = "(substr(nine, 1, 3) || '-' || substr(nine, 4, 2) || '-' || substr(nine, 6, 4))"
_CODES, _STATES = list(standardize.STATES.values()), list(standardize.STATES)
_LIST = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
_GIVEN = [*standardize.COMMON_MALE, *standardize.COMMON_FEMALE, "ZED", "QUILL"]


def _from_list(values, change=F.lower):
    return lambda k: change(F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int")))


_CAP = "(upper(substr({0}, 1, 1)) || lower(substr({0}, 2)))"
_LAST_FIRST = "last || ', ' || first"

#: name: (input, SQL of the outcome); the function is the one of ``cases``.
RENDERED = {
    "date_standardize_multi_format": (dated("dob", "M/d/yyyy", "'DOB: 'M-d-yyyy", "yyyy.M.d", "MMMM d, yyyy", "d MMM yyyy", "'born 'M/d/yyyy' age 40'", "'nothing here'"), by_key(*[_of("dob")] * 6, "''")),
    "date_yy_pivot": (dated("dob", "M/d/yyyy", "M-d-yy", "MMMM d, yyyy", "M/d/yyyy h:mm a", "'soon'"), by_key(_of("dob"), _pivot("dob", 49), _of("dob"), _of("dob"), "'soon'")),
    "date_worklist": (dated("dob", "M/d/yyyy", "M.d.yy", "yyyy/M/d", "MMM d, yyyy", "d MMMM yyyy", "'none of these'"), by_key(_of("dob"), _pivot("dob", 68), _of("dob"), _of("dob"), _of("dob"), "'none'")),
    "date_backfill": (dated("dob", "M/d/yyyy", "dd-MMM-yyyy", "yyyy-M-d", "M-d-yy", "yyyy/M/d"), by_key(_of("dob"), _of("dob"), _of("dob"), _pivot("dob", 68), "''")),
    "date_match": (dated("dob", "MM/dd/yyyy", "MMddyyyy", "MMddyy", "'no'"), by_key(_of("dob"), _of("dob"), _pivot("dob", 50), "''")),
    "date_strict": (dated("dob", "MM/dd/yyyy", "M/d/yyyy", "yyyy-MM-dd"), by_key("'true'", "CASE WHEN month(dob) > 9 AND day(dob) > 9 THEN 'true' ELSE 'false' END", "'false'")),
    "date_reasonable": (lambda k: F.date_format(F.add_months("dob", (12 * (k % 150 - 60)).cast("int")), "M/d/yyyy"), "CASE WHEN year(dob) + k % 150 - 60 >= 1900 THEN CASE WHEN year(dob) + k % 150 - 60 <= 2024 THEN 'true' ELSE 'false' END WHEN month(dob) > 9 OR day(dob) > 9 THEN 'true' ELSE 'false' END"),
    "episode_end_plus_59": (dated("day", "MM/dd/yyyy", "'02/30/'yyyy"), by_key(_of("(day + 59)"), "''")),
    "episode_pair_best": (lambda k: F.when(k % 3 == 0, F.concat(F.date_format("day", "M/d/yyyy"), F.lit(" and "), F.date_format(F.date_add("day", 19), "M/d/yyyy"))).otherwise(F.concat(F.date_format("day", "M/d/yyyy"), F.lit(" to "), F.date_format(F.date_add("day", 59), "M-d-yyyy"), F.lit(", again "), F.date_format(F.date_add("day", 400), "M/d/yyyy"))), f"CASE WHEN k % 3 = 0 THEN '|' ELSE {_of('day')} || '|' || {_of('(day + 59)')} END"),
    "gender_standardize": (lambda k: F.when(k % 4 == 0, F.lower("sex")).when(k % 4 == 1, F.concat(F.lit(" "), F.substring("sex", 1, 1), F.lit(". "))).when(k % 4 == 2, F.initcap("sex")).otherwise(F.concat(F.lower("sex"), F.lit(" or other"))), by_key("sex", "sex", "sex", "''")),
    "gender_from_name": (_from_list(_GIVEN, F.initcap), f"CASE WHEN k % {len(_GIVEN)} < {len(standardize.COMMON_MALE)} THEN 'MALE' WHEN k % {len(_GIVEN)} < {len(_GIVEN) - 2} THEN 'FEMALE' ELSE '' END"),
    "phone_standardize": (lambda k: F.when(k % 4 == 0, F.regexp_replace("phone", r"\D", "")).when(k % 4 == 1, F.concat(F.lit("1-"), F.regexp_replace("phone", r"\D+", "."))).when(k % 4 == 2, F.col("phone")).otherwise(F.concat(F.lit(" "), F.substring("phone", 7, 8))), by_key("phone", "phone", "phone", "substr(phone, 7, 8)")),
    "ssn_standardize": (lambda k: F.when(k % 3 == 0, F.col("nine")).when(k % 3 == 1, F.concat_ws(" ", F.substring("nine", 1, 3), F.substring("nine", 4, 2), F.substring("nine", 6, 4))).otherwise(F.concat(F.lit(" "), F.col("four"), F.lit(" "))), by_key(_DASHED, _DASHED, "four")),
    "ssn_match": (lambda k: F.when(k % 3 == 0, F.col("nine")).when(k % 3 == 1, F.concat_ws("-", F.substring("nine", 1, 3), F.substring("nine", 4, 2), F.substring("nine", 6, 4))).otherwise(F.concat(F.lit("000"), F.substring("nine", 4, 6))), f"CASE WHEN k % 3 = 2 OR nine LIKE '000%' THEN '' ELSE {_DASHED} END"),
    "zip_standardize": (chosen("{five}", "{five}{four}", "MA {five}", "{five}-{four}", " {four} "), by_key("five", "five || '-' || four", "five", "five || '-' || four", "four")),
    "state_standardize": (lambda k: F.when(k % 2 == 0, _from_list(_CODES)(k)).otherwise(_from_list(_STATES, F.initcap)(k)), f"{_LIST(_CODES)}[k % {len(_CODES)} + 1]"),
    "mrn_standardize": (lambda k: F.when(k % 4 == 0, F.lower("mrn")).when(k % 4 == 1, F.concat_ws(" ", F.substring("mrn", 1, 2), F.substring("mrn", 3, 11))).when(k % 4 == 2, F.col("nine")).otherwise(F.col("five")), by_key("mrn", "mrn", "nine", "''")),
    "mrn_validate": (chosen("{mrn}", "{nine}", "{four}", "000000", "RECORD"), by_key("'true'", "CASE WHEN nine = repeat(substr(nine, 1, 1), 9) THEN 'false' ELSE 'true' END", "'false'", "'false'", "'false'")),
    "identifier_match": (lambda k: F.concat_ws("-", F.lower(F.substring("mrn", 1, 2)), F.substring("mrn", 3, 20), F.col("four")), "mrn || four"),
    "name_standardize": (lambda k: F.when(k % 4 == 0, F.lower(F.concat_ws(" ", "first", "last"))).when(k % 4 == 1, F.concat(F.upper("last"), F.lit(" jr"))).when(k % 4 == 2, F.concat(F.lit("mc"), F.lower("last"))).otherwise(F.concat(F.lit("O'"), F.upper("last"), F.lit("!  "), F.lower("first"))), by_key("first || ' ' || last", "last || ' JR'", "'Mc' || last", "'O''' || last || ' ' || first")),
    "name_last_first": (lambda k: F.when(k % 3 == 0, F.lower(F.concat("last", F.lit(", "), "first", F.lit(" q")))).when(k % 3 == 1, F.upper(F.concat_ws("  ", "first", F.lit("ann"), "last"))).otherwise(F.upper("last")), by_key(f"{_LAST_FIRST} || ' Q'", f"{_LAST_FIRST} || ' Ann'", "last")),
    "name_worklist_split": (lambda k: F.when(k % 3 == 0, F.upper(F.concat("last", F.lit(", "), "first", F.lit(" allan")))).when(k % 3 == 1, F.lower(F.concat_ws(" ", "first", F.lit("q"), "last"))).otherwise(F.lower("first")), by_key("first || '|' || last", "first || '|' || last", "first || '|'")),
    "name_match": (chosen("Mr. {first} {last} Jr.", "Robert {last}", "dr {first}-Ann {last}, iii", "{last}"), by_key("upper(first || ' ' || last)", "'BOB ' || upper(last)", "upper(first || '-Ann ' || last)", "upper(last)")),
    "patient_name_validate": (chosen("{last}, {first}", "{last}, I10 {first}", "PRN", "{last}", "Hyperlipidemia, {first}"), by_key("'true'", "'false'", "'false'", "'true'", "'false'")),
    "provider_validate": (chosen("{last} Home Health", "{nine}", "{last}-1", "a-{nine}", "AM"), by_key("'true'", "'false'", "'true'", "'false'", "'false'")),
    "address_validate": (chosen("{five} {last} Street", "MM/DD/YYYY {five}", "RI"), by_key("'true'", "'false'", "'false'")),
    "leading_zeros": (lambda k: F.when(k % 3 == 0, F.lpad(k.cast("string"), 11, "0")).when(k % 3 == 1, k.cast("string")).otherwise(F.concat(F.lit("0"), k, F.lit("A"))), by_key("'''' || lpad(k::VARCHAR, 11, '0')", "k::VARCHAR", "'0' || k || 'A'")),
    "diagnosis_clean": (chosen("Diagnosis:  trouble   of {last}, ", "dx trouble {five} ICD: I10", "{last}  trouble;;"), by_key("'trouble of ' || last", "'trouble ' || five", "last || ' trouble'")),
    "doc_id_base": (chosen("{k}_digital_2", "{k}_OCR", "{k}"), "k::VARCHAR"),
    "title_case": (lambda k: F.lower(F.concat(F.col("first"), F.lit("-"), F.col("last"), F.lit(" o'"), F.col("last"), F.lit(" 1st"))), "first || '-' || last || ' O''' || last || ' 1St'"),
    "clean_ascii": (lambda k: F.concat(F.col("first"), F.lit(" é\t "), F.col("last"), F.lit("\r\n\n\n"), F.col("five"), F.lit(" —")), "first || ' ' || last || chr(10) || five"),
    "clean_lines": (lambda k: F.concat(F.lit("a\n"), F.col("first"), F.lit("   \t"), F.col("last"), F.lit("\x0c"), F.col("five"), F.lit("\n\n\n\nab\nend")), "first || ' ' || last || chr(10) || five || chr(10) || 'end'"),
    "whitespace_collapse": (lambda k: F.concat(F.lit(" "), F.col("first"), F.lit("\n\t"), F.col("last"), F.lit("  "), F.col("five"), F.lit(" ")), "first || ' ' || last || ' ' || five"),
    "address_scrub": (chosen("{five} Oak St isApprovalWrapper={nine}", "{five} Oak St Fax Number {nine} x", "{five} Elm St"), by_key("five || ' Oak St'", "five || ' Oak St  x'", "five || ' Elm St'")),
    "icd_extract": (lambda k: F.concat(F.lit("seen with "), F.char(65 + k % 26), F.lpad((k % 100).cast("string"), 2, "0"), F.when(k % 3 == 0, F.concat(F.lit("."), k % 10)).otherwise(F.lit("")), F.lit(" today")), "chr((65 + k % 26)::INTEGER) || lpad((k % 100)::VARCHAR, 2, '0') || CASE WHEN k % 3 = 0 THEN '.' || k % 10 ELSE '' END"),
    "patient_name_extract": (lambda k: F.when(k % 3 == 0, F.concat(F.lit("Patient: "), F.col("last"), F.lit(", "), F.col("first"), F.lit(" A\nx"))).when(k % 3 == 1, F.concat(F.lit("CLIENT: "), F.upper("last"), F.lit(", "), F.upper("first"))).otherwise(F.lit("nothing")), by_key("last || '|' || first", "upper(last) || '|' || upper(first)", "'|'")),
    "dob_extract": (dated("dob", "'DOB: 'M/d/yyyy", "'Date of Birth: 'MMMM d, yyyy", "'born 'M-d-yy", "'none'"), by_key(_of("dob"), _of("dob"), _pivot("dob", 49), "''")),
    "gender_extract": (lambda k: F.when(k % 3 == 0, F.concat(F.lit("Patient's Gender: "), F.col("sex"))).when(k % 3 == 1, F.concat(F.lit("Sex: "), F.substring("sex", 1, 1))).otherwise(F.lit("none")), by_key("sex", "sex", "''")),
    "mrn_extract": (chosen("MR#: {mrn}", "MR Number: {ten}", "none"), by_key("mrn", "ten", "''")),
    "medicare_extract": (chosen("Patient's Medicare No. 1EG{four}MK72 SOC", "Medicare: A{ten}", "none"), by_key("'1EG' || four || 'MK72'", "'A' || ten", "''")),
    "ssn_extract": (lambda k: F.when(k % 3 == 0, F.concat(F.lit("SSN: "), F.concat_ws("-", F.substring("nine", 1, 3), F.substring("nine", 4, 2), F.substring("nine", 6, 4)))).when(k % 3 == 1, F.concat(F.lit("id "), F.col("nine"), F.lit(" x"))).otherwise(F.lit("none")), by_key(_DASHED, "nine", "''")),
    "gender_validate": (lambda k: F.when(k % 3 == 0, F.lower("sex")).when(k % 3 == 1, F.substring("sex", 1, 1)).otherwise(F.col("last")), by_key("'true'", "'true'", "'false'")),
    "order_number_extract": (chosen("Order Number #{ten}", "Order Number: HOME PLAN 3{nine}", "Order No. 7{nine}", "Order 12"), by_key("ten", "'3' || nine", "'7' || nine", "''")),
    "order_date_extract": (dated("day", "'Order Date: 'M/d/yyyy", "'ordered: 'M-d-yy", "'none'"), by_key(_of("day"), _of("day"), "''")),
    "phone_extract": (chosen("Phone: {phone}", "none"), by_key("phone", "''")),
    "provider_extract": (chosen("Agency Name: {last} Home Care", "none"), by_key("last || ' Home Care'", "''")),
    "physician_extract": (chosen("Seen by {first} Q {last}, MD", "none"), by_key("first || ' Q ' || last || ', MD'", "''")),
    "ssn_enhanced": (lambda k: F.when(k % 2 == 0, F.concat(F.lit("SSN: "), F.concat_ws("-", F.substring("nine", 1, 3), F.substring("nine", 4, 2), F.substring("nine", 6, 4)))).otherwise(F.lit("none")), f"CASE WHEN k % 2 = 0 AND nine NOT LIKE '000%' THEN {_DASHED} ELSE '' END"),
    "npi_enhanced": (chosen("NPI: {ten}", "NPI {four}"), by_key("ten", "''")),
    "mrn_enhanced": (chosen("MRN: 1{nine}", "none"), by_key("'1' || nine", "''")),
    "dob_enhanced": (dated("dob", "'Birth Date: 'M.d.yyyy", "'Personal\nseen\n'M/d/yyyy", "'none'"), by_key("month(dob) || '.' || day(dob) || '.' || year(dob)", "month(dob) || '/' || day(dob) || '/' || year(dob)", "''")),
    "insurance_enhanced": (chosen("Insurance: {last}  Mutual\n", "Payer: 12345"), by_key("last || ' Mutual'", "''")),
    "id_list": (chosen("{five}, {nine}\n{four}  {ten}", ""), by_key("five || '|' || nine || '|' || four || '|' || ten", "''")),
    "json_from_text": (lambda k: F.when(k % 2 == 0, F.concat(F.lit('Sure: ```json\n{"name": "'), F.col("last"), F.lit('", "no": '), k, F.lit("}\n``` ok"))).otherwise(F.concat(F.lit("{not json "), k, F.lit("}"))), by_key("'{\"name\": \"' || last || '\", \"no\": ' || k || '}'", "'none'")),
    "payload_locate": (lambda k: F.when(k % 3 == 0, F.concat(F.lit('{"value": {"documentBuffer": "A'), F.col("nine"), F.lit('"}, "document": "x"}'))).when(k % 3 == 1, F.concat(F.lit('{"documentBuffer": "", "pdf": "B'), F.col("nine"), F.lit('"}'))).otherwise(F.lit('{"other": "short"}')), by_key("'A' || nine", "'B' || nine", "'none'")),
    "payload_decode": (lambda k: F.when(k % 4 == 0, F.base64(F.encode(F.concat(F.lit("%PDF-1.4 "), F.col("nine")), "UTF-8"))).when(k % 4 == 1, F.base64(F.encode("nine", "UTF-8"))).when(k % 4 == 2, F.lit("")).otherwise(F.lit("%%%")), by_key("'true|'", "'false|'", "'false|Empty PDF buffer after decoding'", "'false|Base64 decode error'")),
    "reply_status": (lambda k: F.when(k % 3 == 0, F.concat(F.lit('{"isSuccess": false, "errorCode": "NOT_FOUND", "errorMessage": "no '), F.col("five"), F.lit('"}'))).when(k % 3 == 1, F.concat(F.lit('{"isSuccess": false, "errorCode": "E'), F.col("four"), F.lit('"}'))).otherwise(F.lit('{"isSuccess": true}')), by_key("'404|Document not found: no ' || five", "'200|API error (E' || four || '): No error message provided'", "''")),
}


#: Functions whose inputs need the order's key alone: every order has its row, also without a customer.
KEYED = ("payload_decode",)


def query(name: str):
    make, _ = RENDERED[name]
    function, _ = cases.CASES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = settle(spread((keyed if name in KEYED else facts)(spark, sf_dir)), {"input": make(F.col("k"))})
        return rows.select(F.col("k").alias("o_orderkey"), function(F.col("input")).alias("value"))

    return run


def oracle(name: str) -> str:
    return f"WITH {_KEYED if name in KEYED else _FACTS} SELECT k AS o_orderkey, {RENDERED[name][1]} AS value FROM f"


# --- functions of several columns ---------------------------------------------


def records_enhance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with gaps, filled from a rendered text and put in standard forms."""
    k = F.col("k")
    said = F.format_string("Birth Date: %s\nSSN: %s\nMRN: 1%s\nNPI: %s\nInsurance: %s  Mutual\n", F.date_format("dob", "M/d/yyyy"), F.concat_ws("-", F.substring("nine", 1, 3), F.substring("nine", 4, 2), F.substring("nine", 6, 4)), "nine", "ten", "last")
    patient = record(PATIENT, {"patient_fname": F.lower("first"), "patient_lname": F.upper("last"), "dob": F.when(k % 2 == 0, F.date_format("dob", "M-d-yyyy")), "patient_sex": F.when(k % 3 == 0, F.lower("sex")), "phone_number": F.regexp_replace("phone", r"\D", ""), "medical_record_no": F.when(k % 5 == 0, F.lower("mrn"))})
    rows = settle(spread(facts(spark, sf_dir)), {"said": said, "patient": patient, "order": record(ORDER, {})})
    rows = settle(rows, {"found": enhanced.critical_fields(F.col("said"))})
    rows = settle(rows, {"e": merge.enhance(F.col("patient"), F.col("order"), F.col("found"))})
    p, o = F.col("e.patient"), F.col("e.order")
    return rows.select("k", p["patient_fname"].alias("fname"), p["patient_lname"].alias("lname"), p["dob"].alias("dob"), p["ssn"].alias("ssn"), p["medical_record_no"].alias("mrn"), p["patient_sex"].alias("sex"), p["phone_number"].alias("phone"), o["physician_npi"].alias("npi"), o["insurance_payer"].alias("payer"))


def section_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read for a patient and for an order: its section, or the whole text without one."""
    k = F.col("k")
    said = F.when(k % 2 == 0, F.format_string("PATIENT INFORMATION\nName %s\nORDERS\nGive %s", "last", "five")).otherwise(F.format_string("Name %s\nonly %s", "last", "five"))
    rows = settle(spread(facts(spark, sf_dir)), {"clean": text.preprocess(said)})
    rows = settle(rows, {"sec": text.sections(F.col("clean"))})
    return rows.select("k", text.route(F.col("sec.HEADER"), F.col("clean")).alias("for_patient"), text.route(F.col("sec.ORDERS"), F.col("clean")).alias("for_order"))


EXTRA = {"records_enhance": records_enhance, "section_route": section_route}
EXTRA_SQL = {
    "records_enhance": f"""WITH {_FACTS} SELECT k, first AS fname, last AS lname, {_of('dob')} AS dob, CASE WHEN nine LIKE '000%' THEN '' ELSE {_DASHED} END AS ssn, CASE WHEN k % 5 = 0 THEN mrn ELSE '1' || nine END AS mrn,
      CASE WHEN k % 3 = 0 THEN sex ELSE '' END AS sex, phone, ten AS npi, last || ' Mutual' AS payer FROM f""",
    "section_route": f"""WITH {_FACTS} SELECT k, CASE WHEN k % 2 = 0 THEN 'PATIENT INFORMATION' || chr(10) || 'Name ' || last ELSE 'Name ' || last || chr(10) || 'only ' || five END AS for_patient,
      CASE WHEN k % 2 = 0 THEN 'ORDERS' || chr(10) || 'Give ' || five ELSE 'Name ' || last || chr(10) || 'only ' || five END AS for_order FROM f""",
}
