"""Extraction of record fields from document text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, patterns, standardize, text, validate
from ..schemas import DIAGNOSIS, ORDER, PATIENT, let, or_empty, record, settle
from .cascade import LINES, capture, first_match, first_pair, where_possible

# Fixed values.
STREET_WORDS = ("St", "Street", "Rd", "Road", "Ave", "Avenue", "Dr", "Drive", "Ln", "Lane", "Blvd", "Boulevard", "Way", "Hwy", "Highway")
DIRECTIONS = ("North", "South", "East", "West", "New", "Ft", "Fort", "St", "Saint")
CITY_END = r"([A-Za-z][A-Za-z\s\.]+?)\s*,?\s+([A-Z]{2})\s+(\d{4,5}(?:-\d{4})?)$"
CITY_ANYWHERE = r"([A-Za-z][A-Za-z\s\.]+?),\s+([A-Z]{2})\s+(\d{4,5}(?:-\d{4})?)"
MORE_DIAGNOSES = (
    r"([A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?)\s+([A-Za-z][A-Za-z0-9\s,.\-'():/]+?)\s+\([EO]\)",
    r"([A-Za-z][A-Za-z0-9\s,.\-'():/]{10,}?)\s+([A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?)\s*$",
)
CODE_LIKE = r"^[A-Z][0-9]{2}"
PLAN_DAYS = 59


def patient_name(t: Column) -> Column:
    return standardize.split_full_name(first_match(t, patterns.PATIENT_NAME, valid=validate.patient_name))


def dob(t: Column) -> Column:
    return dates.normalize_extracted_date(first_match(t, patterns.DOB))


def gender(t: Column) -> Column:
    """Form labels ("M or F", "circle one") within 20 characters of a match pass the turn on."""

    def found(p: str) -> Column:
        said = F.upper(text.strip(F.regexp_extract(t, LINES + p, 1)))
        near = _around(t, F.regexp_extract(t, LINES + p, 0), p)
        return let(said, lambda x: F.when((x != "") & validate.gender(x) & ~validate.is_form_label(near), x))

    first = let(F.upper(t), lambda upper: F.coalesce(*(where_possible(upper, p, found(p)) for p in patterns.GENDER)))
    return let(F.substring(first, 1, 1), lambda x: F.when(x == "M", "MALE").when(x == "F", "FEMALE").otherwise(""))


def _around(t: Column, whole: Column, pattern: str) -> Column:
    """A match with up to 20 characters on either side."""
    at = F.regexp_instr(t, F.lit(LINES + pattern))
    return let(at, lambda k: F.substring(t, F.greatest(k - 20, F.lit(1)), F.length(whole) + 20 + F.least(k - 1, F.lit(20))))


def gender_with_name(t: Column, first_name: Column) -> Column:
    """What a common first name tells goes before what the text says."""
    named = standardize.gender_from_name(first_name, standardize.EXTRACTED_MALE, standardize.EXTRACTED_FEMALE)
    return F.when(named != "", named).otherwise(gender(t))


def mrn(t: Column) -> Column:
    return first_match(t, patterns.MRN, valid=validate.mrn)


def medicare_number(t: Column) -> Column:
    return first_match(t, patterns.MEDICARE)


def ssn(t: Column) -> Column:
    return first_match(t, patterns.SSN)


def order_number(t: Column) -> Column:
    return first_match(t, patterns.ORDER_NUMBER)


def order_date(t: Column) -> Column:
    return dates.normalize_extracted_date(first_match(t, patterns.ORDER_DATE))


def start_of_care(t: Column) -> Column:
    return dates.normalize_extracted_date(first_match(t, patterns.SOC))


def certification_period(t: Column, kinds: tuple[str, ...] = ("numeric",), soc: Column | None = None) -> Column:
    """Struct (start, end): a stated period, else the likeliest pair of dates, else 60 days from the start of care."""
    stated = let(first_pair(t, patterns.CERT_PERIOD), lambda x: F.when(x.isNotNull(), F.struct(dates.normalize_extracted_date(x["first"]).alias("start"), dates.normalize_extracted_date(x["second"]).alias("end"))))
    from_soc = let(start_of_care(t) if soc is None else soc, lambda x: F.when(dates.is_calendar_date(x), F.struct(dates.add_days(x, 0).alias("start"), dates.add_days(x, PLAN_DAYS).alias("end"))))
    none = F.struct(F.lit("").alias("start"), F.lit("").alias("end"))
    return F.coalesce(stated, dates.best_episode_pair(dates.all_dates(t, kinds)), from_soc, none)


def physician_name(t: Column) -> Column:
    return first_match(t, patterns.PHYSICIAN)


def phone_number(t: Column) -> Column:
    def found(k: int, p: str) -> Column:
        if k > 1:
            return capture(t, p)
        three = F.concat(F.lit("("), F.regexp_extract(t, LINES + p, 1), F.lit(") "), F.regexp_extract(t, LINES + p, 2), F.lit("-"), F.regexp_extract(t, LINES + p, 3))
        return F.when(F.rlike(t, F.lit(LINES + p)), three)

    return let(F.upper(t), lambda upper: F.coalesce(*(where_possible(upper, p, found(k, p)) for k, p in enumerate(patterns.PHONE)), F.lit("")))


def address(t: Column) -> Column:
    return first_match(t, patterns.ADDRESS, valid=validate.address, post=text.scrub_address)


def provider_name(t: Column) -> Column:
    return first_match(t, patterns.PROVIDER, valid=validate.provider)


def _pad_zip(z: Column) -> Column:
    return F.when(F.rlike(z, F.lit(r"^\d{4}$")), F.concat(F.lit("0"), z)).otherwise(z)


def city_state_zip(addr: Column, whole: Column) -> Column:
    """Struct city, state, zip_code from an address's end, blanks filled from anywhere in the text."""
    return let(text.squeeze(addr), lambda a: let(_city_words(a), lambda words: _place(a, words, whole)))


def _city_words(a: Column) -> Column:
    return F.filter(F.split(text.title(text.strip(F.regexp_extract(a, CITY_END, 1))), r"\s+"), lambda w: (w != "") & ~w.isin(*STREET_WORDS))


def _place(a: Column, words: Column, whole: Column) -> Column:
    pair = (F.size(words) >= 2) & F.coalesce(F.try_element_at(words, F.lit(-2)).isin(*DIRECTIONS), F.lit(False))
    city = F.when(pair, F.array_join(F.slice(words, F.size(words) - 1, 2), " ")).otherwise(or_empty(F.try_element_at(words, F.lit(-1))))
    at_end = F.struct(city.alias("city"), F.upper(F.regexp_extract(a, CITY_END, 2)).alias("state"), _pad_zip(F.regexp_extract(a, CITY_END, 3)).alias("zip_code"))
    none = F.struct(*(F.lit("").alias(x) for x in ("city", "state", "zip_code")))
    return let(F.when(F.rlike(a, F.lit(CITY_END)), at_end).otherwise(none), lambda own: _filled(own, whole))


def _filled(own: Column, whole: Column) -> Column:
    # how the pattern ends is looked for first: that takes no search for where it begins
    fill = ((own["city"] == "") | (own["state"] == "")) & F.rlike(whole, F.lit(r",\s+[A-Z]{2}\s+\d{4}")) & F.rlike(whole, F.lit(CITY_ANYWHERE))
    other = lambda x, new: F.when(own[x] == "", new).otherwise(own[x]).alias(x)
    filled = F.struct(
        other("city", text.strip(text.title(F.regexp_extract(whole, CITY_ANYWHERE, 1)))),
        other("state", F.upper(F.regexp_extract(whole, CITY_ANYWHERE, 2))),
        other("zip_code", _pad_zip(F.regexp_extract(whole, CITY_ANYWHERE, 3))),
    )
    return F.when(fill, filled).otherwise(own)


def primary_diagnosis(t: Column) -> Column:
    """Struct icd_code, description: both groups as they stand (a pattern without a description leaves it empty)."""

    def found(p: str) -> Column:
        second = F.lit("") if _groups(p) < 2 else text.strip(F.regexp_extract(t, LINES + p, 2))
        out = F.when(F.rlike(t, F.lit(LINES + p)), F.struct(F.regexp_extract(t, LINES + p, 1).alias("icd_code"), second.alias("description")))
        return F.when(F.rlike(t, F.lit(LINES + NEEDS[p])), out) if p in NEEDS else out

    none = F.struct(F.lit("").alias("icd_code"), F.lit("").alias("description"))
    return let(F.upper(t), lambda upper: F.coalesce(*(where_possible(upper, p, found(p)) for p in patterns.DIAGNOSIS), none))


def _groups(pattern: str) -> int:
    import re

    return re.compile(pattern).groups


def _found(t: Column, pattern: str, keep_uncoded: bool) -> Column:
    """All matches of a pattern as diagnoses; code and description change places if the first is no code."""
    single = _groups(pattern) == 1
    every = lambda group: F.regexp_extract_all(t, F.lit(LINES + pattern), F.lit(group))

    def make(a: Column, b: Column) -> Column:
        pair = F.struct(text.strip(a).alias("a"), text.strip(b).alias("b"))
        turned = lambda x: F.when(F.rlike(x["a"], F.lit(CODE_LIKE)) | F.lit(single), F.struct(x["a"].alias("code"), x["b"].alias("desc"))).otherwise(F.struct(x["b"].alias("code"), x["a"].alias("desc")))
        return let(let(pair, turned), finish)

    def finish(x: Column) -> Column:
        clean = F.regexp_replace(F.regexp_replace(text.squeeze(x["desc"]), r"\s+\([EO]\)\s*$", ""), r"\s+Start Effective Date.*$", "")
        desc = F.when(F.rlike(x["code"], F.lit(CODE_LIKE)), clean).otherwise(x["desc"])
        return F.struct(x["code"].alias("diagnosis_code"), desc.alias("diagnosis_description"), F.lit("other").alias("diagnosis_type"), F.lit("ICD-10").alias("icd_version"))

    out = F.transform(every(1), lambda a: make(a, F.lit(""))) if single else F.zip_with(every(1), every(2), make)
    return out if keep_uncoded else F.filter(out, lambda d: F.rlike(d["diagnosis_code"], F.lit(CODE_LIKE)))


def dedup_by_code(diagnoses: Column) -> Column:
    """The first diagnosis of each code, order kept."""
    empty = F.array().cast(f"array<{DIAGNOSIS.simpleString()}>")
    return F.aggregate(diagnoses.cast(f"array<{DIAGNOSIS.simpleString()}>"), empty, lambda acc, d: F.when(F.exists(acc, lambda x: x["diagnosis_code"].eqNullSafe(d["diagnosis_code"])), acc).otherwise(F.concat(acc, F.array(d))))


#: What a text must hold for the patterns that end in a code to match at all. They start
#: anywhere and run across lines, so that looking for their ends first saves most of the time.
NEEDS = {patterns.DIAGNOSIS[5]: r"\s\([A-Z][0-9]{2}", MORE_DIAGNOSES[1]: r"\s[A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?\s*$"}


def found_diagnoses(t: Column) -> Column:
    """All diagnoses that any pattern finds, in the order of patterns and then of the text."""
    kind = f"array<{DIAGNOSIS.simpleString()}>"
    none = F.array().cast(kind)

    def found(upper: Column, pattern: str, keep_uncoded: bool) -> Column:
        out = _found(t, pattern, keep_uncoded).cast(kind)
        out = F.when(F.rlike(t, F.lit(LINES + NEEDS[pattern])), out) if pattern in NEEDS else out
        return F.coalesce(where_possible(upper, pattern, out), F.when(t.isNotNull(), none))

    return let(F.upper(t), lambda upper: F.concat(*(found(upper, p, True) for p in patterns.DIAGNOSIS), *(found(upper, p, False) for p in MORE_DIAGNOSES)))


def diagnoses(t: Column) -> Column:
    """All diagnoses of a text, once a code; if there are none, the primary one."""
    return unique_or_primary(found_diagnoses(t), t)


def unique_or_primary(found: Column, t: Column) -> Column:
    return let(dedup_by_code(found), lambda unique: F.when(F.size(unique) > 0, unique).otherwise(let(primary_diagnosis(t), _primary_only)))


def _primary_only(main: Column) -> Column:
    version = F.when(F.rlike(main["icd_code"], F.lit("^[A-Z]")), "ICD-10").otherwise("ICD-9")
    only = F.struct(main["icd_code"].alias("diagnosis_code"), main["description"].alias("diagnosis_description"), F.lit("primary").alias("diagnosis_type"), version.alias("icd_version"))
    return F.when((main["icd_code"] != "") | (main["description"] != ""), F.array(only).cast(f"array<{DIAGNOSIS.simpleString()}>")).otherwise(F.array().cast(f"array<{DIAGNOSIS.simpleString()}>"))


def with_records(rows: DataFrame, patient_text: str, order_text: str) -> DataFrame:
    """Adds the records patient and order, each read from a text column.

    Values that others build on (the cleaned text, the name, the address) are settled
    first. Diagnoses are read from the order's text as it is.
    """
    rows = settle(rows, {"_p": text.clean_ascii(F.col(patient_text)), "_o": text.clean_ascii(F.col(order_text))})
    p, o = F.col("_p"), F.col("_o")
    rows = settle(rows, {"_who": patient_name(p), "_addr": address(p), "_soc": start_of_care(o), "_main": primary_diagnosis(o), "_found": found_diagnoses(F.col(order_text))})
    who, addr = F.col("_who"), F.col("_addr")
    rows = settle(rows, {"_place": city_state_zip(addr, p), "_sex": gender_with_name(p, who["first_name"]), "_period": certification_period(o, soc=F.col("_soc")), "_listed": unique_or_primary(F.col("_found"), F.col(order_text))})
    place, period = F.col("_place"), F.col("_period")
    of_patient = {"patient_fname": who["first_name"], "patient_lname": who["last_name"], "dob": dob(p), "patient_sex": F.col("_sex"), "ssn": ssn(p), "medical_record_no": mrn(p), "address": addr, "city": place["city"], "state": place["state"], "zip_code": place["zip_code"], "phone_number": phone_number(p), "provider_name": provider_name(p)}
    of_order = {"order_no": order_number(o), "order_date": order_date(o), "episode_start_date": period["start"], "episode_end_date": period["end"], "start_of_care": F.col("_soc"), "physician_name": physician_name(o), "ordering_facility": provider_name(o), "primary_diagnosis": F.col("_main.description"), "episode_diagnoses": F.col("_listed")}
    return settle(rows, {"patient": record(PATIENT, of_patient), "order": record(ORDER, of_order)}).drop("_p", "_o", "_who", "_addr", "_soc", "_main", "_found", "_place", "_sex", "_period", "_listed")


def all_fields(rows: DataFrame, text_column: str, into: str = "fields") -> DataFrame:
    """Every extracted field of a text column, in one struct column."""
    rows = settle(rows, {"_t": text.clean_ascii(F.col(text_column))})
    t = F.col("_t")
    rows = settle(rows, {"_who": patient_name(t), "_addr": address(t), "_soc": start_of_care(t), "_main": primary_diagnosis(t), "_agency": provider_name(t)})
    rows = settle(rows, {"_place": city_state_zip(F.col("_addr"), t), "_sex": gender_with_name(t, F.col("_who.first_name")), "_period": certification_period(t, soc=F.col("_soc"))})
    values = {"patient_fname": F.col("_who.first_name"), "patient_lname": F.col("_who.last_name"), "dob": dob(t), "patient_sex": F.col("_sex"), "medical_record_no": mrn(t), "medicare_number": medicare_number(t), "ssn": ssn(t), "order_no": order_number(t), "order_date": order_date(t), "start_of_care": F.col("_soc"), "episode_start_date": F.col("_period.start"), "episode_end_date": F.col("_period.end"), "physician_name": physician_name(t), "phone_number": phone_number(t), "address": F.col("_addr"), "provider_name": F.col("_agency"), "ordering_facility": F.col("_agency"), "city": F.col("_place.city"), "state": F.col("_place.state"), "zip_code": F.col("_place.zip_code"), "primary_diagnosis": F.col("_main.description"), "icd_code": F.col("_main.icd_code")}
    return settle(rows, {into: F.struct(*(v.alias(k) for k, v in values.items()))}).drop("_t", "_who", "_addr", "_soc", "_main", "_agency", "_place", "_sex", "_period")
