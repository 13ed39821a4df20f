"""Dates as MM/DD/YYYY strings. Years of two digits are expanded by each function's own rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import let
from .text import digits, strip

# Fixed values.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
STRICT = r"^\d{2}/\d{2}/\d{4}$"


def is_calendar_date(c: Column) -> Column:
    """MM/DD/YYYY, padded or not, that the calendar has."""
    return F.coalesce(F.rlike(c, F.lit(r"^\d{1,2}/\d{1,2}/\d{4}$")) & F.try_to_date(c, "M/d/yyyy").isNotNull(), F.lit(False))


def is_strict_date(c: Column) -> Column:
    """The form MM/DD/YYYY alone; the calendar is not asked."""
    return F.coalesce(F.rlike(strip(c), F.lit(r"^(0[1-9]|1[0-2])/(0[1-9]|[12]\d|3[01])/\d{4}$")), F.lit(False))


def pad2(c: Column) -> Column:
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def mdy(month: Column, day: Column, year: Column) -> Column:
    return F.concat(pad2(month), F.lit("/"), pad2(day), F.lit("/"), year)


def month_number(name: Column) -> Column:
    """01 to 12 from a month's first three letters; null for others."""
    key = F.lower(F.substring(name, 1, 3))
    out = F.lit(None).cast("string")
    for k, m in enumerate(MONTHS, 1):
        out = F.when(key == m[:3], f"{k:02d}").otherwise(out)
    return out


def century(yy: Column, last_of_2000s: int) -> Column:
    return F.concat(F.when(yy.cast("int") <= last_of_2000s, "20").otherwise("19"), yy)


def parts(c: Column, pattern: str, order: tuple[int, int, int], year=None, month=None) -> Column:
    """MM/DD/YYYY from a pattern's groups, null without a match."""
    g = lambda k: F.regexp_extract(c, pattern, k)
    m, d, y = (g(k) for k in order)
    return F.when(F.rlike(c, F.lit(pattern)), mdy(month(m) if month else m, d, year(y) if year else y))


def _tried(c: Column, formats: list[tuple[str, tuple[int, int, int], bool, bool]]) -> Column:
    """First format that matches the whole string and is a calendar date."""
    found = []
    for pattern, order, two, named in formats:
        p = parts(c, pattern, order, (lambda y: century(y, 68)) if two else None, month_number if named else None)
        found.append(let(p, lambda x: F.when(is_calendar_date(x), x)))
    return F.coalesce(*found)


_FULL = r"(?i)^(" + "|".join(m for m in MONTHS) + r")\s+(\d{1,2}),\s+(\d{4})$"
_SHORT = r"(?i)^(" + "|".join(m[:3] for m in MONTHS) + r")\s+(\d{1,2}),\s+(\d{4})$"
_MDY = [rf"^(\d{{1,2}}){s}(\d{{1,2}}){s}(\d{{4}})$" for s in ("/", "-", r"\.")]
_MDYY = [rf"^(\d{{1,2}}){s}(\d{{1,2}}){s}(\d{{2}})$" for s in ("/", "-", r"\.")]
_YMD = [rf"^(\d{{4}}){s}(\d{{1,2}}){s}(\d{{1,2}})$" for s in ("-", "/")]


def normalize_worklist_date(c: Column) -> Column:
    """Ten formats in order, then free forms (``infer_date``); null if none fits."""
    return let(strip(c), lambda x: F.coalesce(_worklist_date(x), infer_date(x)))


# Fixed values of free forms: words that say nothing, and a time of day at the end.
IDLE = ("st", "nd", "rd", "th", "of", "the", "on", "at", "and", "ad")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
TIME = r"(?:(?:^|\s+|,\s*)(?:at\s+)?|(?<=\d)t)\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:[ap]\.?m\.?)?\s*(?:z|utc|gmt|[+-]\d{2}:?\d{2})?$"


def infer_date(c: Column) -> Column:
    """MM/DD/YYYY from a free form, null if it has none.

    A time of day at the end is cut off; what is left is taken as words, numbers and signs.
    Weekdays and idle words go; anything else that is no month, number or one of ``, . / -``
    makes it no date. With a month's name: day and year in either order (a number of four
    digits, or above 31, is the year), or a year alone (its first day). Without: year first
    if that has four digits or is above 31, else month, day, year; a month above 12 changes
    place with the day; two numbers are month and year; eight digits are year, month, day.
    Years of two digits to 68 are 20xx. Days that the calendar lacks are no dates.
    """
    return let(F.regexp_replace(F.lower(strip(c)), TIME, ""), lambda x: let(F.regexp_extract_all(x, F.lit(r"[a-z]+|\d+|[^a-z\d\s,./\-]"), F.lit(0)), _inferred))


def _inferred(found: Column) -> Column:
    idle = lambda w: w.isin(*IDLE) | ((F.length(w) >= 3) & w.isin(*WEEKDAYS, *(d[:k] for d in WEEKDAYS for k in (3, 4, 5))))
    month = lambda w: w.isin(*MONTHS, *(m[:3] for m in MONTHS), "sept")
    number = lambda w: F.rlike(w, F.lit(r"^\d+$"))
    rest = F.filter(found, lambda w: ~idle(w))
    return let(F.struct(F.size(rest).alias("n"), F.filter(rest, month).alias("names"), F.filter(rest, number).alias("numbers")), _from_parts)


def _from_parts(x: Column) -> Column:
    at = lambda k: F.get(x["numbers"], F.lit(k))
    a, b, d = at(0), at(1), at(2)
    value = lambda n: F.when(F.length(n) <= 4, n.cast("int"))
    is_year = lambda n: (F.length(n) == 4) | (value(n) > 31)
    year = lambda n: F.when(F.length(n) == 4, n).when(F.length(n) <= 2, century(pad2(n), 68))
    name = month_number(F.get(x["names"], F.lit(0)))
    told = lambda m, day, y: let(mdy(m, day, year(y)), lambda v: F.when(is_calendar_date(v), v))
    swapped = lambda m, day, y: F.when(value(m) > 12, told(day, m, y)).otherwise(told(m, day, y))
    first = F.lit("01")
    digits8 = F.when(F.length(a).isin(8, 12, 14), F.substring(a, 1, 8))
    named = F.when(F.size(x["numbers"]) == 2, F.when(is_year(a), told(name, b, a)).otherwise(told(name, a, b))).when((F.size(x["numbers"]) == 1) & (F.length(a) == 4), told(name, first, a))
    bare = (
        F.when(F.size(x["numbers"]) == 3, F.when(is_year(a), swapped(b, d, a)).otherwise(swapped(a, b, d)))
        .when((F.size(x["numbers"]) == 2) & (F.length(b) == 4) & (F.length(a) <= 2), told(a, first, b))
        .when((F.size(x["numbers"]) == 2) & (F.length(a) == 4) & (F.length(b) <= 2), told(b, first, a))
        .when((F.size(x["numbers"]) == 1) & digits8.isNotNull(), told(F.substring(digits8, 5, 2), F.substring(digits8, 7, 2), F.substring(digits8, 1, 4)))
    )
    whole = F.size(x["names"]) + F.size(x["numbers"]) == x["n"]
    return F.when(whole & (F.size(x["names"]) == 1), named).when(whole & (F.size(x["names"]) == 0), bare)


def _worklist_date(c: Column) -> Column:
    return _tried(c, [*((p, (1, 2, 3), False, False) for p in _MDY), *((p, (1, 2, 3), True, False) for p in _MDYY), *((p, (2, 3, 1), False, False) for p in _YMD), (_FULL, (1, 2, 3), False, True), (_SHORT, (1, 2, 3), False, True)])


def normalize_backfill_date(c: Column) -> Column:
    """Six formats in order; empty if none fits."""
    return let(strip(c), _backfill_date)


def _backfill_date(c: Column) -> Column:
    day_first = r"(?i)^(\d{1,2})-(" + "|".join(m[:3] for m in MONTHS) + r")-(\d{4})$"
    found = _tried(c, [(_MDY[0], (1, 2, 3), False, False), (_MDY[1], (1, 2, 3), False, False), (_YMD[0], (2, 3, 1), False, False), (_MDYY[0], (1, 2, 3), True, False), (_MDYY[1], (1, 2, 3), True, False), (day_first, (2, 1, 3), False, True)])
    return F.coalesce(found, F.lit(""))


def normalize_extracted_date(c: Column) -> Column:
    """Time cut off; month names and numeric dates padded, the calendar not asked (years below 50 are 20xx); else as it is."""
    return let(F.regexp_replace(c, r"(?s)\s+\d{1,2}:\d{2}.*", ""), _extracted_date)


def _extracted_date(c: Column) -> Column:
    named = parts(c, r"(?i)^(" + "|".join(MONTHS) + r")\s+(\d{1,2}),\s+(\d{4})$", (1, 2, 3), month=month_number)
    full = parts(c, r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})", (1, 2, 3))
    short = parts(c, r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2})$", (1, 2, 3), lambda y: century(y, 49))
    return F.coalesce(let(named, lambda x: F.when(is_calendar_date(x), x)), full, short, c, F.lit(""))


def standardize_date(c: Column) -> Column:
    """Seven patterns anywhere in the string, each checked with the calendar (years to 30 are 20xx), then three bare numbers; else empty."""
    t = strip(c)
    t = F.regexp_replace(t, r"(?i)^(DOB|Date of Birth|Born|Birthday):\s*", "")
    return let(F.regexp_replace(t, r"(?i)\s*(years? old|age \d+).*$", ""), _standard_date)


def _standard_date(t: Column) -> Column:
    full, short = "|".join(MONTHS), "|".join(m[:3] for m in MONTHS)
    year = lambda y: century(y, 30)
    tries = [
        parts(t, r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})", (1, 2, 3)),
        parts(t, r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2})$", (1, 2, 3), year),
        parts(t, r"(\d{4})[/\-.](\d{1,2})[/\-.](\d{1,2})", (2, 3, 1)),
        parts(t, rf"(?i)({full})\s+(\d{{1,2}}),?\s+(\d{{4}})", (1, 2, 3), month=month_number),
        parts(t, rf"(?i)({short})\w*\s+(\d{{1,2}}),?\s+(\d{{4}})", (1, 2, 3), month=month_number),
        parts(t, rf"(?i)(\d{{1,2}})\s+({full})\s+(\d{{4}})", (2, 1, 3), month=month_number),
        parts(t, rf"(?i)(\d{{1,2}})\s+({short})\w*\s+(\d{{4}})", (2, 1, 3), month=month_number),
    ]
    guess = let(F.regexp_extract_all(t, F.lit(r"\d+"), F.lit(0)), lambda n: F.when((F.size(n) == 3) & (F.length(F.get(n, 0)) <= 2) & (F.length(F.get(n, 1)) <= 2), F.when(F.length(F.get(n, 2)) == 4, mdy(F.get(n, 0), F.get(n, 1), F.get(n, 2))).when(F.length(F.get(n, 2)) == 2, mdy(F.get(n, 0), F.get(n, 1), year(F.get(n, 2))))))
    return F.coalesce(*(let(p, lambda x: F.when(is_calendar_date(x), x)) for p in (*tries, guess)), F.lit(""))


def normalize_match_date(c: Column) -> Column:
    """For comparison only: eight digits are MMDDYYYY, six MMDDYY (years to 50 are 20xx), else a numeric date anywhere."""
    return let(c, lambda x: let(digits(x), lambda d: _match_date(x, d)))


def _match_date(c: Column, d: Column) -> Column:
    year = lambda y: F.when(F.length(y) == 2, century(y, 50)).otherwise(y)
    cut_up = lambda n: F.concat(F.substring(d, 1, 2), F.lit("/"), F.substring(d, 3, 2), F.lit("/"), year(F.substring(d, 5, n)))
    loose = parts(c, r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2,4})", (1, 2, 3), year)
    return F.coalesce(F.when(F.length(d) == 8, cut_up(4)).when(F.length(d) == 6, cut_up(2)).otherwise(loose), F.lit(""))


def add_days(c: Column, days: int) -> Column:
    """MM/DD/YYYY some days later; null where the date is not of the calendar."""
    return F.when(is_calendar_date(c), F.date_format(F.date_add(F.try_to_date(c, "M/d/yyyy"), days), "MM/dd/yyyy"))


def all_dates(c: Column, kinds: tuple[str, ...] = ("numeric",)) -> Column:
    """Sorted distinct calendar dates in a text: numeric, named (May 8, 2025) and iso."""
    found = [F.transform(F.regexp_extract_all(c, F.lit(r"(\d{1,2}[/-]\d{1,2}[/-]\d{4})"), F.lit(1)), lambda x: F.try_to_date(F.replace(x, F.lit("-"), F.lit("/")), "M/d/yyyy"))]
    if "named" in kinds:
        pattern = r"(?i)\b((?:" + "|".join(MONTHS) + r")\s+\d{1,2},?\s+\d{4})"
        found.append(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda x: F.try_to_date(F.initcap(F.regexp_replace(x, r",?\s+", " ")), "MMMM d yyyy")))
    if "iso" in kinds:
        found.append(F.transform(F.regexp_extract_all(c, F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1)), lambda x: F.try_to_date(x, "yyyy-MM-dd")))
    return F.array_sort(F.array_distinct(F.filter(F.concat(*found), lambda x: x.isNotNull())))


def best_episode_pair(dates: Column) -> Column:
    """Struct (start, end) of the pair 40 to 120 days apart that is nearest 60 days, the earliest on ties."""
    return let(dates, _best_pair)


def _best_pair(dates: Column) -> Column:
    pairs = F.flatten(F.transform(dates, lambda a: F.transform(F.filter(dates, lambda b: F.datediff(b, a).between(40, 120)), lambda b: F.struct(F.abs(F.datediff(b, a) - 60).alias("off"), a.alias("start"), b.alias("end")))))
    return let(F.array_min(pairs), lambda best: F.when(best.isNotNull(), F.struct(F.date_format(best["start"], "MM/dd/yyyy").alias("start"), F.date_format(best["end"], "MM/dd/yyyy").alias("end"))))


def age(dob: Column, as_of: Column) -> Column:
    """Whole years at ``as_of``, never below 0; 0 where the date cannot be read."""
    d = F.coalesce(*(F.when(is_calendar_date(p), F.try_to_date(p, "M/d/yyyy")) for p in (parts(dob, x, (1, 2, 3), (lambda y: century(y, 68)) if two else None) for x, two in ((_MDY[0], False), (_MDY[1], False), (_MDYY[0], True), (_MDYY[1], True)))))
    return F.coalesce(F.greatest(F.floor(F.months_between(as_of, d) / 12).cast("int"), F.lit(0)), F.lit(0))
