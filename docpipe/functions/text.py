"""Text functions: cleaning, quality, sections, and letter case as Python defines it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import let

# Corrections in order, boilerplate lines, section labels, and indicators.
CORRECTIONS = (("Ptient", "Patient"), ("Pt ", "Patient "), ("DOB.", "DOB:"), ("Da te", "Date"), ("Mrn", "MRN"))
BOILERPLATE = (r"^\s*Page\s+\d+\s*(of\s*\d+)?", r"^\s*Fax(ed)?\b.*$", r"^\s*CONFIDENTIAL\b.*$")
SECTIONS = {"HEADER": r"^(PATIENT INFORMATION|PATIENT DETAILS|PATIENT:)\b", "ORDERS": r"^(ORDERS?|ORDER INFORMATION)\b", "DIAGNOSES": r"^(DIAGNOSIS|DIAGNOSES|DX:)\b"}
INDICATORS = ("patient", "name", "dob", "date of birth", "address", "diagnosis", "medical", "record")
PUNCTUATION = ".,;:()[]{}/-_@#$%^&*+=<>?!\"'"
#: What Python's splitlines breaks at.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"

#: The same without line feeds, and lines of boilerplate in a text whose every break is a line feed.
OTHER_BREAK = r"\r\n|[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
BOILERPLATE_LINE = r"(?i)\n[^\S\n]*(?:Page[^\S\n]+\d+|Fax(?:ed)?\b|CONFIDENTIAL\b)[^\n]*"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """All white space, line breaks included, to single blanks."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def splitlines(c: Column) -> Column:
    """Lines; a break at the very end opens no further line."""
    return F.split(F.regexp_replace(c, rf"(?s)({LINE_BREAK})\z", ""), LINE_BREAK, -1)


def capitalize(c: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def title(c: Column) -> Column:
    """Every run of letters capitalised, wherever it begins."""
    parts = F.regexp_extract_all(c, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.coalesce(F.array_join(F.transform(parts, capitalize), ""), c)


def dehyphenate(c: Column) -> Column:
    return F.regexp_replace(c, r"-\n\s*", "")


def drop_boilerplate(lines: Column) -> Column:
    return F.filter(lines, lambda x: ~F.rlike(x, F.lit("(?i)" + "|".join(f"(?:{p})" for p in BOILERPLATE))))


def correct(c: Column) -> Column:
    for wrong, right in CORRECTIONS:
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c


def tag_sections(lines: Column) -> Column:
    """A tag line before each line that opens a section."""

    def one(line: Column) -> Column:
        out = F.array(line)
        for name, pattern in reversed(SECTIONS.items()):
            out = F.when(F.rlike(line, F.lit(f"(?i){pattern}")), F.array(F.lit(f"<{name}>"), line)).otherwise(out)
        return out

    return F.flatten(F.transform(lines, one))


def preprocess(c: Column) -> Column:
    """De-hyphenated, boilerplate dropped, corrected, sections tagged, blanks squeezed.

    What ``splitlines``, ``drop_boilerplate``, ``correct`` and ``tag_sections`` give joined, in passes
    over the whole text: a line feed before each line stands for its beginning.
    """
    t = F.regexp_replace(F.regexp_replace(dehyphenate(c), OTHER_BREAK, "\n"), r"\n\z", "")
    t = correct(F.regexp_replace(F.concat(F.lit("\n"), t), BOILERPLATE_LINE, ""))
    for name, pattern in SECTIONS.items():
        t = F.regexp_replace(t, r"(?i)(?<=\n)" + pattern.removeprefix("^"), f"<{name}>\n$0")
    return F.coalesce(F.regexp_replace(F.regexp_replace(F.substring(t, 2, 1 << 30), r"\n{3,}", "\n\n"), r" {2,}", " "), F.lit(""))


def sections(clean: Column) -> Column:
    """Struct HEADER, ORDERS, DIAGNOSES of preprocessed text; of a repeated section the last counts."""
    tags = "|".join(f"<{n}>" for n in SECTIONS)

    def last(name: str) -> Column:
        found = F.regexp_extract_all(clean, F.lit(rf"(?ms)^\s*<{name}>\s*$\n?(.*?)(?=^\s*(?:{tags})\s*$|\z)"), F.lit(1))
        return strip(F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))).alias(name)

    return F.struct(*(last(n) for n in SECTIONS))


def route(section: Column, text: Column) -> Column:
    """The section, or the whole text where it is empty."""
    return F.when(section != "", section).otherwise(text)


def clean_ascii(c: Column) -> Column:
    """Printable ASCII and line breaks only, blanks and line breaks squeezed."""
    c = F.regexp_replace(c, r"[^\x09\x0A\x0D\x20-\x7E]", " ")
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\r?\n+", "\n"))


def clean_lines(c: Column) -> Column:
    """Form feeds become line breaks; blanks squeezed; lines of two characters or fewer dropped."""
    c = F.regexp_replace(F.regexp_replace(c, r"\x0c", "\n"), r"[ \t]+", " ")
    c = strip(F.regexp_replace(c, r"\n\s*\n\s*\n+", "\n\n"))
    return F.coalesce(F.array_join(F.filter(F.transform(F.split(c, "\n", -1), strip), lambda x: F.length(x) > 2), "\n"), F.lit(""))


def length_quality(c: Column) -> Column:
    return F.least(F.coalesce(F.length(c), F.lit(0)) / F.lit(5000.0), F.lit(1.0))


def quality(c: Column) -> Column:
    """0 to 1 from the shares of letters, digits, blanks and punctuation, and the length."""
    return let(strip(F.coalesce(c, F.lit(""))), _quality)


def _quality(t: Column) -> Column:
    n = F.length(t)
    share = lambda keep: F.length(F.regexp_replace(t, rf"(?U)[^{keep}]", "")) / n
    letters, figures, blanks = share(r"\p{L}"), share(r"\p{Nd}"), share(r"\s")
    marks = share("".join(f"\\{ch}" for ch in PUNCTUATION))
    add = lambda cond, value: F.when(cond, value).otherwise(0.0)
    score = F.when(letters.between(0.4, 0.8), 0.4).when(letters > 0.2, 0.2).otherwise(0.0)
    score = score + add(figures.between(0.05, 0.3), 0.2) + add(blanks.between(0.1, 0.25), 0.2) + add(marks.between(0.02, 0.15), 0.1)
    score = score + F.when(n > 500, 0.1).when(n > 200, 0.05).otherwise(0.0)
    return F.when(n == 0, 0.0).when(n < 10, 0.1).otherwise(F.least(score, F.lit(1.0)))


def distinct_line_share(c: Column) -> Column:
    lines = F.filter(F.transform(F.split(c, "\n", -1), strip), lambda x: x != "")
    return let(lines, lambda x: F.when(F.size(x) > 0, F.size(F.array_distinct(x)) / F.size(x)))


def looks_scanned(c: Column) -> Column:
    """No usable text: too short, lines repeat, or short and without any expected word."""
    n = F.coalesce(F.length(c), F.lit(0))
    known = F.rlike(F.lower(c), F.lit("|".join(INDICATORS)))
    return F.coalesce((n < 100) | (distinct_line_share(c) < 0.3) | (~known & (n < 500)), F.lit(True))


def scrub_address(c: Column) -> Column:
    for pattern in (r"\d{10,}\s+isApprovalWrapper.*", r"isApprovalWrapper.*", r"sessionCacheKey.*", r"Fax\s+Number\s+\d+", r"\d{2}:\d{2}\s+[AP]M\s+Eastern\s+Time\s+Zone"):
        c = F.regexp_replace(c, pattern, "")
    return strip(c)
