"""Standard forms of names, sexes, numbers, states and codes. Empty stays empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import blank, let, or_empty
from .text import capitalize, digits, squeeze, strip, title

# Fixed values.
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE", "florida": "FL", "georgia": "GA",
    "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ",
    "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC",
    "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}
MALE = ("M", "MALE", "MAN", "MASCULINE", "BOY", "HOMBRE")
FEMALE = ("F", "FEMALE", "WOMAN", "FEMININE", "GIRL", "MUJER")
COMMON_MALE = "JOHN ROBERT MICHAEL WILLIAM DAVID JAMES RICHARD CHARLES JOSEPH THOMAS DANIEL".split()
COMMON_FEMALE = "MARY PATRICIA LINDA BARBARA ELIZABETH JENNIFER MARIA SUSAN MARGARET DOROTHY LISA KAREN".split()
EXTRACTED_FEMALE = "MARIA MARIE MARY OLIVIA LUCIA ANA JOANN KATHLEEN MELISSA KAYLEIGH KAYLEE AMANDA CONNIE VIRGINIA RITA NOEMIA CANDIDA ILDA GUILHERMINA LOUISE DALE".split()
EXTRACTED_MALE = "DARWIN EDWARD JOAO EDUARDO WILLIAM LAWRENCE ALFRED JOHN".split()
GENERATIONS = ("II", "III", "IV", "JR", "SR")
NICKNAMES = (("WILLIAM", "BILL"), ("ROBERT", "BOB"), ("MICHAEL", "MIKE"), ("JAMES", "JIM"))
ICD = r"[A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?"


def gender(c: Column) -> Column:
    g = F.translate(F.upper(strip(c)), ".,", "")
    return F.when(F.contains(g, F.lit("/")) | F.contains(g, F.lit(" OR ")), "").when(g.isin(*MALE), "MALE").when(g.isin(*FEMALE), "FEMALE").otherwise("")


def gender_from_name(c: Column, male=COMMON_MALE, female=COMMON_FEMALE) -> Column:
    n = F.upper(strip(c))
    return F.when(n.isin(*female), "FEMALE").when(n.isin(*male), "MALE").otherwise("")


def phone(c: Column) -> Column:
    return let(c, lambda x: let(digits(x), lambda d: _phone(x, d)))


def _phone(c: Column, d: Column) -> Column:
    d = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    form = F.concat(F.lit("("), F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 4))
    return or_empty(F.when(F.length(d) == 10, form).otherwise(strip(c)))


def ssn(c: Column) -> Column:
    d = digits(c)
    return or_empty(F.when(F.length(d) == 9, _ssn(d)).otherwise(strip(c)))


def _ssn(d: Column) -> Column:
    return F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 2), F.substring(d, 6, 4))


def state(c: Column) -> Column:
    s = F.lower(strip(c))
    known = F.try_element_at(F.create_map(*(F.lit(x) for pair in STATES.items() for x in pair)), s)
    return or_empty(F.when(F.rlike(s, F.lit(r"^\p{L}{2}$")), F.upper(s)).otherwise(F.coalesce(known, F.substring(F.upper(s), 1, 2))))


def zip_code(c: Column) -> Column:
    z = F.regexp_replace(c, r"[^\d\-]", "")
    return or_empty(F.when(F.rlike(z, F.lit(r"^\d{5}$|^\d{5}-\d{4}$")), z).when(F.rlike(z, F.lit(r"^\d{9}$")), F.concat(F.substring(z, 1, 5), F.lit("-"), F.substring(z, 6, 4))).otherwise(strip(c)))


def name(c: Column) -> Column:
    """Words capitalised; generations in upper case; Mc and O' keep their second capital."""

    def one(w: Column) -> Column:
        rest = capitalize(F.substring(w, 3, 1 << 20))
        low = F.lower(w)
        return F.when(F.upper(w).isin(*GENERATIONS), F.upper(w)).when(low.startswith("mc") & (F.length(w) > 2), F.concat(F.lit("Mc"), rest)).when(low.startswith("o'") & (F.length(w) > 2), F.concat(F.lit("O'"), rest)).otherwise(capitalize(w))

    t = squeeze(F.regexp_replace(c, r"(?U)[^\w\s\-']", " "))
    return or_empty(F.array_join(F.transform(F.split(t, " "), one), " "))


def mrn(c: Column) -> Column:
    """Two letters and 9 to 13 digits, or 8 to 12 digits; anything else is dropped."""
    m = F.replace(F.upper(strip(c)), F.lit(" "), F.lit(""))
    return F.when(F.rlike(m, F.lit(r"^[A-Z]{2}\d{9,13}$|^\d{8,12}$")), m).otherwise("")


def last_first(c: Column) -> Column:
    """'Last, First' in title case from either order of names."""
    n = squeeze(c)
    last, first = F.split_part(n, F.lit(","), F.lit(1)), F.regexp_extract(n, r"^[^,]*,(.*)$", 1)
    with_comma = F.regexp_replace(F.concat(title(strip(last)), F.lit(", "), title(strip(first))), r"[, ]+$", "")
    words = F.split(n, " ")
    turned = F.concat(title(F.try_element_at(words, F.lit(-1))), F.lit(", "), title(F.array_join(F.slice(words, 1, F.size(words) - 1), " ")))
    return or_empty(F.when(F.contains(n, F.lit(",")), with_comma).when(F.size(words) > 1, turned).otherwise(title(n)))


def split_worklist_name(c: Column) -> Column:
    """Struct fname, lname from 'Last, First Middle' or 'First Last', in title case."""
    n = strip(c)
    words = F.split(squeeze(c), " ")
    rest = strip(F.regexp_extract(n, r"(?s)^[^,]*,(.*)$", 1))
    comma = F.contains(n, F.lit(","))
    fname = F.when(comma, F.get(F.split(squeeze(rest), " "), F.lit(0))).otherwise(F.get(words, F.lit(0)))
    lname = F.when(comma, strip(F.split_part(n, F.lit(","), F.lit(1)))).otherwise(F.when(F.size(words) > 1, F.try_element_at(words, F.lit(-1))).otherwise(""))
    return F.struct(or_empty(title(fname)).alias("fname"), or_empty(title(lname)).alias("lname"))


def split_full_name(c: Column) -> Column:
    """Struct first_name, last_name from 'Last, First M' or 'First ... Last'; case is kept."""
    return let(strip(c), _full_name)


def _full_name(n: Column) -> Column:
    words = F.split(squeeze(n), " ")
    comma = F.contains(n, F.lit(","))
    rest = squeeze(F.regexp_extract(n, r"(?s)^[^,]*,(.*)$", 1))
    first = F.when(comma, F.get(F.split(rest, " "), F.lit(0))).otherwise(F.get(words, F.lit(0)))
    last = F.when(comma, strip(F.split_part(n, F.lit(","), F.lit(1)))).when(F.size(words) > 1, F.try_element_at(words, F.lit(-1))).otherwise("")
    return F.struct(or_empty(first).alias("first_name"), or_empty(last).alias("last_name"))


def match_name(c: Column) -> Column:
    """For comparison: upper case, titles and marks dropped, four names to their short forms."""
    n = squeeze(F.upper(c))
    n = F.regexp_replace(n, r"\b(MR|MRS|MS|DR|JR|SR|II|III|IV)\b\.?", "")
    n = F.regexp_replace(n, r"(?U)[^\w\s\-']", "")
    for long, short in NICKNAMES:
        n = F.regexp_replace(n, rf"\b{long}\b", short)
    return or_empty(strip(n))


def match_identifier(c: Column) -> Column:
    return or_empty(F.upper(F.regexp_replace(c, r"[^A-Za-z0-9]", "")))


def match_ssn(c: Column) -> Column:
    d = digits(c)
    return or_empty(F.when((F.length(d) == 9) & ~d.startswith("000"), _ssn(d)))


def base_doc_id(c: Column) -> Column:
    """The id without what an extractor appended."""
    return F.regexp_replace(c, r"(?is)_(?:digital|ocr).*$", "")


def order_number(order_no: Column, worklist_id: Column, doc_id: Column) -> Column:
    """Digits of the worklist id, if any; else the number itself; else digits of the document id."""
    base = base_doc_id(doc_id)
    own = F.regexp_replace(base, r"[^0-9]", "")
    return F.when(~blank(worklist_id), F.regexp_replace(worklist_id, r"[^0-9]", "")).when(~blank(order_no), order_no).otherwise(or_empty(F.when(own != "", own).otherwise(base)))


def icd_code(c: Column) -> Column:
    return or_empty(F.regexp_extract(c, f"({ICD})", 1))


def protect_zeros(c: Column) -> Column:
    """An apostrophe before all-digit values that begin with 0."""
    return or_empty(F.when(F.rlike(c, F.lit(r"^0\d*$")), F.concat(F.lit("'"), c)).otherwise(c))


def diagnosis_description(c: Column) -> Column:
    d = squeeze(c)
    d = F.regexp_replace(d, r"(?i)^(diagnosis|dx|condition|problem)\s*:?\s*", "")
    d = F.regexp_replace(d, r"(?i)\s*(icd|code)\s*:?\s*[A-Z0-9\.]*$", "")
    return or_empty(strip(F.regexp_replace(d, r"[,;:]+$", "")))


def full_name(first: Column, middle: Column, last: Column) -> Column:
    return F.concat_ws(" ", *(F.when(~blank(x), x) for x in (first, middle, last)))


def date_range(start: Column, end: Column) -> Column:
    s, e = ~blank(start), ~blank(end)
    return F.when(s & e, F.concat(start, F.lit(" to "), end)).when(s, F.concat(F.lit("From "), start)).when(e, F.concat(F.lit("Until "), end)).otherwise("")


def diagnoses_text(primary: Column, secondary: Column, others: Column) -> Column:
    line = lambda d: F.concat(F.when(d["diagnosis_type"] != "", F.concat(title(d["diagnosis_type"]), F.lit(": "))).otherwise(""), d["diagnosis_description"], F.when(d["diagnosis_code"] != "", F.concat(F.lit(" ("), d["diagnosis_code"], F.lit(")"))).otherwise(""))
    head = F.array(F.when(primary != "", F.concat(F.lit("Primary: "), primary)), F.when(secondary != "", F.concat(F.lit("Secondary: "), secondary)))
    rest = F.transform(F.filter(others, lambda d: d["diagnosis_description"] != ""), line)
    return F.array_join(F.concat(F.array_compact(head), rest), "; ")
