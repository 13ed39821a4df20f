"""Patterns that are left out where a text lacks their words; preprocessing in passes over the whole text."""

import random

from pyspark.sql import functions as F

from docpipe.functions import patterns
from docpipe.functions import text as T
from docpipe.operators import enhanced, extract
from docpipe.operators.cascade import DOT, LINES, first_match, may_match, needed

CASCADES = {n: v for n, v in vars(patterns).items() if n.isupper() and isinstance(v, tuple)}
PIECES = """Patient: Carter, Oscar A|CLIENT: ABEL, ALAN MD|Name Number Roe, Jane Male|patient name: Roe, Jane|(HH000000003558)|Roe, Jane (123456789)|DOB: 1/2/1950|Date of Birth: May 8, 1950|born 1-2-50|Patient's Gender: MALE|Sex: F|M or F|circle one|MR#: HH00000003558
Medical Record No. ABC12345678901|SSN: 123-45-6789|123 45 6789 social|Order Number #1234567890|Order No. 7654321|Visit Date: 1/2/2020|Order Date: 1/2/2020 10:30 AM|SOC Date: 3/4/2020|start of care 3/4/20|Certification Period: 1/1/2020 to 3/1/2020|Episode: 1/1/2020 - 3/1/2020|May 8, 2020 – July 7, 2020
Jane Q Roe, MD|Dr. Roe|attending: Roe|Phone: (401) 555-0101|tel 401 555 0101|12 Oak Street, Fall River 02720|12 Oak St, Troy, MA 02720|I10 Hypertension (E)|E11.9 Diabetes Start Effective Date 1/1|Medical Diagnosis: I10|trouble of the heart (I10)|long trouble of it I10|dx: I10 trouble|1 I10 Trouble
Agency Name: Alpha Care|Alpha Home Health of Troy|AMEDISYS HOME HEALTH|NPI: 1234567890|1234567890 provider|Birth Date: 1.2.1950|1/2/1950 Age 70|Age 70 born 1/2/1950|Demographics 1/2/1950|Insurance: Blue Mutual|Primary Diagnosis: trouble|ICD-10: I10 trouble|Condition: bad|From 1/2/2020 to 3/2/2020|Discharge Date: 5/5/2020|ſocial ıd Straße|PATIENT DETAILS|ORDERS|DX:yes|Page 1 of 2|Faxed on|Faxes|CONFIDENTIAL|Ptient Pt Mrn DOB. Da te|a-\n  b|x  y|\r\n|\x0b| |\x85|\n\n\n|  Page 7""".replace("\n", "|", 3).split("|")  # fmt: skip


def texts(n: int) -> list[str]:
    draw = random.Random(7)
    return ["", *PIECES, *(draw.choice([" ", "\n"]).join(draw.choice([str.lower, str.upper, str, str])(draw.choice(PIECES)) for _ in range(draw.randint(1, 9))) for _ in range(n))]


def test_texts_that_match_have_the_words_a_pattern_needs(spark):
    rows = spark.createDataFrame([(x,) for x in texts(300)], "t string").cache()
    matched = []
    for flags, names in ((LINES, [n for n in CASCADES if not n.startswith("ENHANCED")]), (DOT, [n for n in CASCADES if n.startswith("ENHANCED")])):
        every = [(n, p) for n in names for p in CASCADES[n]]
        hits = [F.rlike("t", F.lit(flags + p)) for _, p in every]
        wrong = [F.sum((h & ~(F.lit(True) if (m := may_match(F.upper("t"), p)) is None else m)).cast("int")).alias(f"w{k}") for k, (h, (_, p)) in enumerate(zip(hits, every))]
        one = rows.agg(*wrong, *(F.sum(h.cast("int")).alias(f"h{k}") for k, h in enumerate(hits))).first()
        assert not any(one[f"w{k}"] for k in range(len(every)))
        matched += [one[f"h{k}"] > 0 for k in range(len(every))]
    assert sum(matched) > 0.5 * len(matched)
    assert needed(r"(?:phone|tel|telephone):?\s*x") == (("PHONE", "TEL"),) and needed(r"a?(b)\d") == ()


def test_cascades_agree_with_plain_patterns(spark):
    rows = spark.createDataFrame(list(enumerate([*texts(150), None])), "k int, t string").cache()
    for name, flags in (("PATIENT_NAME", LINES), ("ADDRESS", LINES), ("ORDER_NUMBER", LINES), ("ENHANCED_DOB", DOT)):
        tries = [T.strip(F.regexp_extract("t", flags + p, 1)) for p in CASCADES[name]]
        plain = F.coalesce(*(F.when(x != "", x) for x in tries), F.lit(""))
        got = rows.select(first_match(F.col("t"), CASCADES[name], flags).alias("a"), plain.alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got] and any(r.a for r in got)


def test_periods_and_diagnoses(spark):
    said = spark.createDataFrame([("From 1/2/2020 until 3/2/2020",), ("SOC 5/6/2020, 1/2/2020 – 3/2/2020",), ("1/2/2020 to 3/2/1820",), (None,)], "t string")
    t = F.col("t")
    got = said.select(enhanced.episode_dates(t).alias("e"), extract.found_diagnoses(t).alias("d"), enhanced.diagnoses(t).alias("x")).collect()
    assert [tuple(r.e) for r in got] == [("1/2/2020", "3/2/2020"), ("5/6/2020", "3/2/2020"), ("", ""), ("", "")]
    assert [r.d for r in got] == [[], [], [], None] and [r.x for r in got] == [[], [], [], None]


def test_preprocessing_is_that_of_each_line(spark):
    rows = spark.createDataFrame([(x,) for x in texts(400)], "t string")
    lines = F.transform(T.drop_boilerplate(T.splitlines(T.dehyphenate(F.col("t")))), T.correct)
    joined = F.array_join(T.tag_sections(lines), "\n")
    plain = F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r" {2,}", " ")
    got = rows.select("t", T.preprocess(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert [(r.t, r.a) for r in got if r.a != r.b] == []
