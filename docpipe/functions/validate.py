"""Predicates on extracted values. Null never passes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# What a patient's name, a provider's name and a form label may not look like.
NOT_A_NAME = r"first\s+name|last\s+name|patient\s+name|unspecified|unsp|hyperlipidemia|neuropathy|hypertension|diabetes|pneumonia|copd|chr\s+kidney|heart\s+failure|coronary\s+artery|malignant|neoplasm|chronic|acute|primary|secondary|essential|episode|diagnosis|client|template|MM/DD/YYYY|M\s+or\s+F|MALE\s+or\s+FEMALE|RN\s*$|MD\s*$|DO\s*$|^\s*[A-Z]{1,3}\s*$|disease|disorder|syndrome|failure|block|anemia|thyroid|kidney|bone|prostate|aspirin|nicotine|dependence|history|use|metabolic|congestive|obstructive|respiratory|hyperkalemia|hypercalcemia|diastolic|systolic|parkinson|dementia|malignancy|cancer"
MEDICAL_ENDINGS = r"(?:emia|itis|osis|pathy|trophy|uria|algia)$"
MEDICAL_TERMS = "unspecified chronic acute primary secondary hyperlipidemia hypertension diabetes essential malignant benign stage grade type mild moderate severe with without complicated uncomplicated controlled uncontrolled".split()
FORM_PHRASES = ("M OR F", "F OR M", "MALE OR FEMALE", "FEMALE OR MALE", "CHECK ONE", "CIRCLE ONE", "SELECT", "CHOOSE")
MRN_LABELS = ("MRN", "MEDICAL", "RECORD", "NUMBER")


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def patient_name(c: Column) -> Column:
    terms = F.transform(F.split(F.lower(c), ","), strip)
    return _yes(
        (F.length(strip(c)) >= 2)
        & ~F.rlike(F.lower(c), F.lit(f"(?i){NOT_A_NAME}"))
        & F.rlike(c, F.lit("[AEIOUaeiou]"))
        & ~F.rlike(c, F.lit(r"[A-Z]\d{2}\.?\d*"))
        & ~F.rlike(F.lower(c), F.lit(MEDICAL_ENDINGS))
        & ~(F.contains(c, F.lit(",")) & F.arrays_overlap(terms, F.array(*map(F.lit, MEDICAL_TERMS))))
    )


def gender(c: Column) -> Column:
    return _yes(F.upper(c).isin("M", "F", "MALE", "FEMALE"))


def is_form_label(context: Column) -> Column:
    return _yes(F.rlike(F.upper(context), F.lit("|".join(FORM_PHRASES))))


def mrn(c: Column) -> Column:
    m = F.upper(strip(c))
    digits_only = F.rlike(m, F.lit(r"^\d{6,15}$")) & ~F.rlike(m, F.lit(r"^(\d)\1+$"))
    return _yes((F.length(m) >= 6) & F.rlike(m, F.lit(r"\d")) & F.when(F.rlike(m, F.lit("[A-Z]")), ~m.isin(*MRN_LABELS)).otherwise(digits_only))


def address(c: Column) -> Column:
    """Long enough, no date template and no bare code."""
    return _yes((F.length(strip(c)) >= 5) & ~F.rlike(F.upper(c), F.lit(r"MM/DD/YYYY|^\s*[A-Z]{1,3}\s*$")))


def provider(c: Column) -> Column:
    """No bare code, AM or PM, marks or figures; at least half of it letters."""
    upper = F.upper(c)
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    return _yes((F.length(strip(c)) >= 3) & ~F.rlike(upper, F.lit(r"^\s*[A-Z]\.\s*$|^\s*[A-Z]{1,3}\s*$|^\s*[AP]M\s*$|^\s*[,.\-\s]+$|^\s*\d+\s*$")) & (letters > 0) & (letters / F.length(c) >= 0.5))


def reasonable_date(c: Column, latest: int = 2024) -> Column:
    """A year from 1900 to ``latest``; without a year of four digits, any number of two."""
    year = F.regexp_substr(c, F.lit(r"\b(?:19|20)\d{2}\b"))
    return _yes(F.when(year.isNotNull(), year.cast("int").between(1900, latest)).otherwise(F.rlike(c, F.lit(r"\b\d{2}\b"))))


def repeated_character(c: Column) -> Column:
    return _yes(F.rlike(c, F.lit(r"(?s)^(.)\1+$")))
