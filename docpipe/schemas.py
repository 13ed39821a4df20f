"""Schemas, field lists and settings. An empty string means "missing" in records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and order of record fields.
PATIENT_FIELDS = "patient_fname patient_lname patient_mname dob patient_sex ssn medical_record_no account_number address city state zip_code phone_number email emergency_contact_name emergency_contact_phone emergency_contact_relationship primary_insurance secondary_insurance policy_number group_number subscriber_id provider_name provider_npi referring_physician marital_status preferred_language".split()
ORDER_FIELDS = "order_no order_date episode_start_date episode_end_date start_of_care signed_by_physician_date physician_name physician_npi physician_phone ordering_facility service_type frequency duration primary_diagnosis secondary_diagnosis clinical_notes authorization_number equipment_needed special_instructions discharge_notes goals_of_care functional_limitations safety_measures caregiver_instructions medication_reconciliation follow_up_instructions billing_code place_of_service insurance_payer".split()
CRITICAL_PATIENT_FIELDS = ("patient_fname", "patient_lname", "dob", "medical_record_no", "patient_sex")
CRITICAL_ORDER_FIELDS = ("order_no", "order_date", "episode_start_date", "start_of_care", "physician_name", "primary_diagnosis")
ORDER_DATE_FIELDS = ("order_date", "episode_start_date", "episode_end_date", "start_of_care", "signed_by_physician_date")
EXPORT_COLUMNS = "Document_ID Timestamp Patient_ID Patient_Created Order_Pushed Patient_First_Name Patient_Last_Name Patient_DOB Patient_Sex Medical_Record_No Service_Line Payer_Source Physician_NPI Agency_Name Patient_Address Patient_City Patient_State Patient_Zip Patient_Phone Patient_Email Order_Number Order_Date Start_Of_Care Episode_Start_Date Episode_End_Date Sent_To_Physician_Date Signed_By_Physician_Date Company_ID PG_Company_ID SOC_Episode Start_Episode End_Episode Diagnosis_1 Diagnosis_2 Diagnosis_3 Diagnosis_4 Diagnosis_5 Diagnosis_6 API_Status Error_Message Remarks".split()
COMPLETENESS_COLUMNS = EXPORT_COLUMNS[:38]

DIAGNOSIS = T.StructType([T.StructField(n, T.StringType()) for n in ("diagnosis_code", "diagnosis_description", "diagnosis_type", "icd_version")])
PATIENT = T.StructType([T.StructField(n, T.StringType()) for n in PATIENT_FIELDS])
ORDER = T.StructType([*(T.StructField(n, T.StringType()) for n in ORDER_FIELDS), T.StructField("episode_diagnoses", T.ArrayType(DIAGNOSIS))])
PARSED = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("ordinal", T.LongType()), T.StructField("patient", PATIENT), T.StructField("order", ORDER),
    T.StructField("source", T.StringType()), T.StructField("status", T.StringType()), T.StructField("error", T.StringType()),
    T.StructField("confidence_score", T.DoubleType()), T.StructField("completeness_score", T.DoubleType()), T.StructField("extraction_method", T.StringType()), T.StructField("processing_time", T.DoubleType()),
])
FETCHED = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("pdf_buffer", T.BinaryType()), T.StructField("content", T.StringType()),
    T.StructField("file_name", T.StringType()), T.StructField("file_size", T.LongType()), T.StructField("error", T.StringType()), T.StructField("status_code", T.IntegerType()),
])


@dataclass(frozen=True)
class ParsingConfig:
    """Thresholds of the parse decision. Fixed values by default."""

    min_confidence: float = 0.15
    min_completeness: float = 0.1
    high_confidence: float = 0.3
    high_completeness: float = 0.2
    fallback_confidence: float = 0.1
    fallback_completeness: float = 0.15
    target_completeness: float = 0.95
    always_run_secondary: bool = False
    structured_base: float = 0.8
    secondary_base: float = 0.7
    merge_duplicates: bool = True
    match_weights: dict = field(default_factory=lambda: {"name": 0.4, "dob": 0.3, "mrn": 0.2, "ssn": 0.1})


def blank(c: Column) -> Column:
    """Missing: null, empty or white space."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")) == "", F.lit(True))


def truthy(c: Column) -> Column:
    """Not null and not empty; white space counts as filled."""
    return F.coalesce(c != "", F.lit(False))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def record(schema: T.StructType, values: dict[str, Column]) -> Column:
    """A struct of ``schema``; fields that are not given are empty."""
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            out.append(F.coalesce(values[f.name], F.array().cast(f.dataType)).alias(f.name) if f.name in values else F.array().cast(f.dataType).alias(f.name))
        else:
            out.append(or_empty(values[f.name].cast("string")).alias(f.name) if f.name in values else F.lit("").alias(f.name))
    return F.struct(*out)


def with_fields(struct: Column, schema: T.StructType, changes: dict[str, Column]) -> Column:
    """The struct with some fields replaced, others as they are."""
    return F.struct(*((changes[f.name] if f.name in changes else struct[f.name]).alias(f.name) for f in schema.fields))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body refers to it.

    The value is where an aggregate over one element starts and ends; the element is not looked at.
    An item of a transformed array comes to the same, but works out the body's type for every row.
    """
    return F.aggregate(F.array(F.lit(0)), value, lambda x, _: x, body)


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once, however often later ones refer to them.

    Projections that refer to each other are merged by the optimizer, which copies an
    expression into each of its uses; long pattern cascades must not be. A generator of a
    single row stands between them.
    """
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))
