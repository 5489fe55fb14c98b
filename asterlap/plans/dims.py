"""Cleaned sources and loads of the five dimensions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import literals as L
from ..functions import cleaning as C
from ..operators.merge import dedupe, scd2, unknown_member, upsert
from ..schemas import DIMENSIONS


def patient_rows(raw: DataFrame) -> DataFrame:
    phone = F.trim("Phone")
    return raw.select(
        "PatientID",
        F.trim("FullName").alias("FullName"),
        "Age",
        C.age_band(F.col("Age")).alias("AgeBand"),
        phone.alias("Phone"),
        C.phone_digits(phone).alias("PhoneNormalized"),
    )


def clean_patients(raw: DataFrame) -> DataFrame:
    """Distinct cleaned rows, invalid ones included (the reject report needs them)."""
    return patient_rows(raw).distinct()


def patient_is_valid() -> Column:
    return F.col("PatientID").isNotNull() & ~C.is_blank(F.col("FullName")) & C.age_is_valid(F.col("Age"))


def doctor_is_valid() -> Column:
    return F.col("DoctorID").isNotNull() & ~C.is_blank(F.col("FullName"))


def diagnosis_is_valid() -> Column:
    return F.col("DiagnosisID").isNotNull() & ~C.is_blank(F.col("DiagnosisName"))


def doctor_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(doctor_is_valid()).select(
        "DoctorID",
        F.trim("FullName").alias("FullName"),
        F.trim("Specialty").alias("Specialty"),
        C.specialty_group(F.col("Specialty")).alias("SpecialtyGroup"),
    )


def clean_doctors(raw: DataFrame) -> DataFrame:
    return doctor_rows(raw).distinct()


def diagnosis_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(diagnosis_is_valid()).select(
        "DiagnosisID",
        F.trim("ICDCode").alias("ICDCode"),
        F.trim("DiagnosisName").alias("DiagnosisName"),
        F.trim("TreatmentMethod").alias("TreatmentMethod"),
        C.diagnosis_class(F.col("ICDCode")).alias("DiagnosisClass"),
    )


def clean_diagnoses(raw: DataFrame) -> DataFrame:
    return diagnosis_rows(raw).distinct()


def clean_visit_types(raw: DataFrame) -> DataFrame:
    return raw.filter("VisitTypeID IS NOT NULL").select(
        "VisitTypeID",
        F.trim("VisitName").alias("VisitName"),
        F.trim("VisitCode").alias("VisitCode"),
        C.visit_category(F.col("VisitCode")).alias("VisitCategory"),
    ).distinct()


def full_date() -> Column:
    return C.calendar_date(F.col("Year"), F.col("Month"), F.col("Day"))


def clean_dates(raw: DataFrame) -> DataFrame:
    date = F.col("FullDate")
    dated = raw.withColumn("FullDate", full_date()).filter("DateID IS NOT NULL AND FullDate IS NOT NULL")
    return dated.select(
        "DateID", "FullDate", "Day", "Month", "Year",
        F.quarter(date).alias("QuarterNumber"),
        F.date_format(date, "MMMM").alias("MonthName"),
        F.trim("WeekDay").alias("WeekDayName"),
        F.weekofyear(date).alias("WeekOfYear"),
        C.is_weekend(date).alias("IsWeekend"),
        C.academic_period(F.col("Month")).alias("AcademicPeriod"),
    ).distinct()


# How each versioned dimension is keyed and which attributes open a new version.
VERSIONED = {
    "patient": ("PatientID", "PatientKey", ["FullName", "Age", "PhoneNormalized"]),
    "doctor": ("DoctorID", "DoctorKey", ["FullName", "Specialty", "SpecialtyGroup"]),
    "diagnosis": ("DiagnosisID", "DiagnosisKey", ["ICDCode", "DiagnosisName", "TreatmentMethod", "DiagnosisClass"]),
}
OVERWRITTEN = {"date": ("DateID", "DateKey"), "visit_type": ("VisitTypeID", "VisitTypeKey")}
UNKNOWN = {
    "patient": L.UNKNOWN_PATIENT,
    "doctor": L.UNKNOWN_DOCTOR,
    "diagnosis": L.UNKNOWN_DIAGNOSIS,
    "date": L.UNKNOWN_DATE,
    "visit_type": L.UNKNOWN_VISIT_TYPE,
}
STAGED = {
    "patient": "patients", "doctor": "doctors", "diagnosis": "diagnoses", "date": "dates", "visit_type": "visit_types",
}


def source_rows(name: str, raw: DataFrame) -> DataFrame:
    """Valid cleaned rows of a dimension; exactly one per ID where the dimension is versioned.

    Keeping one row per ID also removes exact copies, so there is no separate pass for those.
    """
    if name == "patient":
        return dedupe(patient_rows(raw).filter(patient_is_valid()), "PatientID")
    if name == "doctor":
        return dedupe(doctor_rows(raw), "DoctorID")
    if name == "diagnosis":
        return dedupe(diagnosis_rows(raw), "DiagnosisID")
    return clean_dates(raw) if name == "date" else clean_visit_types(raw)


def surrogate_key(name: str) -> str:
    return (VERSIONED | OVERWRITTEN)[name][1]


def empty_dimension(spark: SparkSession, name: str) -> DataFrame:
    """The dimension before its first load: only the unknown member."""
    return unknown_member(spark, DIMENSIONS[name], UNKNOWN[name], surrogate_key(name))


def load_dimension(name: str, target: DataFrame, raw: DataFrame, now: Column, batch_id: int) -> DataFrame:
    """New state of a dimension after one batch of raw rows."""
    source = source_rows(name, raw)
    if name in VERSIONED:
        business_key, surrogate_key, tracked = VERSIONED[name]
        return scd2(target, source, business_key, surrogate_key, tracked, now, batch_id)
    business_key, surrogate_key = OVERWRITTEN[name]
    keyed = source.withColumn(surrogate_key, F.col(business_key)).withColumn("SourceBatchID", F.lit(batch_id))
    return upsert(target, keyed, business_key)
