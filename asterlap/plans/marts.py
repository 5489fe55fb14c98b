"""Marts: subject tables aggregated from the detailed visits, and the business-ID views of the dimensions.

The visits carry their measures in smallest units (``visit_detailed(..., with_units=True)``). ``members`` are the current
members as ``fact.current_members`` gives them; with them, many members are totalled in narrower shuffles.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import MONEY, RATE
from ..functions.measures import quantity, rows, visit_amount, visit_mean
from ..operators.members import member_totals


def _totals():
    return [
        quantity("VisitCount", "VisitQty"),
        visit_amount("ServiceCost", "RevenueAmount"),
        visit_amount("Profit", "ProfitAmount"),
    ]


def doctor_performance(visits: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Doctor by month."""
    return member_totals(visits, "DoctorID", ["DoctorName", "Specialty", "SpecialtyGroup"], ["Year", "Month"], [
        rows("RowCountForIndexedUse"),
        *_totals(),
        visit_mean("ServiceCost", MONEY, "AvgCheck"),
        visit_mean("MarginPercent", RATE, "AvgMarginPercent"),
        visit_mean("RepeatRate", RATE, "AvgRepeatRate"),
    ], members)


def diagnosis_performance(visits: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Diagnosis by month."""
    return member_totals(visits, "DiagnosisID", ["ICDCode", "DiagnosisName", "DiagnosisClass"], ["Year", "Month"], [
        *_totals(),
        visit_mean("RepeatRate", RATE, "AvgRepeatRate"),
        visit_mean("AvgTreatmentCost", MONEY, "AvgTreatmentCost"),
    ], members)


def patient_segment(visits: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row per patient version that has visits."""
    first, last = F.min("FullDate"), F.max("FullDate")
    return member_totals(visits, "PatientID", ["PatientName", "Age", "AgeBand"], [], [
        rows("VisitRows"),
        *_totals(),
        first.alias("FirstVisitDate"),
        last.alias("LastVisitDate"),
        F.datediff(last, first).alias("VisitSpanDays"),
        visit_mean("RepeatRate", RATE, "AvgRepeatRate"),
    ], members)


def time_series(visits: DataFrame) -> DataFrame:
    """One row per calendar day with visits, plus one for visits without a valid date."""
    return visits.groupBy("FullDate", "Year", "Month", "MonthName", "QuarterNumber").agg(
        *_totals(),
        visit_mean("AvgTreatmentCost", MONEY, "AvgTreatmentCost"),
        visit_mean("RepeatRate", RATE, "AvgRepeatRate"),
    )


def compat_dimension(name: str, dimension: DataFrame) -> DataFrame:
    """Current members of a dimension by business ID, the unknown member included."""
    columns = {
        "patient": {"PatientID": "PatientID", "FullName": "Name", "Age": "Age", "Phone": "Phone"},
        "doctor": {"DoctorID": "DoctorID", "FullName": "Name", "Specialty": "Specialty"},
        "date": {"DateID": "DateID", "Day": "Day", "Month": "Month", "Year": "Year", "WeekDayName": "WeekDay"},
        "visit_type": {"VisitTypeID": "VisitTypeID", "VisitName": "VisitName", "VisitCode": "VisitCode"},
        "diagnosis": {
            "DiagnosisID": "DiagnosisID", "ICDCode": "ICDCode",
            "DiagnosisName": "DiagnosisName", "TreatmentMethod": "TreatmentMethod",
        },
    }[name]
    current = dimension.filter("IsCurrent") if "IsCurrent" in dimension.columns else dimension
    return current.select(*[F.col(c).alias(a) for c, a in columns.items()])
