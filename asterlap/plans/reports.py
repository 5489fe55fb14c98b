"""Parameterised reports. A filter is planned only when its argument is given, so that it can reach the scan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import literals as L
from ..functions.cleaning import RATE
from ..functions.measures import AMOUNT, amount, mean, percent_of, quantity, rows
from ..operators.ordered import rank_descending


def doctor_dashboard(performance: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Doctors by month, ranked by revenue within the month."""
    for column, value in (("Year", year), ("Month", month)):
        if value is not None:
            performance = performance.filter(F.col(column) == value)
    ranked = rank_descending(
        performance.drop("RowCountForIndexedUse"), "RevenueAmount", ["DoctorID"], ["Year", "Month"],
        dense_rank="RevenueRank",
    )
    return ranked.orderBy("Year", "Month", "RevenueRank", "DoctorName", "DoctorID")


def diagnosis_dashboard(performance: DataFrame, diagnosis_class: str | None = None) -> DataFrame:
    """Diagnoses by month with their share in the revenue of the class.

    The class is one of a fixed list of labels, so its totals are a handful of rows to broadcast.
    """
    if diagnosis_class is not None:
        performance = performance.filter(F.col("DiagnosisClass") == diagnosis_class)
    by_class = performance.groupBy("DiagnosisClass").agg(amount("RevenueAmount", "ClassRevenue"))
    return (
        performance.join(F.broadcast(by_class), "DiagnosisClass")
        .select(
            "DiagnosisClass", "ICDCode", "DiagnosisName", "Year", "Month",
            "VisitQty", "RevenueAmount", "ProfitAmount", "AvgRepeatRate", "AvgTreatmentCost",
            F.col("ClassRevenue").cast(AMOUNT).alias("ClassRevenue"),
            percent_of(F.col("RevenueAmount"), F.col("ClassRevenue")).alias("ShareWithinClass"),
        )
        .orderBy("DiagnosisClass", F.desc("RevenueAmount"), "DiagnosisName")
    )


def patient_age(segments: DataFrame) -> DataFrame:
    """Patients by age band, youngest band first."""
    position = F.array_position(F.array(*[F.lit(label) for label in L.AGE_LABELS]), F.col("AgeBand"))
    return (
        segments.groupBy("AgeBand")
        .agg(
            rows("PatientQty"), quantity("VisitQty"), amount("RevenueAmount"), amount("ProfitAmount"),
            mean("AvgRepeatRate", RATE),
        )
        .orderBy(position)
    )
