"""The cube over the visits: five key dimensions and a dictionary of summed measures.

The facts are visits by business ID that carry their units (``compat_visits(..., with_units=True)``).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import MONEY
from ..functions.measures import visit_mean
from .olap import totals

DIMENSIONS = ["PatientID", "DoctorID", "DiagnosisID", "VisitTypeID", "DateID"]

# Cube measure -> fact column. Every measure is summed, the average cost included.
MEASURES = {
    "Service Cost": "ServiceCost",
    "Visit Count": "VisitCount",
    "Profit": "Profit",
    "Avg Treatment Cost": "AvgTreatmentCost",
    "Прибыль": "Profit",
    "Доход": "ServiceCost",
}


def with_unknown_members(fact: DataFrame) -> DataFrame:
    """NULL keys become the visible unknown member 0."""
    return fact.withColumns({c: F.coalesce(c, F.lit(0)) for c in DIMENSIONS})


def cube_query(
    fact: DataFrame, dims: list[str], measures: list[str], filters: Column | None = None, subtotals: bool = False
) -> DataFrame:
    """Measures over any of the dimension keys, optionally sliced and with subtotals.

    With ``subtotals`` the column ``Level`` tells which dimensions are aggregated away (bit 1 = last one), so an
    "all" member cannot be taken for a NULL key.
    """
    rows = with_unknown_members(fact if filters is None else fact.filter(filters))
    chosen = {name: MEASURES[name] for name in measures}
    finest = totals(rows, dims, chosen)
    if not subtotals:
        return finest
    types = dict(finest.dtypes)
    sums = [F.sum(F.col(f"`{m}`")).cast(types[m]).alias(m) for m in measures]
    return finest.cube(*dims).agg(F.grouping_id().cast("int").alias("Level"), *sums)


def average_treatment_cost(fact: DataFrame, dims: list[str]) -> DataFrame:
    """Mean of the treatment cost, beside the cube's sum of it."""
    mean = visit_mean("AvgTreatmentCost", MONEY, "MeanTreatmentCost")
    return with_unknown_members(fact).groupBy(*dims).agg(mean)
