"""Aggregate expressions with the decimal types the warehouse reports."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(28,2)"
PERCENT = "decimal(9,2)"

# Measures of a visit and their number of decimals. The stored visits hold each as a whole number of its smallest
# unit, because adding long integers takes a fraction of the time of adding decimals.
SCALES = {"ServiceCost": 2, "Profit": 2, "AvgTreatmentCost": 2, "RepeatRate": 4, "MarginPercent": 4}
_PART = 1_000_000
# Up to so many millions and rows, totals are put together and divided as long integers: decimals cost a multiple of that,
# and totals of months and members may be as many as the visits.
_FEW_MILLIONS, _FEW_ROWS = 50_000_000, 1_000_000


def units(measure: str) -> str:
    """Column that holds a visit measure in its smallest unit."""
    return f"{measure}Units"


def to_units(value: Column, measure: str) -> Column:
    return (value * 10 ** SCALES[measure]).cast("bigint").alias(units(measure))


def from_units(value: Column, measure: str, dtype: str) -> Column:
    smallest = F.lit(Decimal(1).scaleb(-SCALES[measure]))
    return (value.cast("decimal(26,0)") * smallest).cast(dtype)


def _sums(measure: str) -> tuple[Column, Column]:
    """Sum of a measure in its smallest unit, as millions and the rest: two long integers, so no sum that fits the reported
    decimal can overflow, and decimals are touched once per group instead of once per row."""
    column = units(measure)
    return F.sum(F.expr(f"{column} div {_PART}")), F.sum(F.col(column) % _PART)


def _few(millions: Column, rest: Column) -> Column:
    return millions.between(-_FEW_MILLIONS, _FEW_MILLIONS) & rest.between(-_PART * _FEW_ROWS, _PART * _FEW_ROWS)


def _total_units(measure: str) -> Column:
    """Sum of a measure in its smallest unit."""
    millions, rest = _sums(measure)
    exact = millions.cast("decimal(19,0)") * _PART + rest.cast("decimal(19,0)")
    return F.when(_few(millions, rest), (millions * _PART + rest).cast("decimal(26,0)")).otherwise(exact.cast("decimal(26,0)"))


def visit_amount(measure: str, alias: str) -> Column:
    """Sum of a money measure over visits."""
    return from_units(_total_units(measure), measure, AMOUNT).alias(alias)


def visit_mean(measure: str, dtype: str, alias: str) -> Column:
    """Mean of a measure over visits: four more digits than the measure has, then rounded to ``dtype``."""
    scale = SCALES[measure]
    total = from_units(_total_units(measure), measure, f"decimal(28,{scale})")
    n = F.count(F.lit(1))
    count = n.cast("decimal(19,0)")
    exact = (total / F.when(count != 0, count)).cast(f"decimal(28,{scale + 4})").cast(dtype)
    millions, rest = _sums(measure)
    sum_ = millions * _PART + rest
    # Half up, away from zero. With this few rows no quotient lies so near a half that the decimals' digits would miss it.
    size = F.call_function("div", F.abs(sum_) * 20_000 + n, n * 2)
    quick = F.when(sum_ < 0, -size).otherwise(size).cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale - 4))
    return F.when(_few(millions, rest) & n.between(1, _FEW_ROWS), quick.cast(dtype)).otherwise(exact).alias(alias)


def amount(column: str, alias: str | None = None) -> Column:
    return F.sum(column).cast(AMOUNT).alias(alias or column)


def quantity(column: str, alias: str | None = None) -> Column:
    return F.sum(column).cast("bigint").alias(alias or column)


def rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def mean(column: str, target: str, alias: str | None = None) -> Column:
    return F.avg(column).cast(target).alias(alias or column)


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole at two digits, NULL for an empty whole."""
    part, whole = part.cast(AMOUNT), whole.cast(AMOUNT)
    return (part * 100 / F.nullif(whole, F.lit(0).cast(AMOUNT))).cast(PERCENT)


def per(part: Column, count: Column) -> Column:
    """part / count at money scale, NULL for a zero count."""
    divisor = count.cast("decimal(19,0)")
    return (part.cast(AMOUNT) / F.when(divisor != 0, divisor)).cast("decimal(18,2)")
