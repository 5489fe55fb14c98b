"""Multidimensional aggregation: totals, subtotals, cross tables, shares, top-k, Pareto, outliers."""

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import literals as L
from ..functions.measures import AMOUNT, amount, percent_of, quantity, units, visit_amount
from .ordered import running_sum


def descending(column: str, *then: str) -> list[Column]:
    """Largest first, then by the named columns, which make the order total."""
    return [F.col(column).desc(), *[F.col(c) for c in then]]


def totals(df: DataFrame, dims: list[str], measures: dict[str, str]) -> DataFrame:
    """Sum of each measure per combination of ``dims``; ``measures`` maps an output name to a column.

    Money is reported as decimal(28,2), whole numbers as bigint. Where the rows carry a measure in its smallest
    unit, that is what is added up.
    """
    types = dict(df.dtypes)

    def total(alias: str, column: str) -> Column:
        if units(column) in types:
            return visit_amount(column, alias)
        return (amount if types[column].startswith("decimal") else quantity)(column, alias)

    return df.groupBy(*dims).agg(*[total(alias, column) for alias, column in measures.items()])


def grouping_sets(df: DataFrame, dims: list[str], sets: list[list[str]], measures: dict[str, str]) -> DataFrame:
    """Totals for several groupings at once.

    The rows are first reduced to one per combination of all ``dims``; only that result is multiplied by the
    number of sets. Sums of sums are the same sums.
    """
    finest = totals(df, dims, measures)
    types = dict(finest.dtypes)
    return finest.groupingSets([[F.col(c) for c in s] for s in sets], *dims).agg(
        *[F.sum(alias).cast(types[alias]).alias(alias) for alias in measures]
    )


def rollup(df: DataFrame, dims: list[str], measures: dict[str, str]) -> DataFrame:
    return grouping_sets(df, dims, [dims[:n] for n in range(len(dims), -1, -1)], measures)


def cube(df: DataFrame, dims: list[str], measures: dict[str, str]) -> DataFrame:
    every = [list(s) for n in range(len(dims), -1, -1) for s in combinations(dims, n)]
    return grouping_sets(df, dims, every, measures)


def cross_table(df: DataFrame, row: str, column: str, value: str, cells: dict[str, str]) -> DataFrame:
    """Sum of ``value`` per row and column member; ``cells`` maps members to output names, empty cells are 0.

    The pivot runs on totals, one row per cell.
    """
    table = totals(df, [row, column], {"_total": value}).groupBy(row).pivot(column, list(cells)).agg(F.sum("_total"))
    zero = F.lit(0).cast(AMOUNT)
    return table.select(row, *[F.coalesce(F.col(f"`{m}`").cast(AMOUNT), zero).alias(a) for m, a in cells.items()])


def grand_total(df: DataFrame, column: str) -> Column:
    """Sum over the whole table as a scalar subquery: one aggregated row, no window over all rows."""
    return df.agg(F.sum(column)).scalar()


def with_share(grouped: DataFrame, column: str, detail: DataFrame, alias: str) -> DataFrame:
    """Adds the share of each group in the total of ``column`` over the table it was grouped from."""
    return grouped.withColumn(alias, percent_of(F.col(column), grand_total(detail, column)))


def _cumulative(df: DataFrame, column: str, names: list[str]) -> tuple[DataFrame, Column]:
    """Rows with their running total, largest first, and the total of all rows (NULL when it is 0)."""
    running = running_sum(df, column, names, "_running", largest=column)
    return running, F.nullif(grand_total(df, column).cast(AMOUNT), F.lit(0).cast(AMOUNT))


def pareto(df: DataFrame, column: str, names: list[str], alias: str = "CumulativeSharePercent") -> DataFrame:
    running, total = _cumulative(df, column, names)
    return running.select(*df.columns, percent_of(F.col("_running"), total).alias(alias))


def abc_groups(df: DataFrame, column: str, names: list[str], share: str, label: str) -> DataFrame:
    """Pareto with a class per row; the classes are cut at the unrounded share, so sums are compared."""
    running, total = _cumulative(df, column, names)
    group = F.lit(L.ABC_REST)
    for limit, name in reversed(L.ABC_LIMITS):
        group = F.when(F.col("_running") * 100 <= total * limit, name).otherwise(group)
    return running.select(*df.columns, percent_of(F.col("_running"), total).alias(share), group.alias(label))


def outlier_bands(df: DataFrame, column: str, mean: str, deviation: str, band: str) -> DataFrame:
    """Each row against the mean plus or minus one sample standard deviation of the whole table."""
    average = df.agg(F.avg(F.col(column).cast("double"))).scalar()
    spread = df.agg(F.stddev_samp(F.col(column).cast("double"))).scalar()
    value = F.col(column).cast("double")
    label = F.when(value > average + spread, L.ABOVE).when(value < average - spread, L.BELOW).otherwise(L.NORMAL)
    return df.select(
        "*", F.round(average, 4).alias(mean), F.round(spread, 4).alias(deviation), label.alias(band)
    )


def leader(df: DataFrame, name: str, measure: str) -> Column:
    """Name with the largest total, as a scalar subquery (ties: the first name)."""
    top = df.groupBy(name).agg(F.sum(measure).alias("_total")).orderBy(*descending("_total", name)).limit(1)
    return top.select(name).scalar()
