"""Checks of declared keys, references and mandatory columns; each returns the offending keys as a DataFrame."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import previous_value

#: Offending keys that an error's text names; its report has them all.
NAMED_KEYS = 5
#: Rows whose keys one task holds at most. Keys are short and compress well, so partitions sized by their bytes hold far more.
ROWS_PER_TASK = 1_000_000


class KeyPolicyError(ValueError):
    """A key check found offending rows; ``report`` is the DataFrame of all of them."""

    def __init__(self, message: str, report: DataFrame | None = None):
        super().__init__(message)
        self.report = report


def _text(column: str, kind: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss") if kind == "timestamp" else F.col(column).cast("string")


def spread_by(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df`` of at most ``rows`` rows, shuffled by ``keys`` into as many partitions as ROWS_PER_TASK asks for."""
    return df.repartition(math.ceil(rows / ROWS_PER_TASK), *keys) if rows > ROWS_PER_TASK else df


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    The partitions of a large table follow from its number of rows, so a task's memory doesn't grow with the table. Its
    keys are counted per task that read them first, so a key that fills a third of the table is one row per task.
    """
    rows = df.count()
    if rows <= ROWS_PER_TASK:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("KeyRows")).filter("KeyRows > 1")
    parts = spread_by(df.select(*keys, F.spark_partition_id().alias("_part")), [*keys, "_part"], rows)
    counted = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    return spread_by(counted, keys, rows).groupBy(*keys).agg(F.sum("_n").alias("KeyRows")).filter("KeyRows > 1")


def duplicates_of_all(declared: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """(TableName, KeyName, ErrorType, KeyValue, KeyRows) of the duplicates of every declared (table, rows, key). A NULL
    shows as nothing."""
    found = []
    for name, df, keys in declared:
        kinds = dict(df.dtypes)
        value = F.concat_ws("|", *[F.coalesce(_text(k, kinds[k]), F.lit("")) for k in keys])
        found.append(duplicated_keys(df, keys).select(
            F.lit(name).alias("TableName"), F.lit("+".join(keys)).alias("KeyName"), F.lit("duplicate").alias("ErrorType"),
            value.alias("KeyValue"), "KeyRows",
        ))
    return reduce(DataFrame.unionByName, found)


def version_faults(name: str, dimension: DataFrame, business_key: str, surrogate_key: str) -> DataFrame:
    """IDs of a versioned dimension whose versions overlap (one begins before the one before it ends) or of which not
    exactly one is current; the columns are those of ``duplicates_of_all``. No ID's versions need to fit a task."""
    bounds = dimension.select(business_key, surrogate_key, "EffectiveFrom", "EffectiveTo")
    after = previous_value(bounds, "EffectiveTo", ["EffectiveFrom", surrogate_key], "EndBefore", [business_key])
    overlaps = after.filter("EndBefore >= EffectiveFrom").groupBy(business_key).agg(F.count(F.lit(1)).alias("KeyRows"))
    current = dimension.groupBy(business_key).agg(F.count_if("IsCurrent").alias("KeyRows")).filter("KeyRows <> 1")
    kinds = [("overlap", overlaps), ("not one current version", current)]
    return reduce(DataFrame.unionByName, [
        df.select(
            F.lit(name).alias("TableName"), F.lit(business_key).alias("KeyName"), F.lit(kind).alias("ErrorType"),
            F.col(business_key).cast("string").alias("KeyValue"), "KeyRows",
        )
        for kind, df in kinds
    ])


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Referencing keys without a parent, with their number of rows; NULL references are not orphans.

    The child is grouped first, so a key that fills a third of the child reaches the join as one row.
    """
    used = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("KeyRows"))
    known = parent.select(F.col(parent_key).alias(child_key))
    return used.join(known, child_key, "left_anti")


#: Of each reference, by its column: the referenced rows and their key.
References = dict[str, tuple[DataFrame, str]]


def _parent_keys(parents: References) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        parent.select(F.lit(c).alias("Reference"), F.col(key).cast("string").alias("KeyValue")) for c, (parent, key) in parents.items()
    ])


def orphans_of_all(child: DataFrame, parents: References) -> DataFrame:
    """(Reference, KeyValue, KeyRows) of the orphans of every reference, from one pass over the child.

    Each row gives a pair of reference and key per reference; the pairs are counted map-side, and only the distinct ones
    are shuffled and held against all parents in one join.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("Reference"), F.col(c).cast("string").alias("KeyValue")) for c in parents])
    used = child.select(F.inline(pairs)).filter("KeyValue IS NOT NULL").groupBy("Reference", "KeyValue")
    return used.agg(F.count(F.lit(1)).alias("KeyRows")).join(_parent_keys(parents), ["Reference", "KeyValue"], "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of NULLs per column, all counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("ColumnName"), F.col(c).alias("NullRows")) for c in columns])
    return counted.select(F.inline(pairs))


def null_counts_of_all(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(TableName, ColumnName, NullRows) of the mandatory columns of every table, with one pass over each."""
    return reduce(DataFrame.unionByName, [
        null_counts(df, columns).select(F.lit(name).alias("TableName"), "ColumnName", "NullRows") for name, (df, columns) in tables.items()
    ])


def require_unique(df: DataFrame, keys: list[str]) -> None:
    _stop(duplicated_keys(df, keys), f"duplicate key {keys}")


def key_policy(child: DataFrame, parents: References) -> DataFrame:
    """(Reference, ErrorType, KeyValue, KeyRows): all key errors between a child and its parents: keys that no parent
    has, keys that a parent has more than once, and NULL keys of parents. One pass over the child, one over the parents."""
    known = _parent_keys(parents).groupBy("Reference", "KeyValue").agg(F.count(F.lit(1)).alias("KeyRows"))
    error = F.when(F.col("KeyValue").isNull(), "NullKey").when(F.col("KeyRows") > 1, "KeyDuplicate")
    wrong = known.select("Reference", error.alias("ErrorType"), "KeyValue", "KeyRows").filter("ErrorType IS NOT NULL")
    lost = orphans_of_all(child, parents).select("Reference", F.lit("KeyNotFound").alias("ErrorType"), "KeyValue", "KeyRows")
    return lost.unionByName(wrong)


def require_key_policy(child: DataFrame, parents: References) -> None:
    """Report and stop: raises when any key error exists."""
    _stop(key_policy(child, parents), "key errors")


def _stop(report: DataFrame, what: str) -> None:
    sample = report.head(NAMED_KEYS)
    if sample:
        raise KeyPolicyError(f"{what}: {report.count()} keys, such as {[tuple(r) for r in sample]}", report)
