"""Loads that change a dimension: deduplication, versioned merge (SCD2), overwriting merge (SCD1)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import literals as L
from ..session import checkpointed


def dedupe(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by all other columns, NULL first.

    The minimum is combined map-side, so many copies of one key never meet in one task.
    """
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(key) if c == key else F.col("_best")[c].alias(c) for c in df.columns])


def unknown_member(spark: SparkSession, schema: T.StructType, values: dict, key: str) -> DataFrame:
    """The single row with key 0 that stands in for unresolved references."""
    row = {key: 0, **values}
    if "IsCurrent" in schema.names:
        row["IsCurrent"] = True
    columns = [F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    if "EffectiveFrom" in schema.names:
        bounds = {"EffectiveFrom": L.FIRST_MOMENT, "EffectiveTo": L.LAST_MOMENT}
        columns = [
            F.lit(bounds[f.name]).cast("timestamp").alias(f.name) if f.name in bounds else c
            for f, c in zip(schema.fields, columns)
        ]
    return spark.range(0, 1, 1, 1).select(*columns)


def numbered(rows: DataFrame, key: str, last: int) -> DataFrame:
    """Rows with ``key`` set to ``last`` + 1, ``last`` + 2 and so on, in no particular order.

    The rows are stored as they lie in their partitions, so a number is the rows of the partitions before plus the
    place in the partition: no sort, no single task, and the same numbers whenever a task runs again.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = checkpointed(rows.withColumn("_part", F.spark_partition_id()).withColumn("_place", place))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.lit(last).cast("bigint") + F.col("_before") + F.col("_place") + 1
    joined = placed.join(F.broadcast(parts), "_part")
    return joined.select(*[number.alias(c) if c == key else F.col(c) for c in rows.columns])


def _comparable(column: Column, dtype: T.DataType) -> Column:
    """NULL text counts as empty text, NULL number as -1."""
    return F.coalesce(column, F.lit("") if isinstance(dtype, T.StringType) else F.lit(-1))


def scd2(
    target: DataFrame, source: DataFrame, business_key: str, surrogate_key: str, tracked: list[str],
    now: Column, batch_id: int,
) -> DataFrame:
    """New state of a versioned dimension after one source batch.

    ``source`` has one row per business key. A current row whose tracked attributes differ is closed one second
    before ``now`` and followed by a new version; a new ID starts its first version; an ID missing from the source
    stays as it is. One join decides all of it, and each matched pair emits the rows it leaves behind.
    New versions are numbered on from the largest key there is, so keys are unique, positive and in the order of the
    versions of an ID, whatever the IDs are and however many versions they get; 0 is only the unknown member's.
    """
    attributes = [c for c in source.columns if c != business_key]
    current = target.filter("IsCurrent")
    history = target.filter("NOT IsCurrent")

    old = current.select(F.col(business_key), F.struct(*[F.col(c) for c in current.columns]).alias("_old"))
    new = source.select(F.col(business_key), F.struct(*attributes).alias("_new"))
    pairs = old.join(new, business_key, "full")

    types = {f.name: f.dataType for f in target.schema.fields}
    differs = reduce(
        lambda a, b: a | b,
        [
            _comparable(F.col("_old")[c], types[c]) != _comparable(F.col("_new")[c], types[c])
            for c in tracked
        ],
    )

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in target.schema.fields])

    unchanged = version({c: F.col("_old")[c] for c in target.columns})
    closed = version(
        {c: F.col("_old")[c] for c in target.columns}
        | {"EffectiveTo": now - F.expr("INTERVAL 1 SECOND"), "IsCurrent": F.lit(False)}
    )
    opened = version(
        {business_key: F.col(business_key)}
        | {c: F.col("_new")[c] for c in attributes}
        | {
            surrogate_key: F.lit(None),
            "EffectiveFrom": now,
            "EffectiveTo": F.lit(L.LAST_MOMENT).cast("timestamp"),
            "IsCurrent": F.lit(True),
            "SourceBatchID": F.lit(batch_id),
        }
    )
    outcome = (
        F.when(F.col("_old").isNull(), F.array(opened))
        .when(F.col("_new").isNull() | ~differs, F.array(unchanged))
        .otherwise(F.array(closed, opened))
    )
    last = target.agg(F.max(surrogate_key)).first()[0] or 0
    stored = checkpointed(pairs.select(F.inline(outcome)))
    unnumbered = F.col(surrogate_key).isNull()
    added = numbered(stored.filter(unnumbered), surrogate_key, max(last, 0))
    return history.unionByName(stored.filter(~unnumbered)).unionByName(added)


def latest_version(target: DataFrame, source: DataFrame, business_key: str, surrogate_key: str) -> DataFrame:
    """Source rows with the newest current version of their ID beside them (NULL when there is none)."""
    versions = target.filter("IsCurrent").drop("IsCurrent")
    rest = [F.col(c) for c in versions.columns if c not in (business_key, surrogate_key)]
    newest = versions.groupBy(business_key).agg(F.max(F.struct(surrogate_key, *rest)).alias("_version"))
    return source.join(newest, business_key, "left").select("*", "_version.*").drop("_version")


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` replace or extend ``target``; the job fails when the source names a key twice.

    The copies of a key are counted on the way to the join, so the check costs no pass of its own.
    """
    old = target.select(F.col(key), F.struct(*target.columns).alias("_old"))
    counted = source.groupBy(key).agg(F.min(F.struct(*target.columns)).alias("_row"), F.count(F.lit(1)).alias("_copies"))
    twice = F.raise_error(F.concat(F.lit(f"duplicate {key} in source: "), F.col(key).cast("string")))
    new = counted.select(F.col(key), F.when(F.col("_copies") == 1, F.col("_row")).otherwise(twice).alias("_new"))
    merged = old.join(new, key, "full").select(F.coalesce("_new", "_old").alias("_row"))
    return merged.select("_row.*")
