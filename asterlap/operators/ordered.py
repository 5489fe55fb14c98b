"""Running sums, ranks and lags over groups of any size.

A plain window sorts each group in one task; a global one has a single group, and a ranking within five
specialties has five. Here the rows are dealt to buckets by ranges of (group, order), so a large group spans many buckets.
A sample of bounded size gives the ranges' bounds, every row finds its bucket among them by bisection, and the rows are
shuffled once, by the number of their bucket; windows and sums within buckets need no other shuffle. What a bucket needs
to know about those before it comes from one summary row per bucket and group. Only the leading group of a bucket can
have begun earlier, so at most one summary row per bucket matters, which bounds the broadcast by the number of buckets.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

_BUCKET = "_bucket"
#: Buckets at most, and rows of the sample for each of them. The sample decides the layout, never a result.
MAX_BUCKETS = 1000
SAMPLED_PER_BUCKET = 20


def _sort_key(group: list[str], largest: str | None, then: list[str]) -> Column:
    """What rows are ordered by, as one value: group, ``largest`` descending with NULL last, ``then`` ascending."""
    parts = [F.col(c) for c in group]
    if largest:
        parts += [F.col(largest).isNull(), -F.col(largest)]
    parts += [F.col(c) for c in then]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def _order(largest: str | None, then: list[str]) -> list[Column]:
    return ([F.col(largest).desc()] if largest else []) + [F.col(c) for c in then]


def _bucketed(df: DataFrame, group: list[str], largest: str | None, then: list[str], buckets: int | None) -> DataFrame:
    """Rows with the number of their bucket, shuffled by it. The input is stored, since the sample reads it too."""
    rows = checkpointed(df)
    number = min(buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    key = _sort_key(group, largest, then)
    sample = rows.select(key.alias("_key")).orderBy(F.rand(1)).limit(SAMPLED_PER_BUCKET * number)
    ordered = sample.agg(F.sort_array(F.collect_list("_key")).alias("_keys"))
    at = lambda i: F.get("_keys", F.floor(i * F.size("_keys") / number).cast("int"))
    bounds = ordered.select(F.transform(F.sequence(F.lit(1), F.lit(max(1, number - 1))), at)).scalar()
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((number - 1).bit_length()))])

    def on(place: Column, step: Column) -> Column:
        """As many bounds further as the step, if the row is not before the last of them."""
        return F.when(F.get("_bounds", place + step - 1) <= F.col("_key"), place + step).otherwise(place)

    found = F.reduce(steps, F.lit(0), on) if number > 1 else F.lit(0)
    placed = rows.withColumn("_bounds", bounds).withColumn("_key", key).withColumn(_BUCKET, found)
    return placed.drop("_bounds", "_key").repartitionById(number, F.col(_BUCKET))


def _with_carry(ranged: DataFrame, carry: DataFrame, group: list[str]) -> DataFrame:
    """Adds the carry columns to the rows of each bucket; the carry has at most one row per bucket."""
    keys = [*group, _BUCKET]
    renamed = carry.select(
        *[F.col(c).alias(f"_k_{c}") for c in keys], *[c for c in carry.columns if c not in keys]
    )
    matched = F.lit(True)
    for c in keys:
        matched = matched & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return ranged.join(F.broadcast(renamed), matched, "left").drop(*[f"_k_{c}" for c in keys])


def running_sum(
    df: DataFrame, value: str, then: list[str], alias: str, group: list[str] = (), buckets: int | None = None,
    largest: str | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows up to and including the current one, by ``largest`` descending, if given, and
    ``then`` ascending, which must be a total order."""
    group, order = list(group), _order(largest, then)
    ranged = _bucketed(df, group, largest, then, buckets)
    before = Window.partitionBy(*group).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy(*group, _BUCKET).agg(F.sum(value).alias("_total"))
        .withColumn("_carry", F.sum("_total").over(before))
        .filter("_carry IS NOT NULL").drop("_total")
    )
    dtype = df.select(F.sum(value)).schema[0].dataType
    local = Window.partitionBy(*group, _BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_local", F.sum(value).over(local))
    # A sum is NULL only as long as no value has been added.
    total = F.when(F.col("_local").isNull(), F.col("_carry")).otherwise(F.coalesce("_carry", F.lit(0).cast(dtype)) + F.col("_local"))
    return _with_carry(summed, carry, group).withColumn(alias, total.cast(dtype)).drop("_carry", "_local", _BUCKET)


def rank_descending(
    df: DataFrame, value: str, tiebreak: list[str], group: list[str] = (),
    rank: str | None = None, dense_rank: str | None = None, buckets: int | None = None,
) -> DataFrame:
    """RANK and/or DENSE_RANK by ``value`` (not NULL), largest first.

    ``tiebreak`` columns spread equal values over buckets; they do not influence the ranks.
    """
    group = list(group)
    ranged = _bucketed(df, group, value, tiebreak, buckets)

    counted = ranged.groupBy(*group, _BUCKET, value).agg(F.count(F.lit(1)).alias("_n"))
    summary = counted.groupBy(*group, _BUCKET).agg(
        F.sum("_n").alias("_rows"),
        F.count(F.lit(1)).alias("_values"),
        F.max(value).alias("_lead"),
        F.min(value).alias("_last"),
        F.min_by("_n", value).alias("_last_rows"),
    )
    by_bucket = Window.partitionBy(*group).orderBy(_BUCKET)
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    tie = Window.partitionBy(*group, "_last").orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, 0)
    carry = (
        summary.withColumn("_tied", F.sum("_last_rows").over(tie))
        .withColumn("_goes_on", F.coalesce(F.lag("_last").over(by_bucket) == F.col("_lead"), F.lit(False)))
        .select(
            *group, _BUCKET, "_lead", "_goes_on",
            F.sum("_rows").over(earlier).alias("_rows_before"),
            (F.sum("_values").over(earlier) - F.sum(F.col("_goes_on").cast("int")).over(
                by_bucket.rowsBetween(Window.unboundedPreceding, 0)
            )).alias("_values_before"),
            F.lag("_tied").over(by_bucket).alias("_tied_before"),
        )
        .filter("_rows_before IS NOT NULL")
    )
    local = Window.partitionBy(*group, _BUCKET).orderBy(F.col(value).desc())
    ranked = ranged.withColumn("_rank", F.rank().over(local)).withColumn("_dense", F.dense_rank().over(local))
    joined = _with_carry(ranked, carry, group)
    continues = F.col("_goes_on") & (F.col(value) == F.col("_lead"))
    before = F.coalesce("_rows_before", F.lit(0)) - F.when(continues, F.col("_tied_before")).otherwise(0)
    results = {rank: F.col("_rank") + before, dense_rank: F.col("_dense") + F.coalesce("_values_before", F.lit(0))}
    return joined.select(*df.columns, *[c.cast("int").alias(name) for name, c in results.items() if name])


def previous_value(
    df: DataFrame, value: str, order: list[str], alias: str, group: list[str], buckets: int | None = None
) -> DataFrame:
    """Value of the preceding row of the group (ascending, total ``order``), NULL for its first row."""
    ranged = _bucketed(df, group, None, order, buckets)
    by_bucket = Window.partitionBy(*group).orderBy(_BUCKET)
    carry = (
        ranged.groupBy(*group, _BUCKET)
        .agg(F.max(F.struct(*order, F.col(value).alias("_value"))).alias("_last"))
        .select(*group, _BUCKET, F.lag("_last").over(by_bucket).alias("_carry"))
        .filter("_carry IS NOT NULL")
        .select(*group, _BUCKET, F.col("_carry._value").alias("_carry"))
    )
    local = Window.partitionBy(*group, _BUCKET).orderBy(*order)
    lagged = ranged.withColumn("_lag", F.lag(value).over(local)).withColumn("_position", F.row_number().over(local))
    joined = _with_carry(lagged, carry, group)
    result = F.when(F.col("_position") == 1, F.col("_carry")).otherwise(F.col("_lag"))
    return joined.select(*df.columns, result.alias(alias))
