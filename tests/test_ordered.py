"""The bucketed windows against Spark's own windows, on groups that span many buckets."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from asterlap.operators.ordered import _bucketed, previous_value, rank_descending, running_sum


def table(spark, n, spread, seed):
    """Group a holds most rows, b a few, NULL some, x0.. one each; values repeat heavily when ``spread`` is small."""
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000))
    group = (
        F.when(draw < 700, "a").when(draw < 800, "b").when(draw < 850, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("x"), "id"))
    )
    value = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(spread)).cast("decimal(18,2)")
    return spark.range(n).select(group.alias("g"), value.alias("v"), F.col("id").alias("name"))


CASES = [(400, 3, 1, 8), (400, 1, 2, 16), (300, 100000, 3, 5), (50, 7, 4, 32), (1, 5, 5, 4), (0, 5, 6, 4)]


@pytest.mark.parametrize("group", [[], ["g"]])
@pytest.mark.parametrize("n,spread,seed,buckets", CASES)
def test_running_sum(spark, rows, n, spread, seed, buckets, group):
    df = table(spark, n, spread, seed)
    order = [F.col("v").desc(), F.col("name")]
    found = running_sum(df, "v", ["name"], "total", group, buckets, largest="v")
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    assert rows(found) == rows(df.withColumn("total", F.sum("v").over(window)))


@pytest.mark.parametrize("group", [[], ["g"]])
@pytest.mark.parametrize("n,spread,seed,buckets", CASES)
def test_ranks(spark, rows, n, spread, seed, buckets, group):
    df = table(spark, n, spread, seed)
    found = rank_descending(df, "v", ["name"], group, "r", "dr", buckets)
    window = Window.partitionBy(*group).orderBy(F.col("v").desc())
    assert rows(found) == rows(df.withColumn("r", F.rank().over(window)).withColumn("dr", F.dense_rank().over(window)))


@pytest.mark.parametrize("n,spread,seed,buckets", CASES)
def test_previous_value(spark, rows, n, spread, seed, buckets):
    df = table(spark, n, spread, seed)
    found = previous_value(df, "v", ["name"], "before", ["g"], buckets)
    window = Window.partitionBy("g").orderBy("name")
    assert rows(found) == rows(df.withColumn("before", F.lag("v").over(window)))


def test_previous_value_keeps_a_null_predecessor(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 7)], "g string, o int, v int")
    found = previous_value(df, "v", ["o"], "before", ["g"], buckets=4)
    assert rows(found, "o", "before") == [(1, None), (2, None), (3, 5), (4, None)]


def test_last_running_total_is_the_sum(spark):
    df = table(spark, 500, 50, 9)
    found = running_sum(df, "v", ["name"], "total", buckets=16, largest="v")
    assert found.agg(F.max("total")).first()[0] == df.agg(F.sum("v")).first()[0]


@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_sum_over_null_values(spark, rows, group):
    df = table(spark, 200, 6, 11).withColumn("v", F.when(F.col("v") > 2, F.col("v")))
    order = [F.col("name")]
    found = running_sum(df, "v", ["name"], "total", group, 9)
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    assert rows(found) == rows(df.withColumn("total", F.sum("v").over(window)))


def test_rows_are_shuffled_once_by_their_bucket(spark):
    """Of the exchanges that rows pass, the one by buckets is the only one; the others carry summaries."""
    df = table(spark, 400, 50, 1)
    for found in (rank_descending(df, "v", ["name"], ["g"], "r", "dr", 8), running_sum(df, "v", ["name"], "t", ["g"], 8), previous_value(df, "v", ["name"], "b", ["g"], 8)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        way = plan[: plan.index("BroadcastExchange")]
        assert way.count("Exchange shufflepartitionidpassthrough") == 1 and "Exchange hashpartitioning" not in way, plan
        assert found.count() == 400


def test_buckets_are_even(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("v"), "id")
    sizes = [r["count"] for r in _bucketed(df, [], "v", ["id"], 16).groupBy("_bucket").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 20_000 / 16
