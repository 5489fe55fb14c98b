import pytest
from pyspark.sql import functions as F

from asterlap.operators import joins
from asterlap.operators.joins import fits, hot_keys, lookup


@pytest.fixture(scope="module")
def facts(spark):
    """3000 rows: a third on key 1, some without key, some with a key nobody knows."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700)
    return spark.range(3000).select(F.col("id").alias("row_id"), key.alias("k"))


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(600).select(F.col("id").alias("k"), F.concat(F.lit("name "), "id").alias("name"))


def test_fits(spark):
    assert fits(spark.range(10), 10)
    assert not fits(spark.range(11), 10)
    assert fits(spark.range(0), 0)


def test_hot_keys_finds_the_heavy_key_only(facts):
    found = hot_keys(facts, ["k", "row_id"], share=0.1)
    assert list(found["k"]) == [1] and 0.3 < found["k"][1] < 0.4 and found["row_id"] == {}


def test_hot_keys_of_nothing(spark):
    empty = spark.range(0).select(F.col("id").alias("k"))
    assert hot_keys(empty, ["k"]) == {"k": {}}


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("hot", [None, {1: 0.34}, {1: 0.34, 5: 1.0, 9999: 0.01}])
def test_salted_lookup_equals_plain_join(facts, dimension, rows, how, hot):
    salted = lookup(facts, dimension, "k", "row_id", hot, how, broadcast=False)
    plain = facts.join(dimension, "k", how)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_small_dimension_is_broadcast_and_large_one_is_not(facts, dimension, monkeypatch):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(lookup(facts, dimension, "k", "row_id"))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 599)
    assert "strategy=broadcast" not in plan(lookup(facts, dimension, "k", "row_id"))


def test_hot_key_is_spread_over_salts(spark, facts, dimension):
    """No partition of the salted side holds much more than its share."""
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("row_id"), F.lit(salts))
    sizes = [r["count"] for r in facts.filter("k = 1").groupBy(salt).count().collect()]
    assert len(sizes) == salts and max(sizes) < 2 * sum(sizes) / salts


def test_hot_share_follows_the_partitions(spark):
    """A key with half a percent of the rows is hot among 2000 partitions, not among 8."""
    df = spark.range(200_000).select(F.when(F.col("id") % 200 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert hot_keys(df, ["k"]) == {"k": {}}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert list(hot_keys(df, ["k"])["k"]) == [-1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_of_a_shuffled_lookup_are_not_sorted(facts, dimension, rows):
    """Sorted wide facts spill; the hashed side is the dimension. Facts without hot keys carry no salt."""
    for hot in (None, {}, {1: 0.34}):
        got = lookup(facts, dimension, "k", "row_id", hot, broadcast=False)
        assert "ShuffledHashJoin" in executed(got) and "Sort " not in executed(got)
        assert ("_salt" in executed(got)) == (hot != {})
        assert rows(got) == rows(facts.join(dimension, "k", "left"))
    merged = lookup(facts, dimension, "k", "row_id", {}, broadcast=False, strategy="merge")
    assert "SortMergeJoin" in executed(merged) and rows(merged) == rows(facts.join(dimension, "k", "left"))


def test_missing_keys_are_hot_when_they_are_many(spark, dimension, rows):
    df = spark.range(4000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, F.col("id") % 700).alias("k"))
    hot = hot_keys(df, ["k", "row_id"], share=0.1)
    assert hot == {"k": {None: 0.5}, "row_id": {}}
    got = lookup(df, dimension, "k", "row_id", hot["k"], broadcast=False)
    assert "_salt" in executed(got) and rows(got) == rows(df.join(dimension, "k", "left"))


def test_a_dimension_tiny_beside_its_facts_is_broadcast_at_any_size(spark):
    for n in (1, 5):
        assert joins.worth_broadcasting(spark.range(20 * n), spark.range(2000 * n), 10)
        assert not joins.worth_broadcasting(spark.range(20 * n), spark.range(2000 * n - 1), 10)
    assert not joins.worth_broadcasting(spark.range(101), spark.range(100_000), 10)
    assert joins.worth_broadcasting(spark.range(10), spark.range(0), 10)
