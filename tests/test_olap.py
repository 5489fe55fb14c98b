from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from asterlap.operators import olap


@pytest.fixture(scope="module")
def sales(spark):
    data = [("a", "x", "10.00"), ("a", "y", "30.00"), ("b", "x", "20.00"), (None, "x", "40.00"), ("b", "x", "0.00")]
    return spark.createDataFrame(data, "g string, h string, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))


def test_rollup_keeps_null_members_apart_from_totals(sales, rows):
    assert rows(olap.rollup(sales, ["g", "h"], {"s": "v"})) == [
        ("a", "x", D("10.00")), ("a", "y", D("30.00")), ("a", None, D("40.00")), ("b", "x", D("20.00")),
        ("b", None, D("20.00")), (None, "x", D("40.00")), (None, None, D("40.00")), (None, None, D("100.00")),
    ]


def test_cube_equals_sparks_cube(sales, rows):
    mine = olap.cube(sales, ["g", "h"], {"s": "v"})
    assert rows(mine) == rows(sales.cube("g", "h").agg(F.sum("v").cast("decimal(28,2)").alias("s")))


def test_cross_table_fills_empty_cells(sales, rows):
    assert rows(olap.cross_table(sales, "g", "h", "v", {"x": "X", "y": "Y", "z": "Z"})) == [
        ("a", D("10.00"), D("30.00"), D("0.00")), ("b", D("20.00"), D("0.00"), D("0.00")),
        (None, D("40.00"), D("0.00"), D("0.00")),
    ]


def test_share_and_pareto(sales, rows):
    by_g = olap.totals(sales, ["g"], {"v": "v"})
    shares = rows(olap.with_share(by_g, "v", sales, "p"), "g", "p")
    assert shares == [("a", D("40.00")), ("b", D("20.00")), (None, D("40.00"))]
    assert rows(olap.pareto(by_g, "v", ["g"], "p"), "g", "p") == [("a", D("80.00")), ("b", D("100.00")), (None, D("40.00"))]


def test_abc_cuts_at_the_unrounded_share(spark, rows):
    df = spark.createDataFrame([("a", "80.00"), ("b", "15.00"), ("c", "5.00")], "n string, v string").withColumn(
        "v", F.col("v").cast("decimal(18,2)"))
    assert rows(olap.abc_groups(df, "v", ["n"], "p", "c"), "n", "c") == [("a", "A"), ("b", "B"), ("c", "C")]
    above = df.withColumn("v", F.when(F.col("n") == "a", F.lit(D("80.01"))).otherwise(F.col("v")))
    assert rows(olap.abc_groups(above, "v", ["n"], "p", "c"), "n", "c") == [("a", "B"), ("b", "C"), ("c", "C")]


def test_share_of_an_empty_whole_is_null(spark, rows):
    df = spark.createDataFrame([("a",)], "g string").withColumn("v", F.lit(D("0.00")).cast("decimal(18,2)"))
    assert rows(olap.with_share(olap.totals(df, ["g"], {"v": "v"}), "v", df, "p"), "p") == [(None,)]


def test_leader_breaks_ties_by_name(spark, sales):
    assert [r[0] for r in spark.range(1).select(olap.leader(sales.filter("g IS NOT NULL OR v < 0"), "g", "v")).collect()] == ["a"]


def test_outlier_bands(spark, rows):
    df = spark.createDataFrame([(i, "100.00" if i else "900.00") for i in range(10)], "d int, v string").withColumn(
        "v", F.col("v").cast("decimal(18,2)"))
    found = rows(olap.outlier_bands(df, "v", "m", "s", "band"), "d", "band")
    assert found[0] == (0, "Vyshe normy") and all(band == "Norma" for _, band in found[1:])
