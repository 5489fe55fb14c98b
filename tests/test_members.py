"""Totals per member: the same rows whether they are combined map-side or spread by the key."""

from decimal import ROUND_HALF_UP, localcontext
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from asterlap.functions import measures
from asterlap.operators.members import member_totals
from asterlap.plans import fact
from asterlap.schemas import STAGING
from asterlap.sources import delimited, sinks


@pytest.fixture(scope="module")
def visits(spark):
    """Members 1 to 300, the hot member 7, unknown ones and missing keys."""
    row = F.col("id")
    key = F.when(row % 3 == 0, 7).when(row % 10 == 1, 0).when(row % 10 == 2, F.lit(None)).otherwise(row % 300 + 1)
    rows = spark.range(5000).select(key.cast("int").alias("ID"), (row % 4).alias("Month"), row.alias("Units"))
    return rows.withColumn("Name", F.when(F.col("ID") == 0, "unknown").otherwise(F.concat(F.lit("name "), F.col("ID") % 50)))


@pytest.fixture(scope="module")
def members(spark):
    return spark.range(1, 400).select(F.col("id").cast("int").alias("ID"), F.concat(F.lit("name "), F.col("id") % 50).alias("Name"))


def totals():
    return [F.sum("Units").alias("Total"), F.count(F.lit(1)).alias("N")]


@pytest.mark.parametrize("attributes,periods", [(["Name"], ["Month"]), (["Name"], []), ([], ["Month"])])
def test_spread_totals_are_the_combined_ones(visits, members, rows, attributes, periods):
    expected = rows(visits.groupBy("ID", *attributes, *periods).agg(*totals()))
    for few in (0, 50_000):
        assert rows(member_totals(visits, "ID", attributes, periods, totals(), members, few=few)) == expected


def test_texts_are_not_shuffled(visits, members):
    plan = member_totals(visits, "ID", ["Name"], ["Month"], totals(), members, few=0)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):].split("\n")[1]
    assert "AS ID#" in below and "Name" not in below


def test_months_of_many_members(spark, rows):
    wide = spark.range(2000).selectExpr(
        "cast(id % 90 as bigint) DiagnosisKey", "cast(2020 + id % 2 as int) Year", "cast(id % 12 as int) Month", "1 VisitCount", "id ServiceCostUnits",
        "id - 5 ProfitUnits", "id % 2 * 10000 RepeatRateUnits", "timestamp'2024-01-01' LoadedAt")
    members = wide.select("DiagnosisKey").distinct()
    assert fact.diagnosis_months(wide, members).columns == fact.diagnosis_months(wide).columns
    assert rows(fact.diagnosis_months(wide, members)) == rows(fact.diagnosis_months(wide))


def test_exported_files_are_compressed(spark, tmp_path, rows):
    doctors = spark.range(2000).selectExpr("cast(id as int) DoctorID", "concat('doctor ', id) FullName", "'Khirurg' Specialty")
    sinks.write_delimited(doctors, str(tmp_path / "d.csv"))
    size = sum(p.stat().st_size for p in (tmp_path / "d.csv").glob("part-*"))
    assert size < 0.5 * sum(len(f"{i};doctor {i};Khirurg\n") for i in range(2000))
    assert rows(delimited.read_delimited(spark, str(tmp_path / "d.csv"), STAGING["doctors"])) == rows(doctors)


def test_means_and_totals_follow_the_decimals_digits(spark):
    """Long integers or decimals, few rows or huge totals: four more digits, half up, then those of the type."""
    groups = [[5, 4, 0], [1, 2], [-1, 0, 0], [-1, 0], [10**17, 10**17 + 1], [-(10**17), 1, 0], [None, 7, None], [50_000_000 * 10**6, 999_999], [None]]
    rows = [(g, v, v) for g, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(rows, "g int, ProfitUnits long, RepeatRateUnits long").groupBy("g")
    got = {r.g: r for r in df.agg(
        measures.visit_amount("Profit", "total"), measures.visit_mean("Profit", "decimal(28,2)", "mean"), measures.visit_mean("RepeatRate", "decimal(28,8)", "rate"),
    ).collect()}
    with localcontext() as exact:
        exact.prec = 60
        for g, values in enumerate(groups):
            known = [v for v in values if v is not None]
            if not known:
                assert tuple(got[g])[1:] == (None, None, None)
                continue
            mean = (D(sum(known)) / 100 / len(values)).quantize(D("1e-6"), ROUND_HALF_UP).quantize(D("0.01"), ROUND_HALF_UP)
            rate = (D(sum(known)) / 10_000 / len(values)).quantize(D("1e-8"), ROUND_HALF_UP)
            assert (got[g].total, got[g].mean, got[g].rate) == (D(sum(known)) / 100, mean, rate), g
