"""A third of all visits on one order, patient, doctor, diagnosis and FactID: the spread load gives the same warehouse."""

import pytest
from pyspark.sql import functions as F

from asterlap.plans import dims, fact, rejects


@pytest.fixture(scope="module")
def hot_visits(spark):
    n = 6000
    hot = F.col("id") % 3 == 0
    pick = lambda modulus, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(modulus)) + 1
    return spark.range(n).select(
        F.when(hot, 1).otherwise(F.col("id")).alias("FactID"),
        F.when(hot, 20240101).otherwise(20240101 + F.col("id") % 40).cast("int").alias("DateID"),
        F.when(hot, 1).when(F.col("id") % 101 == 0, None).otherwise(pick(300, 1)).alias("PatientID"),
        F.when(hot, 2).otherwise(pick(90, 2)).alias("DoctorID"),
        F.when(hot, 3).otherwise(pick(80, 3)).alias("DiagnosisID"),
        (F.col("id") % 3 + 1).cast("int").alias("VisitTypeID"),
        F.when(F.col("id") % 17 == 0, "n/a").otherwise((F.col("id") % 90).cast("string")).alias("ServiceCostText"),
        F.lit(1).alias("VisitCount"), F.lit("1,25").alias("ProfitText"), F.lit(1).alias("PatientCount"),
        F.lit("0").alias("RepeatRateText"), F.lit("1").alias("AvgTreatmentCostText"),
        (F.col("id") + 1).alias("VisitKey"),
    ).cache()


@pytest.fixture(scope="module")
def dimensions(spark):
    raw = {
        "patient": spark.range(250).selectExpr("id AS PatientID", "concat('p', id) AS FullName", "int(id % 90) AS Age", "'1' AS Phone"),
        "doctor": spark.range(60).selectExpr("id AS DoctorID", "concat('d', id) AS FullName", "'Terapevt' AS Specialty"),
        "diagnosis": spark.range(70).selectExpr("id AS DiagnosisID", "'K02' AS ICDCode", "concat('g', id) AS DiagnosisName", "'t' AS TreatmentMethod"),
        "date": spark.range(31).selectExpr("int(20240101 + id) AS DateID", "int(id + 1) AS Day", "1 AS Month", "2024 AS Year", "'x' AS WeekDay"),
        "visit_type": spark.range(3).selectExpr("int(id + 1) AS VisitTypeID", "'v' AS VisitName", "'PR' AS VisitCode"),
    }
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return {
        name: dims.load_dimension(name, dims.empty_dimension(spark, name), df.filter(F.col(df.columns[0]) > 0), now, 1).cache()
        for name, df in raw.items()
    }


def test_spread_load_equals_broadcast_load(hot_visits, dimensions, rows):
    normalised, loaded = fact.normalise_visits(hot_visits), F.lit("2024-01-01").cast("timestamp")
    spread = fact.wide_visits(fact.resolve_visits(normalised, dimensions, broadcast_rows=0), 1, loaded)
    broadcast = fact.wide_visits(fact.resolve_visits(normalised, dimensions), 1, loaded)
    assert rows(spread) == rows(broadcast)
    assert spread.count() == hot_visits.count()


def test_hot_fact_id_is_vouched_for_once(hot_visits, rows, monkeypatch):
    monkeypatch.setattr(rejects, "BROADCAST_ROWS", 0)
    readable = hot_visits.filter("ServiceCostText <> 'n/a'").select("FactID").distinct()
    expected = hot_visits.filter("ServiceCostText = 'n/a'").join(readable, "FactID", "left_anti")
    assert rejects.visits(hot_visits).count() == expected.count() > 0
