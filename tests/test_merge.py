from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from asterlap.operators.merge import dedupe, numbered, latest_version, upsert
from asterlap.plans import dims

RAW = "DoctorID bigint, FullName string, Specialty string"


def load(spark, state, raw, moment, batch):
    state = dims.empty_dimension(spark, "doctor") if state is None else state
    return dims.load_dimension("doctor", state, spark.createDataFrame(raw, RAW), F.lit(moment).cast("timestamp"), batch)


@pytest.fixture
def two_batches(spark):
    first = load(spark, None, [(1, " Ann ", "Terapevt"), (2, "Bob", None), (3, "Cy", "X")], "2024-01-01 00:00:00", 1)
    second = load(spark, first, [(1, "Ann", "Khirurg"), (2, "Bob", None), (4, "Di", "Y")], "2024-02-01 00:00:00", 2)
    return first, second


def test_first_load_has_the_unknown_member(two_batches, rows):
    first, _ = two_batches
    assert rows(first, "DoctorID", "FullName", "SpecialtyGroup", "IsCurrent") == [
        (0, "Neizvestnyy vrach", "Prochee", True),
        (1, "Ann", "Lechebnyy personal", True),
        (2, "Bob", "Prochee", True),
        (3, "Cy", "Prochee", True),
    ]
    assert rows(first, "DoctorKey") == [(0,), (1,), (2,), (3,)]
    assert rows(first.filter("DoctorID = 0"), "DoctorKey") == [(0,)]


def test_second_load_versions(two_batches, rows):
    _, second = two_batches
    assert rows(second.filter("DoctorID > 0"), "DoctorID", "EffectiveFrom", "Specialty", "EffectiveTo", "IsCurrent", "SourceBatchID") == [
        (1, datetime(2024, 1, 1), "Terapevt", datetime(2024, 1, 31, 23, 59, 59), False, 1),
        (1, datetime(2024, 2, 1), "Khirurg", datetime(9999, 12, 31), True, 2),
        (2, datetime(2024, 1, 1), None, datetime(9999, 12, 31), True, 1),
        (3, datetime(2024, 1, 1), "X", datetime(9999, 12, 31), True, 1),
        (4, datetime(2024, 2, 1), "Y", datetime(9999, 12, 31), True, 2),
    ]
    assert rows(second, "DoctorKey") == [(k,) for k in range(6)]


def test_same_batch_again_changes_nothing(spark, two_batches, rows):
    _, second = two_batches
    again = load(spark, second, [(1, "Ann", "Khirurg"), (2, "Bob", None), (4, "Di", "Y")], "2024-03-01 00:00:00", 3)
    assert rows(again) == rows(second)


def test_third_version_continues_the_key(spark, two_batches, rows):
    _, second = two_batches
    third = load(spark, second, [(1, "Ann B", "Khirurg")], "2024-03-01 00:00:00", 3)
    keys = rows(third.filter("DoctorID = 1"), "DoctorKey", "IsCurrent")
    assert [current for _, current in keys] == [False, False, True] and keys[2][0] == 6


def test_keys_have_no_cap(spark, rows):
    """Huge and negative IDs, and any number of versions before."""
    first = load(spark, None, [(2**62, "Big", "X"), (-5, "Neg", "X"), (7, "Ann", "X")], "2024-01-01 00:00:00", 1)
    assert rows(first, "DoctorKey") == [(0,), (1,), (2,), (3,)]
    moved = first.withColumn("DoctorKey", F.when(F.col("DoctorID") == 7, 65_535 * 65_536 + 65_535).otherwise(F.col("DoctorKey")))
    second = load(spark, moved, [(2**62, "Big", "Y"), (-5, "Neg", "Y"), (7, "Ann", "Y")], "2024-02-01 00:00:00", 2)
    assert second.select("DoctorKey").distinct().count() == 7 and second.filter("DoctorKey < 0").count() == 0
    assert second.filter("IsCurrent and DoctorID <> 0").agg(F.min("DoctorKey")).first()[0] == 65_536 * 65_536


def test_numbers_are_dense_over_partitions(spark, rows):
    df = spark.range(0, 1000, 1, 7).filter("id % 3 = 0 or id > 900").select(F.lit(None).cast("bigint").alias("k"), "id")
    found = numbered(df, "k", 41)
    assert rows(found, "k") == [(41 + i,) for i in range(1, df.count() + 1)]


def test_one_current_row_per_id_and_no_overlap(two_batches):
    _, second = two_batches
    current = second.filter("IsCurrent").groupBy("DoctorID").count()
    assert current.filter("count <> 1").count() == 0
    a, b = second.alias("a"), second.alias("b")
    overlap = a.join(b, "DoctorID").filter(
        "a.DoctorKey < b.DoctorKey AND a.EffectiveTo >= b.EffectiveFrom AND b.EffectiveTo >= a.EffectiveFrom"
    )
    assert overlap.count() == 0


def test_null_text_equals_empty_text(spark, rows):
    first = load(spark, None, [(1, "Ann", None)], "2024-01-01 00:00:00", 1)
    second = load(spark, first, [(1, "Ann", "")], "2024-02-01 00:00:00", 2)
    assert rows(second) == rows(first)


def test_dedupe_takes_the_smallest_row_nulls_first(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, "a", None), (2, None, 1), (2, "z", 0)], "k int, t string, n int")
    assert rows(dedupe(df, "k")) == [(1, "a", None), (2, None, 1)]


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, t string")
    assert rows(upsert(target, source, "k")) == [(1, "a"), (2, None), (3, "c")]


def test_upsert_refuses_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, t string")
    source = spark.createDataFrame([(2, "x"), (2, "y")], "k int, t string")
    with pytest.raises(PySparkException, match="duplicate k in source: 2"):
        upsert(target, source, "k").collect()


def test_latest_version(spark, two_batches, rows):
    _, second = two_batches
    source = spark.createDataFrame([(1,), (9,)], "DoctorID bigint")
    found = latest_version(second.select("DoctorKey", "DoctorID", "Specialty", "IsCurrent"), source, "DoctorID", "DoctorKey")
    assert rows(found, "DoctorID", "Specialty") == [(1, "Khirurg"), (9, None)]
    assert found.filter("DoctorKey is null").count() == 1
