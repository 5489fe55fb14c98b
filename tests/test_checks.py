"""Validators, reject rules and data-quality rules on small tables."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from asterlap.operators import audit, quality, validate
from asterlap.plans import fact, rejects
from asterlap.schemas import STAGING


def test_duplicated_keys(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(validate.duplicated_keys(df, ["k"])) == [(1, 2), (None, 2)]


def test_duplicated_keys_of_a_large_table(spark, rows, monkeypatch):
    """Partitions follow from the number of rows, however few bytes their keys have; a third of the rows is one key."""
    key = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") < 3900, F.col("id"))
    df = spark.range(0, 4000, 1, 4).select(key.alias("k"))
    assert validate.duplicated_keys(df, ["k"]).rdd.getNumPartitions() < 40
    monkeypatch.setattr(validate, "ROWS_PER_TASK", 100)
    found = validate.duplicated_keys(df, ["k"])
    assert rows(found) == [(-1, 1334), (None, 66)]
    assert found.rdd.getNumPartitions() == 40


def test_orphans_ignore_null(spark, rows):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    assert rows(validate.orphans(child, "c", parent, "p")) == [(7, 2)]


def test_null_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(validate.null_counts(df, ["a", "b"])) == [("a", 1), ("b", 2)]


def test_key_policy_reports_and_stops(spark, rows):
    child = spark.createDataFrame([(1, "a"), (7, "b"), (7, None)], "k int, m string")
    parents = {"k": (spark.createDataFrame([(1,), (1,), (None,)], "p int"), "p"), "m": (spark.createDataFrame([("a",)], "q string"), "q")}
    found = [("k", "KeyDuplicate", "1", 2), ("k", "KeyNotFound", "7", 2), ("k", "NullKey", None, 1), ("m", "KeyNotFound", "b", 1)]
    assert rows(validate.key_policy(child, parents)) == found
    with pytest.raises(validate.KeyPolicyError, match="4 keys") as raised:
        validate.require_key_policy(child, parents)
    assert rows(raised.value.report) == found
    validate.require_key_policy(child.filter("k = 1"), {"k": (parents["k"][0].limit(1), "p"), "m": parents["m"]})


def test_orphans_of_all_references_in_one_pass(spark, rows):
    child = spark.createDataFrame([(1, 5), (7, 5), (7, None), (None, 6)], "a int, b bigint")
    parents = {"a": (spark.createDataFrame([(1,), (None,)], "x int"), "x"), "b": (spark.createDataFrame([(6,)], "y bigint"), "y")}
    found = validate.orphans_of_all(child, parents)
    assert rows(found) == [("a", "7", 2), ("b", "5", 2)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 3  # the child once, each parent once


VERSIONS = "k bigint, ID bigint, EffectiveFrom timestamp, EffectiveTo timestamp, IsCurrent boolean"


def test_versions_that_overlap(spark, rows):
    day = lambda n: datetime(2024, 1, n)
    history = [
        (1, 1, day(1), day(5), False), (2, 1, day(6), day(9), True),  # in order
        (3, 2, day(1), day(6), False), (4, 2, day(6), day(9), True),  # the second begins as the first ends
        (5, 3, day(1), day(9), True), (6, 3, day(2), day(3), True),
        (7, 4, day(1), day(9), False), (8, None, day(1), day(2), True),
    ]
    found = validate.version_faults("t", spark.createDataFrame(history, VERSIONS), "ID", "k")
    assert rows(found, "ErrorType", "KeyValue", "KeyRows") == [
        ("not one current version", "3", 2), ("not one current version", "4", 0), ("overlap", "2", 1), ("overlap", "3", 1),
    ]


def test_duplicates_of_all_declared_keys(spark, rows):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 2)), (None, None), (None, None)], "a int, t timestamp")
    found = validate.duplicates_of_all([("x", df, ["a"]), ("x", df, ["a", "t"])])
    assert rows(found, "KeyName", "KeyValue", "KeyRows") == [("a", "", 2), ("a", "1", 3), ("a+t", "1|2024-01-01 00:00:00", 2), ("a+t", "|", 2)]


TEXT_VISITS = ", ".join(f"{c} string" for c in STAGING["visits"].names)
GOOD_VISIT = ("5", "1", "1", "1", " 1 ", "1", "1,5", "1", "-2.25", "1", "0", None)


@pytest.mark.parametrize("column,value,named", [
    ("VisitCount", "x", "FactID 5: VisitCount is not a number: x"), ("DateID", None, "FactID 5: DateID is not a number: <NULL>"),
    ("ProfitText", "n/a", "FactID 5: ProfitText is not a number: n/a"), ("FactID", "", "FactID : FactID is not a number: "),
])
def test_strict_reading_names_row_and_column(spark, column, value, named):
    place = STAGING["visits"].names.index(column)
    bad = GOOD_VISIT[:place] + (value,) + GOOD_VISIT[place + 1 :]
    with pytest.raises(PySparkException, match=named):
        fact.strict_visits(spark.createDataFrame([GOOD_VISIT, bad], TEXT_VISITS)).collect()


def test_strict_reading_of_a_clean_delivery(spark, rows):
    read = fact.strict_visits(spark.createDataFrame([GOOD_VISIT], TEXT_VISITS))
    assert rows(read) == [(5, 1, 1, 1, 1, 1, D("1.50"), 1, D("-2.25"), 1, D("0.0000"), None)]


def raw_visits(spark, values):
    """Visits from (key, FactID, cost, profit, rate, average)."""
    rows = [(f, 1, 1, 1, 1, 1, c, 1, p, 1, r, a, k) for k, f, c, p, r, a in values]
    return spark.createDataFrame(rows, ", ".join(
        f"{x.name} {x.dataType.simpleString()}" for x in STAGING["visits"].fields) + ", VisitKey bigint")


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_reject_visits(spark, rows, monkeypatch, broadcast_rows):
    """A bad row beside a good one of its FactID is kept; a bad rate alone is no reason."""
    monkeypatch.setattr(rejects, "BROADCAST_ROWS", broadcast_rows)
    raw = raw_visits(spark, [
        (1, 10, "1,5", "1", "0", "1"), (2, 10, "n/a", "1", "0", "1"), (3, 11, "n/a", "1", "x", None),
        (4, 12, "1", "1", "bad", "1"), (5, None, "1", "1", "0", "1"), (6, 11, "1", None, "0", "1"),
    ])
    assert rows(rejects.visits(raw), "BusinessKey", "Payload") == [
        ("11", "ServiceCost=1; Profit=<NULL>; RepeatRate=0"),
        ("11", "ServiceCost=n/a; Profit=1; RepeatRate=x"),
        (None, "ServiceCost=1; Profit=1; RepeatRate=0"),
    ]


def test_reject_patients_after_removing_copies(spark, rows):
    raw = spark.createDataFrame(
        [(1, "  ", 5, None), (1, " ", 5, None), (2, "Bo", 121, None), (3, None, None, None), (4, "Al", 120, None)],
        "PatientID bigint, FullName string, Age int, Phone string",
    )
    assert rows(rejects.patients(raw), "BusinessKey", "Payload") == [
        ("1", "FullName=; Age=5"), ("2", "FullName=Bo; Age=121"), ("3", "FullName=<NULL>; Age=<NULL>"),
    ]


def test_reject_dates(spark, rows):
    raw = spark.createDataFrame(
        [(1, 44, 12, 2025, "sreda"), (2, 1, 12, 2025, None), (None, 1, 1, 2025, "x"), (4, None, 1, 2025, "x")],
        "DateID int, Day int, Month int, Year int, WeekDay string",
    )
    assert rows(rejects.dates(raw), "BusinessKey", "Payload") == [
        ("1", "Day=44; Month=12; Year=2025; WeekDay=sreda"),
        ("4", "Day=<NULL>; Month=1; Year=2025; WeekDay=x"),
        (None, "Day=1; Month=1; Year=2025; WeekDay=x"),
    ]


def test_reject_diagnoses_and_doctors(spark, rows):
    diagnoses = spark.createDataFrame(
        [(1, None, " ", "t"), (2, None, "name", "t")],
        "DiagnosisID bigint, ICDCode string, DiagnosisName string, TreatmentMethod string",
    )
    assert rows(rejects.diagnoses(diagnoses), "BusinessKey", "Payload") == [("1", "ICDCode=<NULL>; DiagnosisName= ")]
    doctors = spark.createDataFrame([(None, "a", None), (2, "b", None)], "DoctorID bigint, FullName string, Specialty string")
    assert rows(rejects.doctors(doctors), "BusinessKey", "Payload") == [(None, "FullName=a; Specialty=<NULL>")]


def test_wrong_weekday(spark, rows):
    dates = spark.createDataFrame(
        [(1, date(2024, 1, 1), "PONEDELNIK"), (2, date(2024, 1, 1), "sreda"), (3, None, "x"), (4, date(2024, 1, 2), None)],
        "DateID int, FullDate date, WeekDayName string",
    )
    assert [k for k, in rows(quality.wrong_weekday(dates), "EntityKey")] == ["2", "4"]


def test_shared_phone_counts_current_patients_only(spark, rows):
    patients = spark.createDataFrame(
        [("1", True), ("1", True), ("2", True), ("2", False), ("", True), ("", True), (None, True), (None, True)],
        "PhoneNormalized string, IsCurrent boolean",
    )
    assert rows(quality.shared_phone(patients), "EntityKey") == [("1",)]


def test_fact_rules(spark, rows):
    fact = spark.createDataFrame(
        [(1, D("-0.0001"), D("0"), D("1.00"), D("1.01")), (2, D("0"), D("1.0001"), D("1.00"), D("1.02")),
         (3, None, D("-0.1"), D("1.00"), D("1.00")), (4, D("5"), D("1"), D("1.00"), D("0.99"))],
        "FactID bigint, MarginPercent decimal(9,4), RepeatRate decimal(9,4), ServiceCost decimal(18,2), "
        "AvgTreatmentCost decimal(18,2)",
    )
    assert rows(quality.fact_rule(fact, "NEGATIVE_MARGIN"), "EntityKey") == [("1",)]
    assert rows(quality.fact_rule(fact, "REPEAT_RATE_RANGE"), "EntityKey") == [("2",), ("3",)]
    assert rows(quality.fact_rule(fact, "AVG_CHECK_GAP"), "EntityKey") == [("2",)]
    apart = [r for rule in quality.FACT_RULES for r in rows(quality.fact_rule(fact, rule))]
    assert rows(quality.fact_rules(fact)) == sorted(apart)


def test_missing_reference_text_shows_null_as_empty(spark, rows):
    visits = spark.createDataFrame(
        [(5, 1, None, 3, 4, 5)],
        "FactID bigint, DateID int, PatientID bigint, DoctorID bigint, DiagnosisID bigint, VisitTypeID int",
    )
    (text,), = rows(quality.missing_references(visits), "IssueDescription")
    assert text == (
        "Otsutstvuet izmerenie dlya fakta. DateID=1, PatientID=, DoctorID=3, DiagnosisID=4, VisitTypeID=5"
    )


def test_close_issues(spark, rows):
    issues = spark.createDataFrame([("A", False), ("B", False), ("B", True)], "RuleCode string, IsResolved boolean")
    assert rows(quality.close_issues(issues, "A")) == [("A", True), ("B", False), ("B", True)]
    assert rows(quality.close_issues(issues)) == [("A", True), ("B", True), ("B", True)]


def test_measure_catalog_names_the_seven_measures(spark):
    assert audit.measure_catalog(spark).count() == 7
