from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from asterlap.functions import cleaning as C


def one_column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_age_band_edges(spark):
    ages = [None, -3, 0, 17, 18, 25, 26, 35, 36, 45, 46, 60, 61, 130]
    assert one_column(spark, ages, "int", C.age_band) == [
        "Ne opredeleno", "Do 18 let", "Do 18 let", "Do 18 let", "18-25", "18-25", "26-35", "26-35", "36-45", "36-45",
        "46-60", "46-60", "60+", "60+",
    ]


def test_age_is_valid(spark):
    assert one_column(spark, [None, -1, 0, 120, 121], "int", C.age_is_valid) == [True, False, True, True, False]


def test_phone_digits(spark):
    assert one_column(spark, [" +7 90-00 ", "", None], "string", C.phone_digits) == ["79000", "", None]


def test_specialty_group_tests_the_untrimmed_value(spark):
    found = one_column(spark, ["Terapevt", " Terapevt", "Ortodont", "Other", None], "string", C.specialty_group)
    assert found == ["Lechebnyy personal", "Prochee", "Vosstanovitelnaya stomatologiya", "Prochee", "Prochee"]


def test_diagnosis_class_by_prefix(spark):
    found = one_column(spark, ["K02.1", "K11", "K13.9", "K10.0", "k02", "К02.1", None], "string", C.diagnosis_class)
    assert found == [
        "Karioznye porazheniya", "Zabolevaniya slizistoy i slyunnykh zhelez",
        "Zabolevaniya slizistoy i slyunnykh zhelez", "Prochie diagnozy", "Prochie diagnozy", "Prochie diagnozy",
        "Prochie diagnozy",
    ]


def test_visit_category_ignores_case_and_blanks(spark):
    found = one_column(spark, [" pr ", "PRI", "sec", "SC", "x", None], "string", C.visit_category)
    assert found == ["Pervichnyy vizit", "Pervichnyy vizit", "Povtornyy vizit", "Povtornyy vizit",
                     "Inoy stsenariy", "Inoy stsenariy"]


def test_calendar_date_rejects_impossible_days(spark):
    df = spark.createDataFrame(
        [(2024, 2, 29), (2023, 2, 29), (2024, 13, 1), (2024, 1, 44), (2024, 108, 1), (None, 1, 1), (2024, 1, 0)],
        "y int, m int, d int",
    )
    found = [r[0] for r in df.select(C.calendar_date(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert found == [date(2024, 2, 29), None, None, None, None, None, None]


def test_weekend_and_weekday_name(spark):
    days = [date(1900, 1, 1), date(2024, 1, 6), date(2024, 1, 7), None]
    assert one_column(spark, days, "date", C.is_weekend) == [False, True, True, False]
    assert one_column(spark, days, "date", C.weekday_name) == ["ponedelnik", "subbota", "voskresene", None]


def test_december_is_autumn(spark):
    found = one_column(spark, [1, 3, 6, 9, 12, None, 13], "int", C.academic_period)
    assert found == ["Zima", "Vesna", "Leto", "Osen", "Osen", "Ne opredeleno", "Ne opredeleno"]


def test_margin_percent(spark):
    df = spark.createDataFrame(
        [(D("3.00"), D("1.00")), (D("0.00"), D("5.00")), (None, D("5.00")), (D("2.00"), None), (D("2.00"), D("-1.00"))],
        "c decimal(18,2), p decimal(18,2)",
    )
    found = [r[0] for r in df.select(C.margin_percent(F.col("c"), F.col("p"))).collect()]
    assert found == [D("33.3333"), D("0.0000"), D("0.0000"), None, D("-50.0000")]


def test_numbers_lenient_and_strict(spark):
    texts = ["1519,1", "7.005", "n/a", "", None]
    assert one_column(spark, texts, "string", lambda c: C.parse_number(c, C.MONEY)) == [
        D("1519.10"), D("7.01"), None, None, None,
    ]
    assert one_column(spark, texts[:2], "string", lambda c: C.parse_number_strict(c, C.MONEY)) == [D("1519.10"), D("7.01")]
    with pytest.raises(PySparkException):
        one_column(spark, texts, "string", lambda c: C.parse_number_strict(c, C.MONEY))
