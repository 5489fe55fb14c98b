"""Binds the driver's tables to the staging schemas, dirty values included."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..literals import WEEKDAYS
from ..operators.joins import hot_keys, lookup
from ..schemas import STAGING

INPUTS = ("customer", "supplier", "part", "orders", "lineitem")

# Specialty by nation number modulo 5, ICD prefix by kind of part.
SPECIALTIES = ["Terapevt", "Khirurg", "Ortoped", "Ortodont", "Rentgenolog"]
ICD_PREFIXES = {
    "ECONOMY": "K02", "SMALL": "K04", "MEDIUM": "K05", "PROMO": "K07", "STANDARD": "K08", "LARGE": "K12",
}


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGING[table].fields])


def _date_id(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("int")


def _with_comma(number: Column) -> Column:
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))


def patients(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    phone_number = F.when(key % 40 == 0, key + 1).otherwise(key).cast("string")
    return _conform(
        customer.select(
            (key + 1).alias("PatientID"),
            F.when(key % 83 == 0, "   ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("FullName"),
            F.when(key % 50 != 7, (key * 37) % 131 - 5).alias("Age"),
            F.concat(F.lit("+7 9"), F.lpad(phone_number, 7, "0"), F.lit("-0")).alias("Phone"),
        ),
        "patients",
    )


def doctors(supplier: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(name) for name in SPECIALTIES])
    return _conform(
        supplier.select(
            (F.col("s_suppkey") + 1).alias("DoctorID"),
            F.col("s_name").alias("FullName"),
            F.get(names, (F.col("s_nationkey") % 5).cast("int")).alias("Specialty"),
        ),
        "doctors",
    )


def diagnoses(part: DataFrame) -> DataFrame:
    prefix = F.when(F.col("p_size") % 10 == 0, "K10")
    for kind, code in ICD_PREFIXES.items():
        prefix = prefix.when(F.col("p_type") == kind, code)
    return _conform(
        part.select(
            (F.col("p_partkey") + 1).alias("DiagnosisID"),
            F.concat(prefix, F.lit("."), F.col("p_size").cast("string")).alias("ICDCode"),
            F.when(F.col("p_partkey") % 89 == 0, " ").otherwise(F.col("p_name")).alias("DiagnosisName"),
            F.col("p_brand").alias("TreatmentMethod"),
        ),
        "diagnoses",
    )


def visit_types(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return _conform(
        lineitem.select(flag).distinct().select(
            F.when(flag == "N", 1).when(flag == "R", 2).when(flag == "A", 3).alias("VisitTypeID"),
            F.when(flag == "N", "Primary").when(flag == "R", "Secondary").when(flag == "A", "Other").alias("VisitName"),
            F.when(flag == "N", " pr ").when(flag == "R", "SC").when(flag == "A", "XX").alias("VisitCode"),
        ),
        "visit_types",
    )


def dates(orders: DataFrame) -> DataFrame:
    day = F.col("_day")
    date_id = _date_id(day)
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return _conform(
        orders.select(F.col("o_orderdate").cast("date").alias("_day")).distinct().select(
            date_id.alias("DateID"),
            F.when(date_id % 97 == 0, 44).otherwise(F.day(day)).alias("Day"),
            F.month(day).alias("Month"),
            F.year(day).alias("Year"),
            F.when(date_id % 41 == 0, WEEKDAYS[0]).otherwise(F.get(names, F.weekday(day))).alias("WeekDay"),
        ),
        "dates",
    )


def visits(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line. An order may hold a large share of the lines, so the join is spread. Its lines come
    out side by side, so that files and later shuffles of the visits compress well."""
    lines = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        # Decimals of few digits compress better on the way than doubles.
        F.col("l_extendedprice").cast("decimal(18,2)").alias("_cost"), F.col("l_discount").cast("decimal(4,2)").alias("_discount"),
        # The lines come straight from files, so a task that runs again numbers them alike.
        F.monotonically_increasing_id().alias("_line"),
    )
    heads = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    hot = hot_keys(lineitem, ["l_orderkey"])["l_orderkey"]
    joined = lookup(lines, heads, "o_orderkey", "_line", hot, how="inner", strategy="merge")

    fact_id = F.col("o_orderkey") * 10 + F.col("l_linenumber")
    cost = F.col("_cost")
    rate = F.col("_discount") * 4 - F.lit("0.05").cast("decimal(3,2)")
    profit = (cost * rate).cast("decimal(20,4)").cast("decimal(18,2)")
    visit_type = F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2).otherwise(3)
    average = F.when(fact_id % 503 == 0, (cost + 10).cast("decimal(18,2)")).otherwise(cost)
    return _conform(
        joined.select(
            fact_id.alias("FactID"),
            _date_id(F.col("o_orderdate").cast("date")).alias("DateID"),
            (F.col("o_custkey") + 1).alias("PatientID"),
            (F.col("l_suppkey") + 1).alias("DoctorID"),
            F.when(F.col("l_partkey") % 211 == 0, F.col("l_partkey") + 10000000)
            .otherwise(F.col("l_partkey") + 1).alias("DiagnosisID"),
            visit_type.alias("VisitTypeID"),
            F.when(fact_id % 401 == 0, "n/a").otherwise(_with_comma(cost)).alias("ServiceCostText"),
            F.lit(1).alias("VisitCount"),
            _with_comma(profit).alias("ProfitText"),
            F.lit(1).alias("PatientCount"),
            F.when(fact_id % 1009 == 0, "1,5").when(visit_type == 2, "1").otherwise("0").alias("RepeatRateText"),
            _with_comma(average).alias("AvgTreatmentCostText"),
        ),
        "visits",
    )


def paths(folder: str) -> list[str]:
    return [f"{folder}/{name}.parquet" for name in INPUTS]


def staging(spark: SparkSession, folder: str) -> dict:
    """Staging tables of a folder, each as a function so that only what is asked for is planned."""
    tables = {name: spark.read.parquet(path) for name, path in zip(INPUTS, paths(folder))}
    return {
        "patients": lambda: patients(tables["customer"]),
        "doctors": lambda: doctors(tables["supplier"]),
        "dates": lambda: dates(tables["orders"]),
        "visit_types": lambda: visit_types(tables["lineitem"]),
        "diagnoses": lambda: diagnoses(tables["part"]),
        "visits": lambda: visits(tables["lineitem"], tables["orders"]),
    }
