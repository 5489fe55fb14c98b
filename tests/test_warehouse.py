"""Stored tables: written once per session, built anew when the input folder changes."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from asterlap.plans import registry
from asterlap.plans.warehouse import Warehouse
from asterlap.sources.binding import INPUTS


@pytest.fixture
def folder(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in INPUTS:
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_rewritten_folder_is_loaded_anew(spark, folder):
    query = registry.queries()["q01_kpi_totals"]
    before = query(spark, folder).first()["FactRowQty"]
    assert registry.warehouse(spark, folder) is registry.warehouse(spark, folder)
    fewer = spark.read.parquet(f"{folder}/lineitem.parquet").filter("l_linenumber <> 1").cache()
    assert 0 < fewer.count() < before
    fewer.write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    assert query(spark, folder).first()["FactRowQty"] == fewer.count()


def test_table_is_built_once_for_many_callers(spark, tmp_path):
    built = []

    def doctors():
        built.append(1)
        return spark.createDataFrame([(1, "Ann", "Terapevt")], "DoctorID bigint, FullName string, Specialty string")

    wh = Warehouse(spark, {"doctors": doctors}, str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda _: wh.dimension("doctor"), range(4)))
    assert len(built) == 1 and {t.count() for t in tables} == {2}


def test_stored_visits_are_narrowed_to_what_a_query_reads(spark, folder):
    """Column pruning and filters reach the files of the wide table."""
    plan = registry.queries()["q14_dice"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "IsNotNull(AcademicPeriod)" in plan
    assert "ReadSchema: struct<AcademicPeriod:string,Specialty:string,ServiceCostUnits:bigint,ProfitUnits:bigint>" in plan


def scanned_rows(df):
    """Rows that the scans of an executed plan returned, the largest first."""
    found = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return sorted(found, reverse=True)


def test_stored_visits_are_skipped_by_what_a_query_picks(spark, folder):
    """Rows of a kind of visit, a season and a doctor lie together, so readers pass over other pages."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.setInt("parquet.page.row.count.limit", 20)
    try:
        queries, visits = registry.queries(), registry.warehouse(spark, folder).wide().count()
    finally:
        hadoop.unset("parquet.page.row.count.limit")
    for name in ("q12_slice_primary", "q13_slice_repeat", "q14_dice", "q58_drill_through_doctor"):
        assert 0 < scanned_rows(queries[name](spark, folder))[0] < 0.75 * visits, name
