"""Times the load of a warehouse and the seventy queries on it; prints one JSON line.

BENCH_SF_DIR names the folder of input tables, BENCH_CPUS the number of local cores. Every result is computed in
full (written to Spark's no-op sink), on tables stored by the load.
"""

import json
import os
import sys
import time
from functools import partial

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from asterlap.plans import registry  # noqa: E402
from asterlap.plans.queries import QUERIES  # noqa: E402

LOADED = ["stg_visits", "visit", "doctor_performance", "diagnosis_performance", "patient_segment", "time_series"]
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, float] = {}
    wh = registry.warehouse(spark, folder)
    steps = {"dimensions": wh.dimensions} | {name: partial(wh.table, name) for name in LOADED}
    for name, load in steps.items():
        start = time.perf_counter()
        load()
        times[f"load_{name}"] = round(time.perf_counter() - start, 3)
    for name, query in QUERIES.items():
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            query(wh).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            best = seconds if best is None else min(best, seconds)
        times[name] = round(best, 3)
    rows = wh.wide().count()
    print(json.dumps({
        "metric": "warehouse load plus 70 analytic queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "load_sec": round(sum(t for n, t in times.items() if n.startswith("load_")), 3),
        "query_sec": round(sum(t for n, t in times.items() if not n.startswith("load_")), 3),
        "fact_rows": rows,
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
