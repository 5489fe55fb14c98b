"""A loaded warehouse: each table is written to the shared folder when first asked for, and read from there on."""

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dims, fact, marts

LOAD_TIME = "2024-01-01 00:00:00"


class Warehouse:
    """Tables of one load of one set of staging tables.

    A stored table cuts the lineage: queries scan it with column pruning instead of repeating the load, and a
    lost executor costs a re-read, not a re-load. Only tables a query needs are ever built.
    """

    def __init__(
        self, spark: SparkSession, staging: Mapping[str, Callable[[], DataFrame]], root: str,
        load_time: str = LOAD_TIME, batch_id: int = 1,
    ):
        self.spark, self.staging, self.root, self.batch_id = spark, staging, root, batch_id
        self.now = F.lit(load_time).cast("timestamp")
        self._written: dict[str, DataFrame] = {}
        self._build: dict[str, Callable[[], DataFrame]] = {
            "stg_visits": self._staged_visits,
            "visit": lambda: fact.laid_out(self._resolve(fact.identified(self.normalised()))),
            "doctor_performance": lambda: marts.doctor_performance(self.visits(with_units=True), self.members("doctor")),
            "diagnosis_performance": lambda: marts.diagnosis_performance(self.visits(with_units=True), self.members("diagnosis")),
            "patient_segment": lambda: marts.patient_segment(self.visits(with_units=True), self.members("patient")),
            "time_series": lambda: marts.time_series(self.visits(with_units=True)),
        } | {f"dim_{name}": partial(self._dimension, name) for name in dims.STAGED}
        # Two callers asking for the same missing table must not write it twice.
        self._locks = {name: Lock() for name in self._build}

    def table(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._written:
                path = f"{self.root}/{name}"
                built = self._build[name]()
                built.write.mode("overwrite").option("compression", "zstd").parquet(path)
                self._written[name] = self.spark.read.schema(built.schema).parquet(path)
            return self._written[name]

    def raw(self, name: str) -> DataFrame:
        """A staging table as delivered; the visits come numbered, from their stored copy."""
        return self.table("stg_visits") if name == "visits" else self.staging[name]()

    def dimension(self, name: str) -> DataFrame:
        return self.table(f"dim_{name}")

    def dimensions(self) -> dict[str, DataFrame]:
        """All dimensions. They do not depend on each other, so missing ones are loaded side by side."""
        with ThreadPoolExecutor(len(dims.STAGED)) as pool:
            return dict(zip(dims.STAGED, pool.map(self.dimension, dims.STAGED)))

    def members(self, name: str) -> DataFrame:
        """Current members of a dimension, with the attributes that the visits carry."""
        return fact.current_members(name, self.dimension(name))

    def normalised(self) -> DataFrame:
        return fact.normalise_visits(self.raw("visits"))

    def wide(self) -> DataFrame:
        """Visits with a FactID, beside the keys and attributes of their dimensions."""
        return self.table("visit")

    def fact(self, with_units: bool = False) -> DataFrame:
        return fact.fact_visits(self.wide(), with_units)

    def visits(self, with_units: bool = False) -> DataFrame:
        return fact.visit_detailed(self.wide(), with_units)

    def _staged_visits(self) -> DataFrame:
        return self.staging["visits"]().withColumn("VisitKey", F.monotonically_increasing_id() + 1)

    def _resolve(self, visits: DataFrame) -> DataFrame:
        return fact.wide_visits(fact.resolve_visits(visits, self.dimensions()), self.batch_id, self.now)

    def unresolved(self) -> DataFrame:
        """Visits with an unknown reference, those without a FactID included."""
        nameless = self._resolve(fact.unidentified(self.normalised()))
        return fact.unresolved_visits(self.wide()).unionByName(fact.unresolved_visits(nameless))

    def _dimension(self, name: str) -> DataFrame:
        return dims.load_dimension(
            name, dims.empty_dimension(self.spark, name), self.raw(dims.STAGED[name]), self.now, self.batch_id
        )
