"""Batch audit: batches, log lines, row counts."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import literals as L
from ..schemas import BATCH, LOG

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"


def start_batch(spark: SparkSession, batch_id: int, name: str, now: datetime, initiator: str) -> DataFrame:
    row = (batch_id, name, "CSV", now, None, STARTED, 0, 0, 0, initiator, None)
    return spark.createDataFrame([row], BATCH)


def finish_batch(
    batches: DataFrame, batch_id: int, status: str, now: datetime, rows_read: int | None = None,
    rows_loaded: int | None = None, rows_rejected: int | None = None, comment: str | None = None,
) -> DataFrame:
    """Closes a batch; a count or comment that is not given keeps its value."""
    given = {
        "FinishedAt": now, "Status": status, "RowsRead": rows_read, "RowsLoaded": rows_loaded,
        "RowsRejected": rows_rejected, "CommentText": comment,
    }
    mine = F.col("BatchID") == batch_id
    types = {f.name: f.dataType for f in BATCH.fields}
    return batches.withColumns({
        c: F.when(mine, F.lit(v).cast(types[c])).otherwise(F.col(c)) for c, v in given.items() if v is not None
    })


def log_line(
    spark: SparkSession, batch_id: int | None, procedure: str, level: str, step: str, message: str,
    affected_rows: int | None, now: datetime,
) -> DataFrame:
    return spark.createDataFrame([(batch_id, procedure, level, step, message, affected_rows, now)], LOG)


def batch_status(batches: DataFrame) -> DataFrame:
    """Batches with their duration."""
    seconds = F.unix_timestamp("FinishedAt") - F.unix_timestamp("StartedAt")
    return batches.select(
        "BatchID", "BatchName", "SourceSystem", "StartedAt", "FinishedAt", "Status",
        "RowsRead", "RowsLoaded", "RowsRejected", seconds.cast("int").alias("DurationSeconds"),
        "Initiator", "CommentText",
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("RowQty")).select(F.lit(name).alias("ObjectName"), "RowQty")
        for name, df in tables.items()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


def loaded_members(name: str, dimension: DataFrame, surrogate_key: str) -> DataFrame:
    """Rows of a dimension a load accounts for: current ones, without the unknown member."""
    members = dimension.filter(F.col(surrogate_key) > 0)
    return members.filter("IsCurrent") if "IsCurrent" in dimension.columns else members


def count_members(columns: list[str], surrogate_key: str) -> Column:
    """The number of such rows, as an aggregate that can be observed while the dimension is written."""
    member = F.col(surrogate_key) > 0
    return F.count_if(member & F.col("IsCurrent") if "IsCurrent" in columns else member)


def batch_counts(read: DataFrame, loaded: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows read, loaded and rejected, from per-table counts."""
    def total(counts: DataFrame) -> Column:
        return counts.agg(F.sum("RowQty")).scalar()

    return read.agg(F.sum("RowQty").alias("RowsRead")).select(
        "RowsRead", total(loaded).alias("RowsLoaded"), total(rejected).alias("RowsRejected")
    )


def measure_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(L.MEASURES.items()), "MeasureName string, MeasureDescription string")
