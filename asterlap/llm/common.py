"""What the operators share: input tables, tables stored for a run, keys of documents, joins on uneven keys."""

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: White space of the word contracts: space and the control characters 09 to 0D. Fixed values.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that the session names."""
    return f"{shared_dir(spark)}/asterlap-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once and written to the shared folder, which also cuts their lineage."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_and_measured(df: DataFrame, name: str, files: int | None = None, **measures: Column) -> tuple[DataFrame, dict]:
    """``stored``, with aggregates of the rows that are taken while they are written; at most ``files`` files, for tables
    that are known to be small."""
    seen = Observation()
    observed = df.observe(seen, *[c.alias(n) for n, c in measures.items()])
    return stored(observed.coalesce(files) if files else observed, name), seen.get


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, what a job shuffled leaves the disk when the job ends, for jobs over the same stored rows again and again.
    Only for DataFrames that are made and run once within it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def text_of(df: DataFrame) -> Column:
    """The text, empty for null."""
    return F.coalesce(df["text"], F.lit(""))


def document_key(df: DataFrame) -> list[Column]:
    """A key by content: rows with equal keys have the same ID and text, so they also have the same result."""
    return [F.coalesce(df["doc_id"], F.lit(NO_ID)).alias("k_id"), F.xxhash64(text_of(df)).alias("k_text")]


def hot_limit(spark: SparkSession, total: int) -> float:
    """Rows beyond which a key counts as hot: a quarter of an even share of ``total``. So at most four times as many
    keys are hot as there are shuffle partitions."""
    return max(64.0, total / (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


#: Rows of both sides that one task could join, so that no key needs to be split.
FEW_ROWS = 100_000


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``left`` with the unique keys of ``right``, whose column ``count`` says how many rows of ``left``
    have the key (``total`` in all). Hot keys, of which there can only be a bounded number, are broadcast; the others
    are shuffled. Both inputs are read twice: give stored tables. Null keys don't join. FEW_ROWS are joined at once."""
    if total <= FEW_ROWS:
        return left.join(right, keys)
    hot = hot_limit(left.sparkSession, total)
    heavy = right.filter(F.col(count) > hot)
    light = right.filter(F.col(count) <= hot)
    first = left.join(F.broadcast(heavy), keys)
    rest = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys)
    return first.unionByName(rest)


def arrow_batches(spark: SparkSession, rows: int = 500, size: str = "16m") -> None:
    """Bounds the batches that Python tasks get, in rows and bytes, for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores as needed to differ from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_text(df: DataFrame) -> DataFrame:
    """doc_id and the text as UTF-8 bytes, empty for null."""
    return df.select(df["doc_id"].cast("long").alias("doc_id"), text_of(df).cast("binary").alias("text"))
