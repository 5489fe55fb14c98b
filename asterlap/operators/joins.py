"""Lookups of a large table in a table that is unique on the key, safe for hot keys."""

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 50_000
# A larger table is still broadcast, up to ten times that size, where it saves shuffling this many rows for each of its own.
ROWS_SAVED = 100
# A key is hot when it holds more than this many even shares of a shuffle.
HOT_SHARES = 2
SKETCH_GROUPS = 64
MAX_TRACKED = 1_000_000


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads a few partitions at a time, until that is known."""
    return not df.select(F.lit(1)).offset(max_rows).head(1)


def worth_broadcasting(df: DataFrame, facts: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` is small, or bounded and tiny beside ``facts``. The second bound is a ratio, so a table that grows with
    the facts is joined the same way at every size, until it reaches the first."""
    few = BROADCAST_ROWS if max_rows is None else max_rows
    if fits(df, few):
        return True
    return fits(df, 10 * few) and df.count() * ROWS_SAVED <= facts.count()


def _salts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, columns: list[str], share: float | None = None) -> dict[str, dict]:
    """Keys holding more than ``share`` of the rows, with their share, found for all columns in one pass.

    By default the share follows from the number of shuffle partitions, so that no key left alone is much more than
    what a task gets anyway. Each task keeps a fixed-size sketch per column; the sketches are merged by groups of
    tasks, and the leading keys of each group are added up. What reaches the driver is bounded by the numbers of
    groups and of partitions, not by the data. The answer only chooses how rows are spread; it never changes a result.
    Rows without a key count as the key None, which is listed last.
    """
    share = share or min(0.5, HOT_SHARES / _salts(df))
    k = math.ceil(1 / share)
    tracked = min(10 * k, MAX_TRACKED)
    leaders = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.expr(f"approx_top_k(`{c}`, {k}, {tracked})").alias(c) for c in columns],
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)],
    ).collect()
    total = sum(row["_n"] for row in leaders)
    found = {}
    for i, c in enumerate(columns):
        counted = Counter()
        for row in leaders:
            counted.update({entry["item"]: entry["count"] for entry in row[c] if entry["item"] is not None})
        counted[None] = sum(row[f"_null_{i}"] for row in leaders)
        found[c] = {key: rows / total for key, rows in counted.items() if rows > share * total}
    return found


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread: Column | str,
    hot: dict | None = None,
    how: str = "left",
    broadcast: bool | None = None,
    strategy: str = "shuffle_hash",
) -> DataFrame:
    """Join ``facts`` to ``dimension`` (unique on ``key``) without gathering a hot key in one task.

    A dimension of a checked size is broadcast; ``broadcast`` hands in a check already made. Otherwise both sides
    are shuffled and the dimension's rows of a partition are hashed, so that the facts are neither sorted nor spilled
    (``strategy`` "merge" sorts them by the key instead, which pays where narrow rows are stored next). When
    ``hot_keys`` found none, they are shuffled on the key alone and carry nothing more. Else, or when ``hot`` is not
    known, on (key, salt): rows of the ``hot`` keys take one of as many salts as the key has even shares of the
    rows, and rows without a key one of all, derived from ``spread``; the dimension rows of the hot keys are copied
    once per salt of theirs, twice the number of partitions in all at most.
    ``spread`` must give the same value when a task is run again, such as a stored row number.
    """
    if fits(dimension, BROADCAST_ROWS) if broadcast is None else broadcast:
        return facts.join(F.broadcast(dimension), key, how)
    if hot == {}:
        return facts.join(dimension.hint(strategy), key, how)
    salts = _salts(facts)
    spread = F.col(spread) if isinstance(spread, str) else spread
    own = F.lit(1)
    if hot:
        needed = [(k, min(salts, math.ceil(share * salts))) for k, share in hot.items() if k is not None]
        known = facts.sparkSession.createDataFrame(needed, T.StructType([T.StructField("_hot", facts.schema[key].dataType), T.StructField("_salts", T.IntegerType())]))
        dimension = dimension.join(F.broadcast(known), F.col(key) == F.col("_hot"), "left").drop("_hot")
        facts = facts.join(F.broadcast(known), F.col(key) == F.col("_hot"), "left").drop("_hot")
        own = F.coalesce("_salts", F.lit(1))
    salt = F.pmod(F.xxhash64(spread), F.when(F.col(key).isNull(), salts).otherwise(own)).cast("int")
    salted_facts = facts.withColumn("_salt", salt).drop("_salts")
    salted_dimension = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), own - 1))).drop("_salts")
    return salted_facts.join(salted_dimension.hint(strategy), [key, "_salt"], how).drop("_salt")
