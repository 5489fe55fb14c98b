"""Totals per member of a dimension, without shuffling partial totals or the member's texts when there are many members."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_ROWS, fits, hot_keys
from .validate import ROWS_PER_TASK


def member_totals(
    rows: DataFrame, key: str, attributes: list[str], periods: list[str], totals: list[Column],
    members: DataFrame | None = None, few: int = BROADCAST_ROWS,
) -> DataFrame:
    """``rows`` grouped by ``key``, its ``attributes`` and ``periods``.

    ``members`` has the key once and, for every key but 0 (the unknown member's), the attributes that the rows have. When it
    is not given or has at most ``few`` rows, totals are combined map-side, as usual. With more members a task meets a group
    about once, and its totals and texts are wider than the row. So the rows are shuffled as they are, without texts, by
    the key alone; their groups then need no other shuffle, and the texts are looked up for the totals. Hot keys and the
    unknown member, whose rows would meet in one task, are combined map-side.
    """
    def combined(df: DataFrame) -> DataFrame:
        return df.groupBy(key, *attributes, *periods).agg(*totals)

    if members is None or fits(members, few):
        return combined(rows)
    gathered = {k for k in hot_keys(rows, [key])[key] if k is not None} | {0}
    apart = F.col(key).isNull() | F.col(key).isin(*gathered)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / ROWS_PER_TASK))
    spread = rows.filter(~apart).repartition(tasks, key).groupBy(key, *periods).agg(*totals)
    if attributes:
        spread = spread.join(members.select(key, *attributes).hint("shuffle_hash"), key, "left")
    hot = combined(rows.filter(apart))
    return hot.unionByName(spread.select(*hot.columns))
