"""Connected components by alternating large-star and small-star steps over stored edges."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, stored_and_measured


def _with_least(edges: DataFrame, total: int, larger: bool) -> DataFrame:
    """(u, v, m): edges u-v, v larger (or smaller) than u, with the least neighbour m of u, or u itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    joined = join_counted(both, least, ["u"], "n", 2 * total)
    return joined.filter(F.col("v") > F.col("u") if larger else F.col("v") < F.col("u"))


def _edges(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node is both a centre (a) and a leaf (b), or a leaf of two centres."""
    ends = edges.select(F.col("a").alias("u"), F.lit(0).alias("leaf")).union(edges.select("b", F.lit(1)))
    seen = ends.groupBy("u").agg(F.sum("leaf").alias("leaf"), F.min("leaf").alias("least"))
    return not seen.agg(F.max(F.expr("leaf > 1 or (leaf = 1 and least = 0)"))).first()[0]


#: Edges of a file; few edges are kept in few files, so that the steps on them are few tasks.
EDGES_PER_FILE = 100_000


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(u, comp) of every node of the edges (a, b): comp is the least node of its component. ``most``: a number that the
    edges don't exceed, if known.

    A step replaces a node's edges by edges to its least neighbour, so a long path shrinks by halves and a hub stays a
    star. It ends when only stars are left."""
    def kept(df: DataFrame, number: int | None) -> tuple[DataFrame, int]:
        files = number and max(1, math.ceil(number / EDGES_PER_FILE))
        found, seen = stored_and_measured(_edges(df), "components-edges", files, n=F.count(F.lit(1)))
        return found, seen["n"]

    now, total = kept(edges, most)
    while not _are_stars(now):
        # A step makes at most an edge from every edge and its end.
        large, total = kept(_with_least(now, total, True).select(F.col("m").alias("a"), F.col("v").alias("b")), total)
        small = _with_least(large, total, False)
        now, total = kept(small.select(F.inline(F.array(F.struct(F.col("m").alias("a"), F.col("v").alias("b")), F.struct(F.col("m").alias("a"), F.col("u").alias("b"))))), 2 * total)
    return now.select(F.col("b").alias("u"), F.col("a").alias("comp")).union(now.select(F.col("a").alias("u"), F.col("a").alias("comp")).distinct())
