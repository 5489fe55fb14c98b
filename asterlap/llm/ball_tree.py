"""Exact top-k search by inner product: a ball tree in each shard, searched by branch and bound.

Vectors are floored to integers, so scores are exact. A bounded sample gives the planes of a top tree, which deals all
vectors to shards of neighbours; leaves of the top tree with many rows, be they copies of one vector, are dealt further by
a hash of the row. Each shard builds its ball tree: a node is a centre and a radius, its upper bound for a query q is
``q.centre + |q| * radius``. A block of queries descends a tree together, the node with the largest bound first, and a
query stays only in nodes whose bound reaches its current k-th score.

Queries first search the shard that they lie in themselves, which gives k-th scores near the final ones. These go with
them to all other shards, which at once leave out nodes, or the whole shard, that cannot reach them; within a task, what
one shard improves also holds for the next. At equal scores the smaller ID wins, so a node whose bound equals the k-th
score is left out only if all its IDs are larger. Copies of one vector form a leaf of radius zero, of which the smallest
IDs are enough. What a shard returns is at most k rows per query, and none for queries it can't improve.

Defined cases: vectors that are null or hold null or non-finite components take no part; shorter vectors are as if
followed by zeros; rows with equal IDs are different candidates, and each such row divisible by ``EVERY`` is a query of
its own; rows with a null ID are candidates, behind all others at equal scores, and no queries; scores beyond 64 bits are
the largest or smallest that fit; an empty table gives no rows; other columns are ignored.
"""

import heapq
import io
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_batches, stored, table

TOP = 5
EVERY = 50
SCALE = 256
#: Rows of a shard: at most about the first, and with few rows in all not below the second.
SHARD_ROWS, SMALL_SHARD = 131_072, 1024
#: Leaves of the top tree at most, and components of the sample it is made from.
TOP_LEAVES, SAMPLE_VALUES = 4096, 2**20
LEAF = 128
QUERY_BLOCK = 1024
#: Queries that one copy of a shard serves.
QUERY_GROUP = 1_000_000
NO_SCORE, NO_VEC = -(2**63), 2**63 - 1
FOUND = "found array<struct<rid:long,query_id:long,vec_id:long,score:long>>"


def integers(rows: DataFrame) -> DataFrame:
    """(rid, vec_id, v), stored: the valid vectors as integers."""
    infinite = F.lit(float("inf"))
    valid = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinite), F.lit(False)))
    v = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    kept = rows.filter(F.col("embedding").isNotNull() & valid)
    return stored(kept.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")), "vectors")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _narrow(m: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them."""
    low, high = (int(m.min()), int(m.max())) if m.size else (0, 0)
    return m.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _pack(**arrays) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    return buffer.getvalue()


def _direction(points: np.ndarray) -> np.ndarray:
    """From a far point to the one farthest from it."""
    far = points[np.argmax(((points - points.mean(0)) ** 2).sum(1))]
    return points[np.argmax(((points - far) ** 2).sum(1))] - far


def top_tree(sample: np.ndarray, leaves: int) -> list[tuple]:
    """Nodes (direction, threshold, left, right); a negative child -1 - i is leaf i."""
    nodes, count = [], 0

    def grow(points: np.ndarray, wanted: int) -> int:
        nonlocal count
        if wanted > 1 and len(points) > 1:
            axis = _direction(points)
            at = points @ axis
            split = float(np.quantile(at, (wanted // 2) / wanted))
            left = at < split
            if left.any() and not left.all():
                place = len(nodes)
                nodes.append(None)
                nodes[place] = (axis, split, grow(points[left], wanted // 2), grow(points[~left], wanted - wanted // 2))
                return place
        count += 1
        return -count

    grow(sample.astype(float), leaves)
    return nodes


def leaf_of(nodes: list[tuple], points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    due = [(0, np.arange(len(points)))] if nodes else []
    while due:
        place, rows = due.pop()
        axis, split, left, right = nodes[place]
        low = points[rows] @ axis < split
        for child, part in ((left, rows[low]), (right, rows[~low])):
            if child < 0:
                out[part] = -1 - child
            elif len(part):
                due.append((child, part))
    return out


class BallTree:
    """Points in the order of the tree; arrays with an entry per node: from, to, left, right, centre, radius, least ID."""

    FIELDS = ("points", "rids", "ids", "lo", "hi", "left", "right", "centres", "radii", "least")

    def __init__(self, **fields):
        self.__dict__.update(fields)
        self.points = self.points.astype(np.int64)
        self.peak = int(np.abs(self.points).max()) if self.points.size else 0
        self.centre_norms = np.sqrt((self.centres**2).sum(1))

    @classmethod
    def of(cls, points: np.ndarray, rids: np.ndarray, ids: np.ndarray) -> "BallTree":
        order, nodes = np.lexsort((rids, ids)), []

        def grow(lo: int, hi: int) -> int:
            rows = order[lo:hi]
            p = points[rows].astype(float)
            same = bool((p == p[0]).all())
            centre = p[0] if same else p.mean(0)
            radius = 0.0 if same else float(np.sqrt(((p - centre) ** 2).sum(1).max()))
            place = len(nodes)
            nodes.append([lo, hi, -1, -1, centre, radius, int(ids[rows].min())])
            if same or hi - lo <= LEAF:
                order[lo:hi] = rows[np.lexsort((rids[rows], ids[rows]))]
                return place
            at = p @ _direction(p)
            order[lo:hi] = rows[np.argsort(at, kind="stable")]
            middle = (lo + hi) // 2
            nodes[place][2:4] = grow(lo, middle), grow(middle, hi)
            return place

        grow(0, len(points))
        lo, hi, left, right, centres, radii, least = zip(*nodes)
        whole = {n: np.array(a, np.int64) for n, a in (("lo", lo), ("hi", hi), ("left", left), ("right", right), ("least", least))}
        return cls(points=points[order], rids=rids[order], ids=ids[order], centres=np.array(centres), radii=np.array(radii), **whole)

    def packed(self) -> bytes:
        return _pack(**{f: _narrow(self.points) if f == "points" else getattr(self, f) for f in self.FIELDS})

    @classmethod
    def unpacked(cls, data: bytes) -> "BallTree":
        return cls(**np.load(io.BytesIO(data)))

    def scores(self, queries: np.ndarray, rows: slice) -> np.ndarray:
        points = self.points[rows]
        largest = int(np.abs(queries).max()) * self.peak * queries.shape[1] if queries.size else 0
        if largest < 2**53:
            return (queries.astype(float) @ points.T.astype(float)).astype(np.int64)
        return np.clip(queries.astype(object) @ points.T.astype(object), NO_SCORE + 1, NO_VEC).astype(np.int64)

    def bounds(self, queries: np.ndarray, norms: np.ndarray, node: int) -> np.ndarray:
        """Upper bounds of the scores in a node, exact for copies of one vector."""
        value = queries.astype(float) @ self.centres[node]
        if self.radii[node] == 0 and np.abs(value).max(initial=0) < 2**53:
            return value
        return value + norms * self.radii[node] + 1e-6 + 1e-9 * norms * (self.centre_norms[node] + self.radii[node])

    def search(self, block: "Block") -> int:
        """Improves the block's best; returns how many points were scored, for all queries together."""
        norms = np.sqrt((block.vectors.astype(float) ** 2).sum(1))
        scored, everyone = 0, np.arange(len(block.vectors))
        due = []

        def push(node: int, who: np.ndarray) -> None:
            bound = self.bounds(block.vectors[who], norms[who], node)
            stay = block.may_gain(who, bound, self.least[node])
            if stay.any():
                heapq.heappush(due, (-float(bound[stay].max()), node, who[stay], bound[stay]))

        push(0, everyone)
        while due:
            _, node, who, bound = heapq.heappop(due)
            who = who[block.may_gain(who, bound, self.least[node])]
            if not len(who):
                continue
            if self.left[node] >= 0:
                push(int(self.left[node]), who)
                push(int(self.right[node]), who)
                continue
            hi = min(self.hi[node], self.lo[node] + TOP + 1) if self.radii[node] == 0 else self.hi[node]
            rows = slice(self.lo[node], hi)
            found = self.scores(block.vectors[who], rows)
            scored += found.size
            found[block.rids[who][:, None] == self.rids[rows]] = NO_SCORE
            block.offer(who, found, self.ids[rows])
        return scored


class Block:
    """Queries with their best scores so far, in order, and the IDs these belong to."""

    def __init__(self, rids, ids, vectors, scores=None, vecs=None):
        self.rids, self.ids, self.vectors = rids, ids, vectors.astype(np.int64)
        self.scores = np.full((len(rids), TOP), NO_SCORE, np.int64) if scores is None else scores
        self.vecs = np.full((len(rids), TOP), NO_VEC, np.int64) if vecs is None else vecs

    def may_gain(self, who: np.ndarray, bound: np.ndarray, least: int) -> np.ndarray:
        kth = self.scores[who, -1]
        return (bound > kth) | (bound == kth) & (least < self.vecs[who, -1])

    def offer(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``ids`` ascend."""
        better = (scores.max(1) >= self.scores[who, -1]) & (scores.max(1) > NO_SCORE)
        who, scores = who[better], scores[better]
        if not len(who):
            return
        # -score would overflow at the least number, ~score doesn't; stable, so smaller IDs come first.
        first = np.argsort(~scores, axis=1, kind="stable")[:, :TOP]
        both = np.hstack([self.scores[who], np.take_along_axis(scores, first, 1)])
        vecs = np.hstack([self.vecs[who], ids[first]])
        order = np.lexsort((vecs, ~both), axis=-1)[:, :TOP]
        self.scores[who], self.vecs[who] = np.take_along_axis(both, order, 1), np.take_along_axis(vecs, order, 1)

    def found(self, since: np.ndarray | None = None) -> list[dict]:
        """The best so far; with ``since`` (scores and IDs of before), those that weren't among them."""
        changed = np.ones(len(self.rids), bool) if since is None else (self.scores != since[0]).any(1) | (self.vecs != since[1]).any(1)
        out = []
        for i in np.flatnonzero(changed).tolist():
            new = Counter(zip(self.scores[i].tolist(), self.vecs[i].tolist()))
            if since is not None:
                new -= Counter(zip(since[0][i].tolist(), since[1][i].tolist()))
            one = {"rid": int(self.rids[i]), "query_id": int(self.ids[i])}
            out += [one | {"vec_id": None if v == NO_VEC else v, "score": s} for s, v in new.elements() if s > NO_SCORE]
        return out

    def packed(self) -> bytes:
        return _pack(rids=self.rids, ids=self.ids, vectors=_narrow(self.vectors), scores=self.scores, vecs=self.vecs)

    @classmethod
    def unpacked(cls, data: bytes) -> "Block":
        return cls(**np.load(io.BytesIO(data)))


PARTS = f"shard long, kind int, block int, payload binary, {FOUND}"
TREE, QUERIES = 0, 1
_FOUND = pa.list_(pa.struct([("rid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))
_PARTS = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("block", pa.int32()), ("payload", pa.binary()), ("found", _FOUND)])


def _shard_parts(shard: int, rids: np.ndarray, ids: np.ndarray, points: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A shard's tree, and its own queries in blocks, which have searched it."""
    tree = BallTree.of(points, rids, ids)
    row = lambda *values: pa.record_batch([pa.array([v], f.type) for v, f in zip((shard, *values), _PARTS)], schema=_PARTS)
    yield row(TREE, 0, tree.packed(), [])
    mine = np.flatnonzero((tree.ids % EVERY == 0) & (tree.ids != NO_VEC))  # in the tree's order, so neighbours share blocks
    for number, start in enumerate(range(0, len(mine), QUERY_BLOCK)):
        some = mine[start : start + QUERY_BLOCK]
        block = Block(tree.rids[some], tree.ids[some], tree.points[some])
        tree.search(block)
        yield row(QUERIES, number, block.packed(), block.found())


def shards(rows: DataFrame, width: int) -> DataFrame:
    """Trees and blocks of queries of every shard, from (shard, rid, vec_id, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        whole = lambda: (np.concatenate(a) for a in zip(*parts))
        for batch in batches:
            number = batch.column(0).to_numpy()
            ids = batch.column(2).fill_null(NO_VEC).to_numpy()
            columns = batch.column(1).to_numpy(), ids, matrix(batch.column(3), width)
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now is not None and number[a] != now:
                    yield from _shard_parts(now, *whole())
                    parts = []
                now = int(number[a])
                parts.append([c[a:b] for c in columns])
        if parts:
            yield from _shard_parts(now, *whole())

    dealt = rows.select("shard", "rid", "vec_id", "v").repartition("shard").sortWithinPartitions("shard", "rid")
    return stored(dealt.mapInArrow(run, PARTS), "ball-trees")


def elsewhere(parts: DataFrame, n_shards: int, n_queries: int) -> DataFrame:
    """What queries find in the shards that they don't lie in."""
    groups = math.ceil(max(1, n_queries) / QUERY_GROUP)
    trees = parts.filter(F.col("kind") == TREE).select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.col("shard").alias("at"), "kind", "shard", "block", "payload")
    group = F.pmod(F.xxhash64("shard", "block"), F.lit(groups)).cast("int").alias("g")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("at")
    sent = parts.filter(F.col("kind") == QUERIES).select(group, others, "kind", "shard", "block", "payload").filter("at <> shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, group, known = None, None, {}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["g"] != group:
                    group, known = r["g"], {}
                if r["kind"] == TREE:
                    tree = BallTree.unpacked(r["payload"])
                    continue
                block = Block.unpacked(r["payload"])
                key = r["shard"], r["block"]
                block.scores, block.vecs = known.get(key, (block.scores, block.vecs))
                before = block.scores.copy(), block.vecs.copy()
                tree.search(block)
                known[key] = block.scores, block.vecs
                out.append(block.found(before))
            yield pa.record_batch([pa.array(out, _FOUND)], names=["found"])

    dealt = trees.unionByName(sent).repartition("g", "at").sortWithinPartitions("g", "at", "kind")
    return dealt.mapInArrow(run, FOUND)


def nearest(rows: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the ``TOP`` best candidates of every query."""
    spark = rows.sparkSession
    vectors = integers(rows)
    n, width, n_queries = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count(F.when(F.col("vec_id") % EVERY == 0, 1))).first()
    width = max(1, width)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaves = min(TOP_LEAVES, max(math.ceil(n / SHARD_ROWS), min(partitions, n // SMALL_SHARD), 1))
    sample = vectors.orderBy(F.xxhash64("rid"), "rid").limit(max(64, SAMPLE_VALUES // width)).select("v").toArrow()
    nodes = top_tree(matrix(sample.column(0).combine_chunks(), width), leaves) if len(sample) else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = leaf_of(nodes, matrix(b.column(2), width).astype(float))
            yield pa.record_batch([*b.columns, pa.array(leaf)], names=["rid", "vec_id", "v", "leaf"])

    dealt = stored(vectors.mapInArrow(deal, "rid long, vec_id long, v array<long>, leaf long"), "dealt-vectors")
    sizes = sorted((r.leaf, math.ceil(r["count"] / SHARD_ROWS)) for r in dealt.groupBy("leaf").count().collect())
    ends = np.cumsum([k for _, k in sizes]).tolist()
    layout = spark.createDataFrame([(leaf, end - k, k) for (leaf, k), end in zip(sizes, ends)], "leaf long, base long, parts long")
    shard = F.col("base") + F.pmod(F.xxhash64("rid"), F.col("parts"))
    parts = shards(dealt.join(F.broadcast(layout), "leaf").withColumn("shard", shard), width)
    found = parts.select("found").unionByName(elsewhere(parts, max(1, ends[-1] if ends else 0), n_queries))
    each = found.select(F.explode("found").alias("f")).select("f.*")
    order = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    return nearest(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = r"""
with v as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.rid, q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score from v q, v c where q.vec_id % 50 = 0 and c.rid <> q.rid)
select query_id, rank, vec_id, score from (select *, row_number() over (partition by rid order by score desc, vec_id nulls last)::int as rank from s) where rank <= 5
"""
