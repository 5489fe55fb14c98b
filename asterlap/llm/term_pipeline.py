"""Ranked lexical search by pipelined term partitioning.

Documents are cut into shards of at most ``SHARD_DOCS``, where they are read; a shard keeps, for each term of the queries,
the list of its documents and frequencies. Terms are owned by stages, the rarest by the first. An item travels as one
bundle per shard through the stages in turn: a cogroup brings together the bundles of a shard with the lists that the
stage owns there, the integer contributions of the stage's terms are added to the bundle's sparse accumulators, and the
bundle goes on. So a term that nearly all documents hold is spread over all shards, and no list is copied per item.

Bundles stay sparse without losing a result. A contribution is below a million times the term's weight, so the terms of
the later stages bound what a document can still gain. A document that cannot reach the tenth score its item already has
in the shard is left out, and once the bound is below that score no new documents are taken in. Every shard gives its ten
best for each item; the ten best of all follow.

Terms of the queries are sent to the tasks that read documents up to ``VOCABULARY_BYTES``; beyond that all terms are
listed and a join keeps those that are asked for.

Defined cases: a null text has no terms; documents without terms are no documents here; repeated rows each count and
rank, a null doc_id before all others at equal scores; rows with the same item_id are one item with the terms of all of
them, null being an item_id like others; items without terms that occur have no rows; an empty table gives none; other
columns are ignored.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, arrow_batches, stored, table, text_of, with_text
from .positional_index import words

TOP = 10
SHARD_DOCS = 8192
#: Entries of lists after which a shard is full, whatever its documents.
SHARD_ENTRIES = 4_000_000
ITEM_BLOCK = 256
VOCABULARY_BYTES = 32 << 20
#: Stages own the terms that at most this share of the documents holds; the last owns the others.
SHARES = (0.001, 0.01, 0.1)
LARGEST = 10**6
#: A-Z to a-z; what separates terms to blanks.
_LETTERS = bytes(c if chr(c).isdigit() or chr(c).islower() or c > 127 else c + 32 if chr(c).isupper() else 32 for c in range(128)) + bytes(range(128, 256))
LISTS = "shard long, term binary, docs binary, counts binary, n_docs long, n_terms long"
_ARROW = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("docs", pa.binary()), ("counts", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
BUNDLE = "shard long, block int, item_id {}, terms array<struct<term:binary,w:long,stage:int>>, docs binary, scores binary"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


class _Shard:
    """The lists of some documents: ``lists[term]`` has their places in the shard and how often they hold the term."""

    def __init__(self):
        self.ids, self.lengths, self.lists, self.entries = [], [], {}, 0

    def add(self, doc_id: int | None, found: list[bytes], vocabulary: frozenset | None) -> None:
        counts = Counter(found)
        for term in counts.keys() if vocabulary is None else counts.keys() & vocabulary:
            docs, times = self.lists.setdefault(term, ([], []))
            docs.append(len(self.ids))
            times.append(counts[term])
            self.entries += 1
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(len(found))

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        """A row for the documents (no term; IDs and lengths), and one for each term."""
        rows = [(number, None, np.array(self.ids, "<i8").tobytes(), np.array(self.lengths, "<i8").tobytes(), len(self.ids), sum(self.lengths))]
        rows += [(number, t, np.array(d, "<i4").tobytes(), np.array(c, "<i4").tobytes(), len(d), sum(c)) for t, (d, c) in self.lists.items()]
        for i in range(0, len(rows), 2000):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 2000]), _ARROW)], schema=_ARROW)


def lists(docs: DataFrame, vocabulary: frozenset | None) -> DataFrame:
    """The shards' lists, stored. A shard's number is its task's and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if found := terms_of(text.as_py()):
                    shard.add(doc_id, found, vocabulary)
                if len(shard.ids) >= SHARD_DOCS or shard.entries >= SHARD_ENTRIES:
                    yield from shard.batches(number)
                    number, shard = number + 1, _Shard()
        if shard.ids:
            yield from shard.batches(number)

    return stored(with_text(docs).mapInArrow(run, LISTS), "term-lists")


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item."""
    each = items.select("item_id", F.explode(words(text_of(items))).alias("term")).distinct()
    return stored(each.select("item_id", F.col("term").cast("binary").alias("term")), "query-terms")


def _vocabulary(asked: DataFrame) -> frozenset | None:
    distinct = asked.select("term").distinct()
    size = distinct.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    return frozenset(bytes(r.term) for r in distinct.collect()) if size <= VOCABULARY_BYTES else None


def weighted(asked: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, terms: term, weight and stage of each that occurs)."""
    held = index.filter("term is not null").join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    stage = sum(((F.col("df") > share * n_docs).cast("int") for share in SHARES), F.lit(0))
    of_item = F.sort_array(F.collect_list(F.struct("term", weight.alias("w"), stage.cast("int").alias("stage"))))
    return asked.join(held, "term").groupBy("item_id").agg(of_item.alias("terms"))


def _impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    tf = counts.astype(np.int64)
    m = 100 - 90 + (90 * lengths * n_docs) // n_terms
    return (10**9 * tf) // (1000 * tf + 8 * m)


def _kth(scores: np.ndarray) -> int:
    return int(np.partition(scores, len(scores) - TOP)[len(scores) - TOP]) if len(scores) >= TOP else 0


def advance(docs: np.ndarray, scores: np.ndarray, terms: list[dict], stage: int, impacts: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    """An item's accumulators in a shard of ``size`` documents after a stage; ``impacts[term]`` has documents and what a
    weight of one gives there."""
    own = [t for t in terms if t["stage"] == stage and t["term"] in impacts]
    still = LARGEST * sum(t["w"] for t in terms if t["stage"] >= stage)
    later = LARGEST * sum(t["w"] for t in terms if t["stage"] > stage)
    if own:
        total = np.zeros(size, np.int64)
        total[docs] = scores
        for t in own:
            where, what = impacts[t["term"]]
            total[where] += t["w"] * what
        if still >= _kth(scores):
            docs = np.flatnonzero(total)
        scores = total[docs]
    kept = scores + later >= _kth(scores)
    return docs[kept], scores[kept]


def _stage(stage: int, last: bool, n_docs: int, n_terms: int, schema: pa.Schema):
    def run(bundles: pa.Table, owned: pa.Table) -> pa.Table:
        shard = {t: (d, c) for t, d, c in zip(*(owned.column(c).to_pylist() for c in ("term", "docs", "counts")))}
        ids, lengths = (np.frombuffer(b, "<i8") for b in shard.pop(None))
        impacts = {}
        for term, (docs, counts) in shard.items():
            docs = np.frombuffer(docs, "<i4")
            impacts[term] = docs, _impacts(np.frombuffer(counts, "<i4"), lengths[docs], n_docs, n_terms)
        out = []
        for b in bundles.to_pylist():
            docs, scores = np.frombuffer(b["docs"], "<i4"), np.frombuffer(b["scores"], "<i8")
            docs, scores = advance(docs, scores, b["terms"], stage, impacts, len(ids))
            if last:
                best = np.lexsort((ids[docs], -scores))[:TOP]
                out += [(b["item_id"], int(ids[docs[i]]), int(scores[i])) for i in best]
            else:
                out.append((b["shard"], b["block"], b["item_id"], b["terms"], docs.astype("<i4").tobytes(), scores.astype("<i8").tobytes()))
        columns = zip(*out) if out else [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the ten best documents of each item."""
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    asked = query_terms(items)
    index = lists(docs, _vocabulary(asked))
    n_docs, n_terms = index.filter("term is null").agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    queries = stored(weighted(asked, index, n_docs), "weighted-queries")
    blocks = max(1, math.ceil(queries.count() / ITEM_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    none = F.lit(b"")
    shards = index.filter("term is null").select("shard", each_block)
    bundles = shards.join(queries, "block").select("shard", "block", "item_id", "terms", none.alias("docs"), none.alias("scores"))
    owners = queries.select(F.explode("terms").alias("t"), "block").select("t.term", "t.stage", "block").distinct()
    found = index.filter("term is not null").join(owners, "term").select("shard", "block", "stage", "term", "docs", "counts")
    directory = index.filter("term is null").select("shard", each_block, "term", "docs", "counts")
    best = f"item_id {kind}, doc_id long, score long"
    for stage in range(len(SHARES) + 1):
        last = stage == len(SHARES)
        schema = best if last else BUNDLE.format(kind)
        run = _stage(stage, last, n_docs, n_terms, _arrow(spark, schema))
        owned = directory.unionByName(found.filter(F.col("stage") == stage).drop("stage")).withColumnsRenamed({"shard": "of_shard", "block": "of_block"})
        owned = owned.select(*(F.col(c).alias(c) for c in owned.columns))
        bundles = bundles.groupBy("shard", "block").cogroup(owned.groupBy("of_shard", "of_block")).applyInArrow(_only_both(run, _arrow(spark, schema)), schema)
    first = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = bundles.filter("score > 0").withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= TOP)
    return ranked.select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")


def _only_both(run, schema: pa.Schema):
    """Nothing for a shard without bundles."""
    return lambda bundles, owned: run(bundles, owned) if bundles.num_rows else schema.empty_table()


def _arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def op13_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
q as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
c as (select count(*)::bigint as n_docs, sum(len(w))::bigint as n_terms from d where len(w) > 0),
m as (select rid, doc_id, 100 - 90 + (90 * len(w) * n_docs) // n_terms as m from d, c where len(w) > 0),
p as (select rid, term, count(*)::bigint as tf from (select rid, unnest(w) as term from d) semi join q using (term) group by rid, term),
t as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from p, c group by term, n_docs),
s as (select item_id, rid, doc_id, sum(t.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score from q join t using (term) join p using (term) join m using (rid) group by item_id, rid, doc_id)
select item_id, rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id nulls first)::int as rank from s where score > 0) where rank <= 10
"""
