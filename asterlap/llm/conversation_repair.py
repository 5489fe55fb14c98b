"""Repair of conversations: the cheapest edits after which roles alternate as they should, by Four-Russians block tables.

A row is *blank* without any character but white space, a *duplicate* if its role and text came earlier in its
conversation, *truncated* if its last such character ends no sentence; its first fault counts. ``block_tables`` holds the
grammar, the costs and the lookups. Rows are collapsed (equal rows of one turn become one with a count), put in order by
one range partitioning, so that even a conversation with a third of all rows lies in many partitions, and cut into chunks
of at most ``CHUNK`` rows. A chunk is a small row of symbols. Nearly all conversations are one chunk and are traced at
once. For longer ones every chunk gives its matrix of least costs between states, a pass from the last chunk back turns
them into the cost vector behind each chunk, every chunk tells to which state each state would lead, and a pass from the
first chunk on fixes the state before each. Both passes keep one vector or state a conversation; everything else is done
chunk by chunk.

The digests need all of a conversation in order: its repaired text is hashed in one stream, whose memory is the hash's
state and the audit's letters. A hash of a whole text can't be split.

Defined cases: order within a conversation is by turn, nulls first, then role and text; null roles and texts are one
space, so a null text is blank; rows without a conversation ID form one conversation; repeated rows are duplicates;
conversations that have no rows left are repaired to nothing; an empty table gives no rows; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .block_tables import DELETE, INITIALS, INSERT, MUST_GO, NEVER, REROLE, STATES, UNFINISHED, tables
from .common import SPACE, arrow_batches, stored, table

#: Rows of a chunk at most, as a power of two.
CHUNK_BITS = 14
#: Characters of a text that place a row among the partitions; all of them order it there.
PREFIX = 64
ROLES = {"u": "user", "a": "assistant"}
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the damage that tests the repair, by a checksum of conversation and turn."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    role = F.when(kind == 4, "user").otherwise(said("role"))
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _turn(turn: Column) -> Column:
    """Orders turns, nulls first."""
    return F.struct(turn.isNotNull().alias("known"), turn.alias("turn"))


def judged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) in order, with equal ones as one: seq orders all rows; blank, duplicate
    and truncated count the copies with that fault; symbol is that of the first copy, the others must go."""
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    said = stored(
        rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
        .withColumn("key", F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.length("role"), "role", "text"))))
        .withColumn("last", F.substring(body, -1, 1)),
        "turns",
    )
    again = said.groupBy("key").agg(F.min(_turn(F.col("turn"))).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "first")
    later = F.coalesce(_turn(F.col("turn")) > F.col("first"), F.lit(False))
    blank, ended = F.col("last") == "", F.col("last").isin(".", "!", "?")
    begins = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    own = F.when(F.substring("role", 1, 1) == "", 3).otherwise(begins)
    faults = (
        said.join(again, "key", "left")
        .withColumn("blank", F.when(blank, F.col("copies")).otherwise(0).cast("long"))
        .withColumn("duplicate", F.when(blank, 0).when(later, F.col("copies")).otherwise(F.col("copies") - 1).cast("long"))
        .withColumn("truncated", F.when(blank | later | ended, 0).otherwise(1).cast("long"))
        .withColumn("symbol", F.when(blank | later, MUST_GO).otherwise(own + 4 * F.col("truncated")).cast("int"))
    )
    order = [F.col("conv_id"), F.col("turn"), F.col("role")]
    placed = faults.repartitionByRange(*order, F.substring("text", 1, PREFIX)).sortWithinPartitions(*order, F.col("text"))
    return stored(placed.select(F.monotonically_increasing_id().alias("seq"), "conv_id", "turn", "role", "text", "copies", "blank", "duplicate", "truncated", "symbol"), "ordered-turns")


def _mapped(df: DataFrame, one, schema: str) -> DataFrame:
    """``one(rows of a batch as dicts)`` yields tuples of ``schema``; it is made anew for each task."""
    kinds = [(f.name, f.dataType) for f in df.sparkSession.createDataFrame([], schema).schema]
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([(n, to_arrow_type(t)) for n, t in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        out = []
        for row in one(rows):
            out.append(row)
            if len(out) == 5000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def _symbols(runs: list[dict]):
    import numpy as np

    return np.array([r["symbol"] for r in runs if r["symbol"] != MUST_GO], np.int64)


def _matrices(rows):
    for r in rows:
        yield r["conv_id"], r["chunk"], tables().matrix(_symbols(r["runs"]))


def _vectors_behind(rows):
    """From the last chunk of a conversation to its first: the vector behind each, as an index."""
    seen, costs = object(), None
    for r in rows:
        if r["conv_id"] != seen:
            seen, costs = r["conv_id"], tables().vectors[0]
        yield r["conv_id"], r["chunk"], tables().ids[tuple(costs)]
        m = r["matrix"]
        costs = [min(m[STATES * i + j] + costs[j] for j in range(STATES)) for i in range(STATES)]
        least = min(costs)
        costs = [c - least if c < NEVER else NEVER for c in costs]


def _leads(rows):
    for r in rows:
        symbols = _symbols(r["runs"])
        yield r["conv_id"], r["chunk"], r["behind"], [tables().trace(symbols, r["behind"], s)[1] for s in range(STATES)]


def _states_before(rows):
    """From the first chunk of a conversation on: the state before each."""
    seen, state = object(), 0
    for r in rows:
        if r["conv_id"] != seen:
            seen, state = r["conv_id"], 0
        yield r["conv_id"], r["chunk"], r["behind"], state
        state = r["leads"][state]


def _traced(rows):
    for r in rows:
        own, state = tables().trace(_symbols(r["runs"]), r["behind"], r["state"])
        edits, last = iter(own), r["runs"][-1]["seq"]
        for run in r["runs"]:
            letters, said = next(edits) if run["symbol"] != MUST_GO else ("", "")
            ends = tables().last_inserts(state) if run["seq"] == last and r["final"] else ("", "")
            yield run["seq"], letters, said, *ends


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """By conversation, null or not, and chunk."""
    right = right.withColumnRenamed("conv_id", "c_id").withColumnRenamed("chunk", "c_chunk")
    return left.join(right, left["conv_id"].eqNullSafe(right["c_id"]) & (left["chunk"] == right["c_chunk"]), how).drop("c_id", "c_chunk")


def edits(rows: DataFrame) -> DataFrame:
    """The rows of ``judged`` with their cheapest edits: ``letters``, one Keep, Rerole or Delete behind Inserts for the
    first copy (nothing if it must go), ``said``, the initials of the turns that they leave, and ``letters_after``,
    ``said_after``, the Inserts behind a conversation's end. Copies that must go are deleted without a letter."""
    kind = dict(rows.dtypes)["conv_id"]
    chunk = F.shiftright("seq", CHUNK_BITS).alias("chunk")
    runs = F.sort_array(F.collect_list(F.struct("seq", "symbol"))).alias("runs")
    chunks = stored(rows.groupBy("conv_id", chunk).agg(runs), "chunks")
    spans = chunks.groupBy("conv_id").agg(F.max("chunk").alias("chunk"), F.count(F.lit(1)).alias("n"))
    long = stored(spans.filter("n > 1").select("conv_id").withColumnRenamed("conv_id", "c_id"), "long-conversations")
    of_long = chunks.join(long, chunks["conv_id"].eqNullSafe(long["c_id"]), "left_semi")
    key = f"conv_id {kind}, chunk long"
    by = lambda df, order: df.repartition("conv_id").sortWithinPartitions("conv_id", order)
    matrices = _mapped(of_long, _matrices, f"{key}, matrix array<long>")
    behind = stored(_mapped(by(matrices, F.desc("chunk")), _vectors_behind, f"{key}, behind int"), "chunk-vectors")
    leads = _mapped(_joined(of_long, behind, "inner"), _leads, f"{key}, behind int, leads array<int>")
    borders = stored(_mapped(by(leads, "chunk"), _states_before, f"{key}, behind int, state int"), "chunk-states")
    final = spans.select("conv_id", "chunk", F.lit(True).alias("final"))
    due = _joined(_joined(chunks, borders, "left"), final, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    due = due.select("runs", zero("behind"), zero("state"), F.coalesce("final", F.lit(False)).alias("final"))
    traced = _mapped(due, _traced, "seq long, letters string, said string, letters_after string, said_after string")
    return rows.join(traced, "seq")


def repaired(edited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, seq, place (orders turns of equal seq), role, text."""
    said = F.concat("said", "said_after")
    turns = edited.withColumn("place", F.explode(F.sequence(F.lit(1), F.length(said)))).filter(F.length(said) > 0)
    mine = F.col("place") == F.when(F.col("letters").endswith("D"), 0).otherwise(F.length("said"))
    given = F.when(F.substring(said, F.col("place"), F.lit(1)) == "u", "user").otherwise("assistant")
    return turns.select("conv_id", "seq", "place", F.when(mine & F.col("letters").endswith("K"), F.col("role")).otherwise(given).alias("role"), F.when(mine, F.col("text")).otherwise("").alias("text"))


def _digested(rows):
    """Over the rows of ``edits`` in order: a row per conversation, with one hash that takes text after text."""
    seen, now = object(), None
    for r in rows:
        if r["conv_id"] != seen:
            if now:
                yield now.row()
            seen, now = r["conv_id"], _Digest(r["conv_id"])
        now.add(r)
    if now:
        yield now.row()


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.first, self.last = conv_id, 0, None, None
        self.counts, self.illegal, self.cost, self.before = [0, 0, 0], 0, 0, None
        self.audit, self.hash, self.said = [], hashlib.sha256(), False

    def say(self, role: str, text: str) -> None:
        self.hash.update(("\n" * self.said + role + ":" + text).encode())
        self.said = True

    def add(self, r: dict) -> None:
        if r["turn"] is not None and r["turn"] != self.last:
            self.turns, self.last = self.turns + 1, r["turn"]
            self.first = r["turn"] if self.first is None else self.first
        for i, fault in enumerate(("blank", "duplicate", "truncated")):
            self.counts[i] += r[fault]
        initial, copies, letters = r["role"][:1], r["copies"], r["letters"]
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.illegal += copies - 1  # equal initials
        self.before = initial
        gone = copies - bool(letters)
        self.audit += [letters, "D" * gone, r["letters_after"]]
        self.cost += INSERT * (letters.count("I") + len(r["letters_after"])) + DELETE * gone
        own = letters[-1:]
        if own == "D":
            self.cost += DELETE
        elif own:
            self.cost += REROLE * (own == "R") + UNFINISHED * r["truncated"]
        for initial in r["said"][: len(r["said"]) - (own in ("K", "R"))]:
            self.say(ROLES[initial], "")
        if own in ("K", "R"):
            self.say(r["role"] if own == "K" else ROLES[r["said"][-1]], r["text"])
        for initial in r["said_after"]:
            self.say(ROLES[initial], "")

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.counts, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(edited: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation with rows."""
    kind = dict(edited.dtypes)["conv_id"]
    rows = edited.select("conv_id", "seq", "turn", "role", "text", "copies", "blank", "duplicate", "truncated", "letters", "said", "letters_after", "said_after")
    whole = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return _mapped(whole, _digested, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    conversations = table(spark, sf_dir, "conversations")
    found = stored(digests(edits(judged(damaged(conversations)))).withColumnRenamed("conv_id", "c_id"), "repaired")
    every = conversations.select("conv_id").distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS]
    return every.join(found, every["conv_id"].eqNullSafe(found["c_id"]), "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_HASH)).alias("repaired_sha256")
    )


ORACLE_SQL = r"""
with recursive
crc as (select list(c order by x) as t from (select x, list_reduce([x::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as c from range(256) r(x))),
keyed as (select row_number() over () as rid, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
kinds as (select keyed.*, xor(list_reduce([4294967295]::bigint[] || list_transform(range(1, length(k) + 1), lambda i: ord(k[i])::bigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind from keyed, crc),
damage as (select rid, conv_id, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy from kinds where kind <> 0),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, rid, copy) as p, row_number() over (partition by conv_id, role, text order by turn nulls first, rid, copy) > 1 as seen,
  right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as tail, left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by turn nulls first, role, text, rid, copy) as before from damage),
judged as (select *, tail = '' as blank, tail <> '' and seen as duplicate, tail <> '' and not seen and tail not in ('.', '!', '?') as truncated from ordered),
inserts(s0, s1, letters, said) as (values (0, 0, '', []::varchar[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:'])),
next(s1, initial, s2) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
moves as (select s0, letters || 'D' as letters, 5 * len(letters) + 2 as cost, s1 as s2, null::varchar as initial, said, 'D' as own, null::varchar as role from inserts
  union all select s0, letters || 'K', 5 * len(letters), s2, initial, said, 'K', null from inserts join next using (s1)
  union all select s0, letters || 'R', 5 * len(letters) + 1, s2, null, said, 'R', case initial when 'u' then 'user' else 'assistant' end from inserts join next using (s1) where initial <> 's'),
walk(conv_id, p, s, best) as (
  select distinct conv_id, 0::bigint, 0, {'cost': 0::bigint, 'audit': '', 'said': []::varchar[]} from conversations
  union all
  select w.conv_id, w.p + 1, m.s2, min({'cost': best.cost + m.cost + case when j.truncated and m.own <> 'D' then 5 else 0 end, 'audit': best.audit || m.letters,
    'said': best.said || m.said || case when m.own = 'D' then [] else [coalesce(m.role, j.role) || ':' || j.text] end})
  from walk w join judged j on j.conv_id is not distinct from w.conv_id and j.p = w.p + 1 join moves m on m.s0 = w.s
  where case when j.blank or j.duplicate then m.own = 'D' else m.own <> 'K' or m.initial = j.initial end
  group by w.conv_id, w.p, m.s2),
counts as (select conv_id, max(p) as n, sum(blank::int) as blank, sum(duplicate::int) as duplicate, sum(truncated::int) as truncated, sum((p > 1 and before || initial not in ('su', 'ua', 'au'))::int) as illegal,
  coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps from judged group by conv_id),
ends as (select w.conv_id, min({'cost': best.cost + 5 * len(letters), 'audit': best.audit || letters, 'said': best.said || i.said}) as best, any_value(gaps) as gaps, any_value(blank) as blank,
  any_value(duplicate) as duplicate, any_value(truncated) as truncated, any_value(illegal) as illegal
  from walk w left join counts c on c.conv_id is not distinct from w.conv_id join inserts i on i.s0 = w.s and i.s1 in (0, 3) where w.p = coalesce(c.n, 0) group by w.conv_id)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, best.cost::bigint as cost, best.audit as audit, sha256(array_to_string(best.said, chr(10))) as repaired_sha256 from ends
"""
