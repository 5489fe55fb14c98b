"""Benchmark decontamination by a positional inverted index: exact phrases and proximity.

Each benchmark text becomes windows of ten consecutive words (a shorter one is a single window). Document frequencies of
the benchmark's terms are counted over the whole corpus, and each window is anchored at its rarest terms. The index
stores, for the anchor terms alone, every place (document, position) they occur at. A window's occurrences are found
from its rarest term outwards: the list of the rarest term, its offset taken off, gives possible starts; each further
anchor's list, adjusted likewise, keeps those that it has too; the words of the few documents left confirm the rest.
Common words are never looked up unless a window has nothing else. The same index answers proximity: a document is near
an item if the item's two rarest terms, of those that the corpus has, come about as close to each other as in the item,
in any order, whatever stands between them. Only exact phrases make a document contaminated; near items are reported
beside them. Only DataFrame functions are used.

Documents are keyed by ID and content, so repeated rows share one entry. Small tables of terms and windows are broadcast
up to a checked number of bytes. Beyond it frequent terms are split: counted occurrences say into how many parts.

Defined cases: a null text has no words and is clean; items without words have no windows; windows that several items
have count for each; repeated items count once; null item IDs are left out of the list of items and of the near ones, but
their windows hit; an item of which the corpus has one term at most is near nothing;
an empty benchmark or table gives clean documents or no rows; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import document_key, join_counted, let, stored, table, text_of

WINDOW = 10
ANCHORS = 2
#: Words by which the two rarest terms of an item may be farther apart than in the item.
SLOP = 20
#: A length that no item has: its windows are whole items.
WHOLE = 1_000_000_000
#: Tables of benchmark terms, windows and their anchors are broadcast up to this size as text.
BROADCAST_BYTES = 16 << 20
#: Postings of a term in one part, where terms are split.
PART = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, letters and anything beyond ASCII, the letters A to Z in lower case."""
    lower = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lower, BETWEEN_WORDS), "")


def _is_small(df: DataFrame) -> bool:
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= BROADCAST_BYTES


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if _is_small(df) else df


def windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(win, terms, n): the distinct windows; (win, item_id): which items have them."""
    split = benchmark.select("item_id", words(text_of(benchmark)).alias("ws")).filter(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - size + 1, F.lit(1)))
    each = split.select("item_id", F.explode(let(F.col("ws"), lambda ws: F.transform(starts, lambda i: F.slice(ws, i, size)))).alias("terms"))
    each = stored(each.withColumn("win", F.sha2(F.array_join("terms", " "), 256)).distinct(), "index-windows")
    return each.select("win", "terms", F.size("terms").alias("n")).distinct(), each.select("win", "item_id").distinct()


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*document_key(docs), words(text_of(docs)).alias("ws"))


def term_counts(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(term, occurrences) of the windows' terms that the corpus has, stored. A term's occurrences are added up where they
    are read, so a frequent one is a row a task."""
    vocabulary = stored(wins.select(F.explode("terms").alias("term")).distinct(), "index-vocabulary")
    terms = keyed(docs).select(F.explode("ws").alias("term"))
    counted = lambda t: t.groupBy("term").agg(F.count(F.lit(1)).alias("occurrences"))
    if _is_small(vocabulary):
        return stored(counted(terms.join(F.broadcast(vocabulary), "term")), "index-counts")
    return stored(counted(terms).join(vocabulary, "term"), "index-counts")


def anchors(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """(win, rank, term, off, occurrences): the rarest terms of each window all of whose terms occur in the corpus."""
    known = wins.select("win", "n", F.posexplode("terms").alias("off", "term")).join(_small(counts), "term")
    by_window = Window.partitionBy("win")
    ranked = known.withColumn("found", F.count(F.lit(1)).over(by_window)).filter("found = n")
    ranked = ranked.withColumn("rank", F.row_number().over(by_window.orderBy("occurrences", "off")))
    return stored(ranked.filter(F.col("rank") <= ANCHORS).select("win", "rank", "term", "off", "occurrences"), "index-anchors")


def closest(wins: DataFrame, counts: DataFrame, slop: int) -> DataFrame:
    """(win, rank, term, occurrences, reach): the two rarest different terms of each window that has two in the corpus, ties
    to the lesser term, and how far apart they may be: their least distance in the window, and ``slop`` words more."""
    known = wins.select("win", F.posexplode("terms").alias("off", "term")).join(_small(counts), "term")
    known = known.groupBy("win", "term", "occurrences").agg(F.collect_list("off").alias("offs"))
    ranked = known.withColumn("rank", F.row_number().over(Window.partitionBy("win").orderBy("occurrences", "term"))).filter("rank <= 2")
    pairs = ranked.groupBy("win").agg(F.sort_array(F.collect_list(F.struct("rank", "term", "occurrences", "offs"))).alias("pair")).filter("size(pair) = 2")
    apart = F.array_min(F.flatten(F.transform(F.col("pair")[0]["offs"], lambda a: F.transform(F.col("pair")[1]["offs"], lambda b: F.abs(a - b)))))
    pairs = pairs.select("win", (apart + slop).alias("reach"), F.explode("pair").alias("t"))
    return stored(pairs.select("win", "t.rank", "t.term", "t.occurrences", "reach"), "index-pairs")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, part, k_id, k_text, pos) of every occurrence of the terms (term, occurrences; unique, stored), stored. A
    frequent term's places lie in several parts. Repeated rows give their places several times."""
    places = keyed(docs).select("k_id", "k_text", F.posexplode("ws").alias("pos", "term"))
    if _is_small(terms):
        found = places.join(F.broadcast(terms), "term")
    else:
        total = terms.agg(F.sum("occurrences")).first()[0] or 0
        found = join_counted(places, terms, ["term"], "occurrences", total)
    part = F.pmod(F.xxhash64("k_id", "k_text", "pos"), _parts())
    return stored(found.select("term", part.alias("part"), "k_id", "k_text", "pos"), "index-postings")


def _parts() -> Column:
    return F.ceil(F.col("occurrences") / PART)


def _places(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """The postings of the terms of ``chosen`` (term, occurrences, others), joined with its rows part by part."""
    if _is_small(chosen):
        return index.join(F.broadcast(chosen), "term")
    parts = chosen.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), _parts() - 1)))
    return index.join(parts, ["term", "part"])


def starts(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """(win, k_id, k_text, start): where the lists of all anchors of a window agree, from the rarest on."""
    first = chosen.filter("rank = 1").drop("rank")
    found = _places(index, first).select("win", "k_id", "k_text", (F.col("pos") - F.col("off")).alias("start")).filter("start >= 0").distinct()
    for rank in range(2, ANCHORS + 1):
        more = chosen.filter(F.col("rank") == rank).select("win", "term", "off")
        due = found.join(_small(more), "win", "left").withColumn("pos", F.col("start") + F.col("off"))
        has = index.select("term", "k_id", "k_text", "pos", F.lit(True).alias("has")).distinct()
        due = due.join(has, ["term", "k_id", "k_text", "pos"], "left").filter("term is null or has")
        found = due.select("win", "k_id", "k_text", "start")
    return found


def _terms(chosen: DataFrame) -> DataFrame:
    return chosen.select("term", "occurrences")


def phrases(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(k_id, k_text, hits: array of (win, start, n)): the exact occurrences of windows, a row per document that has any."""
    chosen = anchors(wins, term_counts(docs, wins))
    return _confirmed(docs, wins, chosen, postings(docs, stored(_terms(chosen).distinct(), "index-terms")))


def _confirmed(docs: DataFrame, wins: DataFrame, chosen: DataFrame, index: DataFrame) -> DataFrame:
    """``phrases`` by an index of the anchors."""
    found = starts(index, chosen).join(_small(wins), "win")
    found = found.groupBy("k_id", "k_text").agg(F.collect_set(F.struct("win", "start", "n", "terms")).alias("due"))
    found = stored(found, "index-candidates")
    texts = keyed(docs).join(_small(found.select("k_id", "k_text")), ["k_id", "k_text"], "left_semi").dropDuplicates(["k_id", "k_text"])
    exact = let(F.col("ws"), lambda ws: F.filter("due", lambda d: F.slice(ws, d["start"] + 1, d["n"]) == d["terms"]))
    hits = F.transform(exact, lambda d: F.struct(d["win"].alias("win"), d["start"].alias("start"), d["n"].alias("n")))
    return texts.join(found, ["k_id", "k_text"]).select("k_id", "k_text", hits.alias("hits")).filter(F.size("hits") > 0)


def near(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP, size: int = WHOLE) -> DataFrame:
    """(k_id, k_text, item_id, win, distance): items, or windows of ``size`` words, whose two rarest terms, of those that
    occur in the corpus, come at most ``slop`` words farther apart in a document than in the item, in any order, with the
    least distance; the other terms needn't be there."""
    wins, items = windows(benchmark, size)
    pairs = closest(wins, term_counts(docs, wins), slop)
    return _met(postings(docs, stored(_terms(pairs).distinct(), "index-terms")), pairs).join(items, "win")


def _met(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """(win, k_id, k_text, distance) where both terms of a pair are within reach. Places meet in stretches of that many
    words, so the places of one document are not all held against each other."""
    at = lambda rank, pos: _places(index, pairs.filter(F.col("rank") == rank).drop("rank")).select("win", "reach", "k_id", "k_text", F.col("pos").alias(pos))
    stretch = F.floor(F.col("p") / F.col("reach"))
    one = at(1, "p").distinct().withColumn("s", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
    two = at(2, "q").distinct().withColumn("s", F.floor(F.col("q") / F.col("reach"))).drop("reach")
    met = one.join(two, ["win", "k_id", "k_text", "s"]).withColumn("distance", F.abs(F.col("p") - F.col("q")))
    return met.filter(F.col("distance") <= F.col("reach")).groupBy("win", "k_id", "k_text").agg(F.min("distance").alias("distance"))


def _covered(hits: Column) -> Column:
    """Words in the union of the windows (start, n)."""
    spans = F.array_sort(F.array_distinct(F.transform(hits, lambda h: F.struct(h["start"].alias("a"), (h["start"] + h["n"]).alias("b")))))
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    new = lambda a, s: F.greatest(s["b"] - F.greatest(s["a"], a["end"]), F.lit(0))
    return F.aggregate(spans, begin, lambda a, s: F.struct((a["n"] + new(a, s)).alias("n"), F.greatest(a["end"], s["b"]).alias("end")), lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """k_id, k_text, n_hit, n_items, items_sha256 of the documents with hits."""
    wins, items = windows(benchmark)
    wins = stored(wins, "index-distinct")
    return _hits(phrases(docs, wins), items)


def _hits(found: DataFrame, items: DataFrame) -> DataFrame:
    hits = stored(found, "index-hits")
    of_items = hits.select("k_id", "k_text", F.explode(F.array_distinct(F.transform("hits", lambda h: h["win"]))).alias("win")).join(_small(items), "win")
    listed = of_items.groupBy("k_id", "k_text").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    joined = hits.select("k_id", "k_text", _covered(F.col("hits")).cast("long").alias("n_hit")).join(listed, ["k_id", "k_text"])
    return stored(joined.select("k_id", "k_text", "n_hit", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")), "index-result")


def judge(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row; n_near_items, the items that it is near, and
    ``nearest``, the least distance of their terms. One index of anchors serves both kinds of matches."""
    wins, items = windows(benchmark)
    wins = stored(wins, "index-distinct")
    whole, of_whole = windows(benchmark, WHOLE)
    counts = term_counts(docs, wins)
    chosen, pairs = anchors(wins, counts), closest(whole, counts, slop)
    index = postings(docs, stored(_terms(chosen).union(_terms(pairs)).distinct(), "index-terms"))
    found = _hits(_confirmed(docs, wins, chosen, index), items)
    met = _met(index, pairs).join(_small(of_whole), "win").filter("item_id is not null").groupBy("k_id", "k_text")
    met = stored(met.agg(F.countDistinct("item_id").alias("n_near_items"), F.min("distance").cast("long").alias("nearest")), "index-near")
    rows = docs.select("doc_id", *document_key(docs), F.size(words(text_of(docs))).cast("long").alias("n_words"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(found, ["k_id", "k_text"], "left").join(met, ["k_id", "k_text"], "left").select(
        "doc_id", "n_words", zero("n_hit"), zero("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), zero("n_near_items"), "nearest",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with their columns, that hold no window of the benchmark."""
    found = contamination(docs, benchmark).select(F.col("k_id").alias("c_id"), F.col("k_text").alias("c_text"))
    key_id, key_text = document_key(docs)
    return docs.join(_small(found), (key_id == found["c_id"]) & (key_text == found["c_text"]), "left_anti")


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, len(w[i:i+9]) as n, array_to_string(w[i:i+9], ' ') as k from
  (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as i from b where len(w) > 0)),
sizes as (select distinct n from win),
run as (select rid, i, n, array_to_string(w[i:i+n-1], ' ') as k from
  (select rid, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, sizes where len(w) >= n)),
hit as (select rid, i, run.n, item_id from run join win using (n, k)),
words as (select rid, count(distinct i + j) as n from (select rid, i, unnest(generate_series(0, n - 1)) as j from hit) group by rid),
items as (select rid, list_sort(list_distinct(list(item_id::varchar))) as ids from hit group by rid),
whole as (select row_number() over () as iid, * from (select distinct item_id, w from b where len(w) > 0)),
term as (select iid, unnest(w) as t, generate_subscripts(w, 1) as off from whole),
place as materialized (select rid, t, pos from (select rid, unnest(w) as t, generate_subscripts(w, 1) as pos from d) where t in (select t from term)),
rare as (select iid, t, row_number() over (partition by iid order by n, t) as rank
  from (select distinct iid, t from term) join (select t, count(*) as n from place group by t) using (t)),
pair as (select iid, item_id, x.t as t1, y.t as t2, 20 + min(abs(p.off - q.off)) as reach from whole
  join rare x using (iid) join rare y using (iid) join term p on p.iid = whole.iid and p.t = x.t join term q on q.iid = whole.iid and q.t = y.t
  where x.rank = 1 and y.rank = 2 group by all),
one as materialized (select item_id, reach, t2 as t, rid, pos as p from pair join place on t = t1),
nearby as (select rid, count(distinct item_id) as n, min(abs(p - pos))::bigint as nearest from one join place using (rid, t)
  where abs(p - pos) <= reach and item_id is not null group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(words.n, 0)::bigint as n_hit, coalesce(len(ids), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated,
  coalesce(nearby.n, 0)::bigint as n_near_items, nearest
from d left join words using (rid) left join items using (rid) left join nearby using (rid)
"""
