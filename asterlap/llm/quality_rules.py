"""Quality rules: measures of a text, and lines that many documents of one host share.

Normalised lines are hashed; for each host, the distinct documents that have a line are counted; lines that more than a
limit of documents have are removed; a document that this leaves depleted is rejected. A document is known by all its
normalised lines in order, so that copies of a text, which are no evidence of boilerplate, count once, and so do texts
that differ in case or white space alone; any other two documents of a host are distinct, however many lines they share.
Counts are exact: (host, line, document) is reduced first, so a line that all documents of a host have is many keys, and
joins on lines are split by their counted occurrences. Only DataFrame functions are used.

Defined cases: a null text is empty, has no words and fails; null hosts are one host; null IDs are kept as they are;
every row is judged on its own, repeated rows included (as copies they count once); an empty table gives no rows;
columns other than doc_id, text and source are ignored.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CLASS, document_key, join_counted, let, stored, stored_and_measured, table, text_of

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
#: A line that more documents of a host have is removed; a document needs this percentage of its words after that.
MAX_DOCUMENTS = 20
MIN_KEPT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return let(F.btrim(text, F.lit(SPACE)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_CLASS + "+")))


def repeated_words(word_list: Column, window: int = WINDOW) -> Column:
    """Words covered by windows of so many words that the text has twice or more, the first time included."""

    def covered(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(ordered: Column) -> Column:
            equal = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
            return F.filter(ordered, lambda x, k: equal(x, F.get(ordered, k - 1)) | equal(x, F.get(ordered, k + 1)))

        starts = F.array_sort(F.transform(let(ranked, twice), lambda x: x["i"]))
        begin = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(
            starts, begin, lambda a, i: F.struct((a["n"] + F.least(F.lit(window), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    def of(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - window + 1), lambda i: F.xxhash64(F.slice(ws, i, window)))
        return F.when(F.size(ws) <= window, 0).otherwise(
            let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
        )

    return let(word_list, of)


def normal_line(line: Column) -> Column:
    """Lower case, white space as single blanks."""
    return F.trim(F.regexp_replace(F.lower(line), SPACE_CLASS + "+", " "))


def profiles(docs: DataFrame) -> DataFrame:
    """A row per document: its measures, its host, the hash and number of words of every line with a word, and ``doc``,
    which rows of a host share whose lines are equal."""
    text = text_of(docs)
    split = docs.select(
        "doc_id", *document_key(docs), text.alias("t"), F.coalesce(docs["source"], F.lit("")).alias("host"), words(text).alias("ws"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]")).alias("ls"),
    )
    line = lambda x: let(normal_line(x), lambda n: F.struct(F.substring(F.md5(n), 1, 16).alias("h"), F.size(F.split(n, " ")).alias("w")))
    measured = split.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "k_id", "k_text", "host", F.size("ws").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("ws")).cast("long").alias("n_repeat_words"),
        F.transform("ls", line).alias("lines"),
    )
    return measured.withColumn("doc", F.xxhash64("host", F.transform("lines", lambda x: x["h"])))


def frequent_lines(lines: DataFrame, limit: int) -> DataFrame:
    """host, h, occurrences of the lines (host, h, doc) that more than ``limit`` distinct documents of a host have."""
    documents = lines.groupBy("host", "h", "doc").agg(F.count(F.lit(1)).alias("n"))
    counted = documents.groupBy("host", "h").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("occurrences"))
    return counted.filter(F.col("documents") > limit).select("host", "h", "occurrences")


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select("row", "host", "doc", F.explode("lines").alias("l")).select("row", "host", "doc", "l.h", "l.w")


def _verdict(rows: DataFrame, removed: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    return (
        rows.join(removed, "row", "left").withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (100 * left >= MIN_KEPT_PERCENT * F.col("n_words")))
    )


def _taken(docs: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Stored profiles, and their lines above the limit."""
    rows, seen = stored_and_measured(profiles(docs), "quality-profiles", n=F.sum(F.size("lines")))
    lines = _lines(rows)
    frequent = stored(frequent_lines(lines, limit), "quality-frequent")
    return rows, join_counted(lines, frequent, ["host", "h"], "occurrences", seen["n"] or 0)


def judge(docs: DataFrame, limit: int = MAX_DOCUMENTS) -> DataFrame:
    """Each row's measures, the words that the removal of lines takes (n_line_words), and the verdict."""
    rows, taken = _taken(docs, limit)
    removed = taken.groupBy("row").agg(F.sum("w").alias("n_line_words"))
    return _verdict(rows, removed).drop("row", "k_id", "k_text", "host", "lines", "doc")


def clean(docs: DataFrame, limit: int = MAX_DOCUMENTS) -> DataFrame:
    """The documents that stay, with their columns, without the lines above the limit. n_chars, if there is such a
    column, is counted anew; texts without such lines are unchanged."""
    rows, taken = _taken(docs, limit)
    removed = taken.groupBy("row").agg(F.sum("w").alias("n_line_words"), F.collect_set("h").alias("v_lines"))
    stays = _verdict(rows, removed).filter("kept").groupBy("k_id", "k_text", "host").agg(F.max("v_lines").alias("v_lines"))
    stays = stays.select(*[F.col(c).alias(f"v_{c}") for c in ("k_id", "k_text", "host")], "v_lines")
    key = dict(zip(("v_k_id", "v_k_text"), document_key(docs)))
    on = [stays[c] == k for c, k in key.items()] + [stays["v_host"] == F.coalesce(docs["source"], F.lit(""))]
    joined = docs.join(stays, on)
    line = lambda x: ~F.array_contains(stays["v_lines"], F.substring(F.md5(normal_line(x)), 1, 16))
    text = F.when(stays["v_lines"].isNull(), docs["text"]).otherwise(F.array_join(F.filter(F.split(docs["text"], "\n"), line), "\n"))
    values = {"text": text, "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return joined.select(*[values.get(c, docs[f"`{c}`"]).alias(c) for c in docs.columns])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t, coalesce(source, '') as host from documents),
ws as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
win as (select rid, unnest(generate_series(1, len(w) - 7)) as i, w from ws where len(w) >= 8),
hashed as (select rid, i, array_to_string(w[i:i+7], ' ') as h from win),
again as (select rid, i, count(*) over (partition by rid, h) as n from hashed),
covered as (select rid, count(distinct i + k) as n from again, (select unnest(generate_series(0, 7)) as k) where n > 1 group by rid),
line as (select rid, host, k, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) as l
  from (select rid, host, generate_subscripts(ls, 1) as k, unnest(ls) as l from ws)),
occ as (select rid, host, k, md5(l) as h, len(string_split(l, ' ')) as w from line),
known as (select rid, md5(string_agg(h, '' order by k)) as doc from occ group by rid),
frequent as (select host, h from occ join known using (rid) group by host, h having count(distinct doc) > 20),
removed as (select rid, sum(w) as n from occ join frequent using (host, h) group by rid),
m as (select ws.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
  coalesce(c.n, 0)::bigint as n_repeat_words, coalesce(r.n, 0)::bigint as n_line_words
  from ws left join covered c using (rid) left join removed r using (rid)),
f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select *, not base_failed and 100 * (n_words - n_line_words) >= 30 * n_words as kept from f
"""
