"""WARC archives without repeated payloads: revisit records that point to the response holding the payload.

Headers (key, payload digest, length) are reduced by digest to the response that stands for each repeated payload; every
record is joined to it on the digest, and archives are written with fresh headers: a response with its payload, or a
revisit (profile identical-payload-digest) whose block is the HTTP header alone. All of it is DataFrame work: a record
is a row of Spark's text files, whose line separator ends a record as WARC does (CR LF CR LF). Every record's header
begins with the archive's own random identifier, so the reader can cut files of any size at record starts wherever a
split begins, without taking bytes of a payload for one; it checks each Content-Length.

Defined cases: a null payload is empty; a null ID is written as "-", comes back null and is never the largest; records
with equal payloads and the same largest ID are all responses; payloads below the least length are all responses; null
URLs are empty; CR and LF in a URL are percent-encoded; an empty table gives empty archives; other columns are ignored.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_limit, scratch, stored, table

MIN_BYTES = 1000
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(rows: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """key, url, payload, payload_bytes, digest of any table of pages."""
    body = F.coalesce(rows[payload].cast("binary"), F.lit("").cast("binary"))
    link = F.regexp_replace(F.regexp_replace(F.coalesce(rows[url], F.lit("")), "\r", "%0D"), "\n", "%0A")
    return rows.select(
        rows[key].cast("long").alias("key"), link.alias("url"), body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body).alias("digest"),
    )


def responses(recs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """digest, the key and URL of the record that holds its payload, and the number of records, where there are several."""
    heads = recs.filter(F.col("payload_bytes") >= min_bytes).select("digest", "key", "url")
    largest = F.max(F.struct(F.coalesce("key", F.lit(-(2**63))).alias("key"), "url"))
    found = heads.groupBy("digest").agg(largest.alias("top"), F.max("key").alias("top_key"), F.count(F.lit(1)).alias("n"))
    return found.filter((F.col("n") > 1) & F.col("top_key").isNotNull()).select("digest", "top_key", F.col("top.url").alias("top_url"), "n")


def resolved(recs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Each record with top_key and top_url of the response it revisits, null if it is a response.

    Payloads move at most once. Digests of very many records, whose number is bounded by the number of partitions, are
    looked up by a broadcast, and so a revisit of one carries no payload into the shuffle of the rest."""
    spark = recs.sparkSession
    tops = stored(responses(recs, min_bytes), "warc-responses")
    total = tops.agg(F.sum("n")).first()[0] or 0
    limit = hot_limit(spark, total)
    hot, cold = tops.filter(F.col("n") > limit).drop("n"), tops.filter(F.col("n") <= limit).drop("n")
    older = lambda top: F.col(top).isNotNull() & (F.coalesce(F.col("key") < F.col(top), F.lit(True)))
    hot = hot.select("digest", F.col("top_key").alias("hot_key"), F.col("top_url").alias("hot_url"))
    large = F.col("payload_bytes") >= min_bytes
    first = (
        recs.withColumn("look", F.when(large, F.col("digest")))
        .join(F.broadcast(hot.withColumnRenamed("digest", "look")), "look", "left")
    )
    first = first.withColumn("payload", F.when(~older("hot_key"), F.col("payload")))
    found = F.col("hot_key").isNotNull()
    # Records that need no further look-up are dealt out by a hash of their own instead of by a digest.
    alone = F.concat(F.lit("-"), F.xxhash64("key", "url", "digest").cast("string"))
    second = (
        first.withColumn("look", F.when(found | F.col("look").isNull(), alone).otherwise(F.col("look")))
        .join(cold.withColumnRenamed("digest", "look"), "look", "left")
    )
    key, url = F.coalesce("hot_key", "top_key"), F.coalesce("hot_url", "top_url")
    second = second.withColumn("top_key", key).withColumn("top_url", url)
    return second.select(
        "key", "url", F.when(~older("top_key"), F.col("payload")).alias("payload"), "payload_bytes", "digest",
        F.when(older("top_key"), F.col("top_key")).alias("top_key"), F.when(older("top_key"), F.col("top_url")).alias("top_url"),
    )


def _record_id(archive: str, key: Column) -> Column:
    return F.concat(F.lit(f"<urn:x-page:{archive}:"), F.coalesce(key.cast("string"), F.lit("-")), F.lit(">"))


def write_archives(recs: DataFrame, path: str, compression: str = "gzip") -> str:
    """Writes resolved records as WARC/1.1 files below ``path``; returns the identifier that readers need."""
    archive = str(uuid.uuid4())
    revisit = F.col("top_key").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.concat(http.cast("binary"), F.coalesce("payload", F.lit("").cast("binary")))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    refers = F.concat(
        line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(archive, F.col("top_key"))),
        line("WARC-Refers-To-Target-URI", F.col("top_url")), line("WARC-Refers-To-Date", now),
    )
    header = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Warcinfo-ID: <urn:uuid:{archive}>\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(archive, F.col("key"))), line("WARC-Date", now), line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), F.when(revisit, refers).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    whole = F.concat(header.cast("binary"), block).cast("string").alias("value")
    recs.select(whole).write.option("lineSep", END).option("compression", compression).text(path)
    return archive


def read_archives(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """A row per record: record_type, key, refers_to, url, digest as in the header, payload_bytes, payload (null for a
    revisit). A record that isn't as long as its header says, or whose payload has another digest, fails the job."""
    start = f"WARC/1.1\r\nWARC-Warcinfo-ID: <urn:uuid:{archive}>\r\n"
    rows = spark.read.option("lineSep", END + start).text(path).select(F.col("value").cast("binary").alias("v"))
    # The first record of a file still has its own start, the last one its end.
    first = F.substring("v", 1, len(start)) == F.lit(start).cast("binary")
    v = F.when(first, F.expr(f"substring(v, {len(start) + 1})")).otherwise(F.col("v"))
    rows = rows.select(v.alias("v"))
    cut = F.expr("locate('\\r\\n\\r\\n', decode(v, 'iso-8859-1'))")
    rows = rows.select("v", cut.alias("cut"))
    rows = rows.select(F.expr("decode(substring(v, 1, cut + 1), 'utf-8')").alias("head"), F.expr("substring(v, cut + 4)").alias("rest"))
    field = lambda name, pattern: F.regexp_extract("head", f"(?md)^{name}: {pattern}\r$", 1)
    rows = rows.select(
        field("WARC-Type", "(\\w+)").alias("record_type"), field("WARC-Record-ID", f"<urn:x-page:{archive}:(-?\\d*)>").alias("key"),
        field("WARC-Refers-To", f"<urn:x-page:{archive}:(-?\\d+)>").alias("refers_to"), field("WARC-Target-URI", "(.*)").alias("url"),
        field("WARC-Payload-Digest", "sha1:(\\w+)").alias("digest"), field("Content-Length", "(\\d+)").cast("int").alias("length"), "rest",
    )
    number = lambda c: F.when(F.col(c).rlike("\\d"), F.col(c).cast("long")).alias(c)
    # The block is as long as the header says; only a file's last record is followed by its end mark.
    whole = (F.octet_length("rest") == F.col("length")) | (F.octet_length("rest") == F.col("length") + len(END))
    block = F.when(whole, F.expr("substring(rest, 1, length)")).otherwise(F.raise_error(F.lit("a WARC record has another length than its header says")))
    rows = rows.select("record_type", number("key"), number("refers_to"), "url", "digest", block.alias("block"))
    rows = rows.select("*", F.expr("locate('\\r\\n\\r\\n', decode(substring(block, 1, 4096), 'iso-8859-1'))").alias("cut"))
    http, body = F.expr("decode(substring(block, 1, cut + 1), 'utf-8')"), F.expr("substring(block, cut + 4)")
    full = F.regexp_extract(http, "(?md)^Content-Length: (\\d+)\r$", 1).cast("long")
    response = F.col("record_type") == "response"
    same = (F.sha1(body) == F.col("digest")) & (F.octet_length(body) == full)
    payload = F.when(response & ~same, F.raise_error(F.lit("a payload differs from its digest")).cast("binary")).when(response, body)
    return rows.select("record_type", "key", "refers_to", "url", "digest", full.alias("payload_bytes"), payload.alias("payload"))


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    archive = write_archives(resolved(records(table(spark, sf_dir, "pages"), "page_id", "url", "html")), path)
    # Reading the payload has its digest checked.
    read = read_archives(spark, path, archive).withColumn("stored_bytes", F.octet_length("payload").cast("long"))
    return read.select(
        F.col("key").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "stored_bytes",
    )


ORACLE_SQL = r"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
r as (select page_id, octet_length(b)::bigint as payload_bytes, sha1(b) as payload_digest from p),
t as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as top from r),
s as (select *, coalesce(top is not null and coalesce(page_id < top, true), false) as again from t)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
  case when again then top end as refers_to, case when not again then payload_bytes end as stored_bytes from s
"""
