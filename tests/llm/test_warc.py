import hashlib

from asterlap.llm import warc_revisits as W


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, `key` int")


def read_back(spark, tmp_path, rows, **options):
    path = f"file://{tmp_path}/warc"
    archive = W.write_archives(W.resolved(W.records(pages(spark, rows), "page_id", "url", "html")), path, **options)
    return path, archive


def test_revisits_point_to_the_largest_id(spark, tmp_path):
    big, small = "é" * 600, "s" * 999
    rows = [(1, "http://a/\r\nX: y", big, "", 0), (5, "http://b", big, "", 0), (3, None, big, "", 0), (5, "http://b", big, "", 0), (None, "http://n", big, "", 0),
            (7, "http://s", small, "", 0), (8, "http://s", small, "", 0), (9, "u", None, "", 0), (10, "u", "", "", 0)]
    path, archive = read_back(spark, tmp_path, rows)
    got = sorted(((r.key, r.record_type, r.refers_to, r.payload_bytes, r.url, r.digest) for r in W.read_archives(spark, path, archive).collect()), key=str)
    digest = hashlib.sha1(big.encode()).hexdigest()
    assert [g for g in got if g[5] == digest] == sorted([
        (1, "revisit", 5, 1200, "http://a/%0D%0AX: y", digest), (3, "revisit", 5, 1200, "", digest), (None, "revisit", 5, 1200, "http://n", digest),
        (5, "response", None, 1200, "http://b", digest), (5, "response", None, 1200, "http://b", digest),
    ], key=str)
    assert sorted((g[0], g[1], g[3]) for g in got if g[5] != digest) == [(7, "response", 999), (8, "response", 999), (9, "response", 0), (10, "response", 0)]


def test_payloads_come_back_whole_from_any_split(spark, tmp_path):
    nasty = ["a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "\r\n\r\n", "\r\n" * 900, "\x00ü" * 700, "x" * 200_000]
    rows = [(i, f"u{i}", h, "", 0) for i, h in enumerate(nasty * 3)]
    path, archive = read_back(spark, tmp_path, rows, compression="none")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = W.read_archives(spark, path, archive).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 15
    for r in got:
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload).decode() == rows[r.key][2]


def test_hot_payload(spark, tmp_path):
    rows = [(i, f"u{i}", "h" * 2000 if i % 3 else f"{i} " * 900, "", 0) for i in range(900)]
    path, archive = read_back(spark, tmp_path, rows)
    got = W.read_archives(spark, path, archive)
    assert got.filter("refers_to = 899 and record_type = 'revisit'").count() == 599
    assert got.filter("record_type = 'response'").count() == 301


def test_no_pages(spark, tmp_path):
    path, archive = read_back(spark, tmp_path, [])
    assert W.read_archives(spark, path, archive).count() == 0
