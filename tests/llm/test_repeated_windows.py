import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_texts import prose

from asterlap.llm import repeated_windows as R
from asterlap.llm.word_hashes import WordHashes, batch_windows, rolling


def brute(texts, size):
    words = [re.findall(r"[^ \t-\r]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = {i + j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(size)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    shared = [prose(1000 + k, rng.randint(20, 60)) for k in range(4)]
    texts = []
    for i in range(n):
        parts = [prose(seed * 100 + i, rng.randint(0, 80))] + rng.sample(shared, rng.randint(0, 2)) + [prose(seed * 100 + i + 50_000, rng.randint(0, 30))]
        texts.append("\n".join(parts))
    return texts + texts[:3] + ["ab " * 200, None, "", "one"]


@pytest.mark.parametrize("chunk_bytes", [700, 12_000_000])
def test_against_brute_force(documents, chunk_bytes):
    texts = corpus(1)
    df = documents([(i, t) for i, t in enumerate(texts)]).repartition(5)
    got = {r.doc_id: r for r in R.removed(df, chunk_bytes=chunk_bytes).collect()}
    for i, (n, cut, kept) in enumerate(brute(texts, 35)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (n, cut, hashlib.sha256(kept.encode()).hexdigest())
    clean = {r.doc_id: r for r in R.cleaned(df, chunk_bytes=chunk_bytes).collect()}
    for i, (n, cut, kept) in enumerate(brute(texts, 35)):
        if n and n == cut:
            assert i not in clean
        else:
            assert clean[i].text == texts[i] if not cut else clean[i].text.split() == kept.split() and clean[i].n_chars == len(clean[i].text)


def test_a_full_sketch_changes_nothing(documents, monkeypatch):
    """A sketch so narrow that every cell is repeated only sends more windows to the exact pass."""
    texts = corpus(2, 30)
    monkeypatch.setattr(R, "CELLS_PER_WORD", 0)
    got = {r.doc_id: r.n_removed for r in R.removed(documents([(i, t) for i, t in enumerate(texts)])).collect()}
    assert [got[i] for i in range(len(texts))] == [cut for _, cut, _ in brute(texts, 35)]


def test_odd_rows(odd, documents):
    df, rows = odd
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in R.removed(df).collect())
    assert got == sorted((str(r[0]), n, cut) for r, (n, cut, _) in zip(rows, brute([r[1] for r in rows], 35)))
    assert R.cleaned(df).columns == df.columns
    assert R.removed(documents([])).count() == 0 and R.cleaned(documents([])).count() == 0


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for n in (1, 5, 10_000):
        x = np.sort(rng.integers(0, 2**24, n).astype(np.uint32))
        assert (R.unpack(R.pack(x)) == x).all()


def test_rolling_hashes_are_those_of_each_window():
    h = np.random.default_rng(2).integers(0, 2**63, 200, dtype=np.uint64)
    for size in (1, 2, 5, 35, 199, 200):
        direct = [sum(int(h[i + j]) * pow(R_BASE, j, 2**64) for j in range(size)) % 2**64 for i in range(201 - size)]
        assert rolling(h, size, R_BASE).tolist() == direct
    assert len(rolling(h, 201, R_BASE)) == 0


R_BASE = 0x9E3779B97F4A7C15


def test_windows_stay_within_their_text_and_memory_is_bounded():
    texts = [b"a b c", b"", b"d e", b"a b c d"]
    words, firsts, starts, pairs = batch_windows(texts, 3, WordHashes(limit=2))
    assert firsts.tolist() == [0, 3, 3, 5] and starts.tolist() == [0, 5, 6]
    assert (pairs[0] == pairs[1]).all() and (pairs[0] != pairs[2]).all()


def test_chunks_that_several_tasks_read(spark, documents):
    """A stored chunk of many row groups is split among tasks, each of which makes a sketch and gets replies of its own."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    changed = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "20"}
    try:
        hadoop.setInt("parquet.block.size", 8000)
        for key, value in changed.items():
            spark.conf.set(key, value)
        texts = corpus(3, 400)
        chunks = R.in_chunks(documents([(i, t) for i, t in enumerate(texts)]).coalesce(1), "of_chunk")
        assert chunks.select("of_chunk").distinct().count() == 1 and chunks.rdd.getNumPartitions() > 4
        got = {r.doc_id: r.n_removed for r in R.removed(documents([(i, t) for i, t in enumerate(texts)]).coalesce(1)).collect()}
    finally:
        hadoop.unset("parquet.block.size")
        for key in changed:
            spark.conf.unset(key)
    assert [got[i] for i in range(len(texts))] == [cut for _, cut, _ in brute(texts, 35)]
