import math
import random
import re

import numpy as np
import pytest
from llm_texts import prose

from asterlap.llm import term_pipeline as T


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ws in asked.items():
        weights = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for w in ws if (df := sum(w in d for _, d in held))}
        scored = []
        for i, d in held:
            m = 100 - 90 + 90 * len(d) * n // total
            s = sum(w * (10**9 * tf // (1000 * tf + 8 * m)) for t, w in weights.items() if (tf := d.count(t)))
            if s > 0:
                scored.append((-s, i is not None, i or 0))
        out += [(item, k, i if known else None, -s) for k, (s, known, i) in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x", "y", 3) for i, t in items], "item_id long, text string, term string, shard string, block int")


def corpus(n, seed=0):
    rng = random.Random(seed)
    common = [w.strip(".") for w in prose(1, 12).split()]
    rare = [w.strip(".") for w in prose(2, 300).split()]
    return [(i, " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(rng.randint(1, 60)))) for i in range(n)]


def queries():
    rng = random.Random(9)
    both = prose(1, 12).split() + prose(2, 300).split()
    return [(i, " ".join(rng.choice(both).upper() for _ in range(rng.randint(1, 25)))) for i in range(20)]


@pytest.mark.parametrize("limits", [{}, {"VOCABULARY_BYTES": 0, "ITEM_BLOCK": 3}])
def test_against_brute_force(spark, documents, odd, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(T, name, value)
    docs = corpus(400) + [r[:2] for r in odd[1]] + [(900, "É Ü straße ABC123"), (900, "É Ü straße ABC123"), (None, "É"), (901, "a_b`c")]
    items = queries() + [(None, "é É"), (3, "straße abc123"), (60, None), (61, "..."), (62, "unheard-of"), (63, "A B c"), (5, None), (64, prose(1))]
    got = result(T.search(documents(docs).repartition(5), benchmark(spark, items)))
    assert got == brute(docs, items) and len(got) > 150


def test_empty_tables(spark, documents):
    assert result(T.search(documents([]), benchmark(spark, queries()))) == []
    assert result(T.search(documents(corpus(5)), benchmark(spark, []))) == []
    assert result(T.search(documents([(1, None), (2, "-")]), benchmark(spark, queries()))) == []


def test_nothing_that_could_rank_is_left_out():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size = 300
        terms = [{"term": bytes([k]), "w": int(w), "stage": k % 4} for k, w in enumerate(rng.integers(0, 4000, 12))]
        impacts = {t["term"]: (d := np.sort(rng.choice(size, rng.integers(1, size), replace=False)), rng.integers(1, T.LARGEST, len(d))) for t in terms}
        docs, scores = np.empty(0, np.int32), np.empty(0, np.int64)
        for stage in range(4):
            docs, scores = T.advance(docs, scores, terms, stage, {t["term"]: impacts[t["term"]] for t in terms if t["stage"] == stage}, size)
        whole = np.zeros(size, np.int64)
        for t in terms:
            whole[impacts[t["term"]][0]] += t["w"] * impacts[t["term"]][1]
        best = np.sort(whole[whole > 0])[::-1][: T.TOP]
        assert (np.sort(scores)[::-1][: len(best)] == best).all() and (whole[docs] == scores).all()
        assert set(np.flatnonzero(whole >= best[-1])) <= set(docs.tolist())
