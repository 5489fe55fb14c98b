import hashlib
import random
import re
from collections import Counter

import pytest
from llm_texts import prose

from asterlap.llm import positional_index as P


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    wins = {(i, tuple(w[k : k + 10])) for i, t in items for w in [words(t)] if w for k in range(max(1, len(w) - 9))}
    out = []
    for _, text in docs:
        ws, hit, found = words(text), set(), set()
        for i, win in wins:
            for s in range(len(ws) - len(win) + 1):
                if tuple(ws[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(i)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, win int, terms string")


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def expected(docs, items):
    return sorted((str(d[0]), *b) for d, b in zip(docs, brute([d[:2] for d in docs], items)))


def test_against_brute_force(spark, documents):
    rng = random.Random(4)
    items = [(i, prose(i, rng.randint(1, 40))) for i in range(25)] + [(30, "É Ü straße"), (31, "a"), (32, prose(3, 40)), (33, None), (34, "..."), (5, prose(5, 12)), (None, prose(60, 11))]
    docs = []
    for i in range(120):
        text = prose(500 + i, rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items)[1] or ""
            ws = item.split()
            cut = rng.randint(0, max(0, len(ws) - 10))
            text += " " + rng.choice([item.upper(), " - ".join(ws[cut : cut + rng.randint(5, 14)]), item[::-1]]) + " É Ü straße"[: rng.choice([0, 12])]
        docs.append((i, text))
    got = result(P.judge(documents(docs), benchmark(spark, items)))
    assert got == expected(docs, items) and sum(r[-1] for r in got) > 30
    clean = {r.doc_id for r in P.clean(documents(docs), benchmark(spark, items)).collect()}
    assert clean == {int(r[0]) for r in got if not r[-1]}


def test_beyond_the_broadcast_bound(spark, documents, monkeypatch):
    monkeypatch.setattr(P, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(P, "PART", 3)
    monkeypatch.setattr("asterlap.llm.common.FEW_ROWS", 0)
    items = [(1, prose(1, 30)), (2, "common words here")]
    docs = [(i, prose(i, 30) + " common words here" * (i % 2)) for i in range(30)]
    assert result(P.judge(documents(docs), benchmark(spark, items))) == expected(docs, items)


def test_proximity(spark, documents):
    items = [(1, "alpha filler filler filler filler filler filler filler filler omega")]
    noise = [(10 + i, "filler " * 30) for i in range(3)]
    docs = [(1, "x " * 5 + "omega " + "y " * 7 + "alpha"), (2, "alpha " + "y " * 40 + "omega"), (3, "alpha beta"), *noise]
    wins, _ = P.windows(benchmark(spark, items))
    got = P.near(documents(docs), benchmark(spark, items), slop=20).select("k_id", "item_id", "distance").collect()
    assert [tuple(r) for r in got] == [(1, 1, 8)] and wins.count() == 1


def test_odd_rows(spark, odd, documents):
    df, rows = odd
    items = [(1, prose(1)), (2, "one two"), (3, "x" * 30_000)]
    assert result(P.judge(df, benchmark(spark, items))) == expected(rows, items)
    assert P.clean(df, benchmark(spark, items)).columns == df.columns
    assert result(P.judge(df, benchmark(spark, []))) == expected(rows, [])
    assert P.judge(documents([]), benchmark(spark, items)).count() == 0 and P.clean(documents([]), benchmark(spark, items)).count() == 0


def test_proximity_of_items_with_words_the_corpus_lacks(spark, documents):
    items = [(1, "alpha missing omega common common"), (2, "alpha missing"), (3, "missing absent")]
    docs = [(1, "omega " + "common " * 5 + "alpha"), (2, "alpha " + "common " * 40 + "omega")]
    got = P.near(documents(docs), benchmark(spark, items), slop=20).select("k_id", "item_id", "distance").collect()
    assert [tuple(r) for r in got] == [(1, 1, 6)]
    assert P.phrases(documents(docs), P.windows(benchmark(spark, items))[0]).count() == 0


def brute_near(docs, items, slop):
    """n_near_items and nearest of every document, all places of the two terms of every item held against each other."""
    texts = [words(t) for _, t in docs]
    counts = Counter(w for ws in texts for w in ws)
    out = [(set(), []) for _ in docs]
    for i, t in items:
        ws = words(t)
        pair = sorted({w for w in ws if counts[w]}, key=lambda w: (counts[w], w.encode()))[:2]
        if len(pair) < 2 or i is None:
            continue
        places = lambda text, word: [k for k, w in enumerate(text) if w == word]
        apart = lambda text: min((abs(p - q) for p in places(text, pair[0]) for q in places(text, pair[1])), default=None)
        for (near, least), text in zip(out, texts):
            d = apart(text)
            if d is not None and d <= slop + apart(ws):
                near.add(i)
                least.append(d)
    return [(len(near), min(least, default=None)) for near, least in out]


@pytest.mark.parametrize("small", [True, False])
def test_proximity_against_brute_force(spark, documents, monkeypatch, small):
    if not small:
        monkeypatch.setattr(P, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(P, "PART", 3)
        monkeypatch.setattr("asterlap.llm.common.FEW_ROWS", 0)
    rng = random.Random(9)
    some = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(rng.choices(some + ["absent", "the"], k=rng.randint(1, 25)))) for i in range(20)] + [(3, "w1 w2 w1"), (None, "w3 w4"), (40, "the the")]
    docs = [(i, " ".join(rng.choices(some, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 90)))) for i in range(50)] + [(60, None), (61, "the " * 200 + "w1")]
    got = {r.doc_id: (r.n_near_items, r.nearest) for r in P.judge(documents(docs), benchmark(spark, items), slop=3).collect()}
    want = brute_near(docs, items, 3)
    assert [got[i] for i, _ in docs] == want and 20 < sum(n > 0 for n, _ in want) < 52
