import random
from collections import Counter

import numpy as np
from llm_texts import prose

from asterlap.llm import dart_minhash as D
from asterlap.llm.components import components


def shingles(text):
    w = (text or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """Least ID of each row's class by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = sum((sets[i] & sets[j]).values())
            if sets[i] and sets[j] and common >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = least.setdefault(find(i), [])
        if doc_id is not None:
            ids.append(doc_id)
    return [min(least[find(i)], default=None) for i in range(len(rows))]


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    texts = [prose(i, rng.randint(1, 150)) for i in range(60)]
    texts += [edited(t, rng, rng.randint(1, 6)) for t in texts[:40] for _ in range(rng.randint(1, 3))]
    base = prose(777, 200)
    texts += [edited(base, rng, rng.randint(2, 5)) for _ in range(70)]  # copies of a copy: many pairs near the limit
    chain = prose(778, 160)
    for _ in range(25):
        chain = edited(chain, rng, 2)
        texts.append(chain)
    texts += texts[:5] + ["w " * 80, "w " * 70, "one two three", "one two three", "one  two\nthree"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_classes_are_those_of_all_pairs(documents):
    rows = corpus()
    got = {r.doc_id: r.class_id for r in D.classes(documents(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_no_link_is_lost_when_turns_go_on(documents, monkeypatch):
    monkeypatch.setattr(D, "OPEN_PER_TEXT", 0)
    rows = corpus()[:150]
    got = {r.doc_id: r.class_id for r in D.classes(documents(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_no_link_is_lost_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(D, "SMALL_BUCKET", 1)
    monkeypatch.setattr(D, "BLOCK", 7)
    monkeypatch.setattr(D, "OPEN_PER_TEXT", 10**6)
    rows = corpus()[:150]
    got = {r.doc_id: r.class_id for r in D.classes(documents(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_tallies_bound_the_similarity():
    rng = np.random.default_rng(4)
    for _ in range(300):
        ids = np.unique(rng.integers(1, 2**63, rng.integers(1, 900), dtype=np.uint64))
        a, b = (ids[rng.random(len(ids)) < 0.9] for _ in range(2))
        if len(a) and len(b) and D.jaccard(a, b) >= 0.8:
            assert D.may_be_near(D.tally(a), D.tally(b)[None])[0]
    many = np.arange(256, 256 * 70_000, 256, dtype=np.uint64)
    assert D.may_be_near(D.tally(many), D.tally(many[:60_000])[None])[0]
    assert not D.may_be_near(D.tally(np.arange(80, dtype=np.uint64)), D.tally(np.arange(60, dtype=np.uint64))[None])[0]


def test_one_document_of_each_class_stays(documents):
    rows = corpus()
    kept = [r.doc_id for r in D.one_of_each(documents(rows + [rows[0], rows[0]])).collect()]
    assert sorted(kept) == sorted(set(brute(rows)))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    for n, scale in ((4, 1), (60, 1), (700, 1), (60, 3.7)):
        got, true = [], []
        for _ in range(30):
            ids = rng.integers(1, 2**63, n, dtype=np.uint64)
            a, b = (rng.random(n) * scale + 0.05 for _ in range(2))
            b = np.where(rng.random(n) < 0.8, a, b)
            one, two = D.signatures_of([(ids, a), (ids[::-1], b[::-1])])
            got.append((one == two).mean())
            true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(np.mean(got) - np.mean(true)) < 0.03


def test_a_signature_depends_on_the_set_alone():
    ids, weights = np.arange(1, 9, dtype=np.uint64), np.arange(1.0, 9.0)
    alone = D.signatures_of([(ids, weights)])[0]
    among = D.signatures_of([(ids[:2], weights[:2]), (ids[::-1], weights[::-1]), (ids + np.uint64(50), weights)])[1]
    assert (alone == among).all()


def test_odd_rows(odd, documents):
    df, rows = odd
    got = sorted((str(r.doc_id), str(r.class_id)) for r in D.classes(df).collect())
    expected = [d if not (t or "").split() else c for (d, t), c in zip([r[:2] for r in rows], brute([r[:2] for r in rows]))]
    assert got == sorted((str(r[0]), str(c)) for r, c in zip(rows, expected))
    kept = D.one_of_each(df)
    assert kept.columns == df.columns and kept.filter("doc_id = 3 or doc_id = 4").count() == 0
    assert D.classes(documents([])).count() == 0 and D.one_of_each(documents([])).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 90)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.u: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
