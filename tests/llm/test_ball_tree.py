import math

import numpy as np
import pytest

from asterlap.llm import ball_tree as B

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, v int, leaf int, shard string"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r", 2, 3, "s") for i, v in rows], SCHEMA)


def brute(rows):
    valid = [(n, i, [math.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in valid:
        if i is None or i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for m, j, v in valid if m != n]
        out += [(i, k, None if null else j, -s) for k, (s, null, j) in enumerate(sorted(scored)[:5], 1)]
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def some(n, seed, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return (centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.3).astype(np.float32)


@pytest.mark.parametrize("limits", [{}, {"SMALL_SHARD": 100}, {"SHARD_ROWS": 90, "SMALL_SHARD": 500, "QUERY_GROUP": 3}])
def test_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(B, name, value)
    rows = [(i * 10, v.tolist()) for i, v in enumerate(some(900, 1))]
    copy = rows[7][1]
    rows += [(10_001 + i, copy) for i in range(400)] + [(50, copy), (50, copy), (None, copy), (None, rows[3][1])]
    rows += [(20_000, None), (20_050, [None] * 16), (20_100, [float("nan")] * 16), (20_150, [float("inf")] + [0.0] * 15), (20_200, []), (20_250, [1.0, -2.0]), (20_300, [0.0] * 16)]
    assert result(B.nearest(embeddings(spark, rows))) == brute(rows)


def test_large_components(spark):
    rows = [(i * 25, [float(v) * 1e6 for v in x]) for i, x in enumerate(some(60, 2, 4))]
    assert result(B.nearest(embeddings(spark, rows))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(50, [1.0, 2.0])], [(1, [1.0]), (2, [2.0])]])
def test_few_rows(spark, rows):
    assert result(B.nearest(embeddings(spark, rows))) == brute(rows)


def test_bounds_leave_points_out():
    points = (some(20_000, 3, 8) * 256).astype(np.int64)
    tree = B.BallTree.of(points, np.arange(20_000), np.arange(20_000))
    block = B.Block(tree.rids[:50], tree.ids[:50], tree.points[:50])
    first = tree.search(block)
    assert first < 50 * 20_000 / 3
    scores = tree.points[:50] @ points.T
    scores[np.arange(50), tree.rids[:50]] = -(2**60)
    assert (np.sort(scores, axis=1)[:, ::-1][:, :5] == block.scores).all()
    shared = B.Block(tree.rids[:50], tree.ids[:50], tree.points[:50], np.repeat(block.scores[:, -1:], 5, axis=1))
    assert tree.search(shared) < first  # k-th scores known before leave out more


def test_packing_keeps_everything():
    points = (some(500, 4) * 256).astype(np.int64)
    tree = B.BallTree.of(points, np.arange(500), np.arange(500)[::-1].copy())
    again = B.BallTree.unpacked(tree.packed())
    assert all((getattr(tree, f) == getattr(again, f)).all() for f in B.BallTree.FIELDS)
