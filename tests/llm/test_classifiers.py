import zlib

import numpy as np
import pytest
from llm_texts import prose

from asterlap.llm import quality_ftrl as Q
from asterlap.llm import toxicity as X
from asterlap.llm.learning import training_sample
from asterlap.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.1"


def labelled(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, quality int, toxic int, text int")


def corpus(n=600):
    docs, labels = [], []
    for i in range(n):
        toxic, bad = i % 4 == 0, i % 5 == 1
        text = prose(i, 40) + (f" zorgle{i % 7} " if toxic else " ") + prose(i + 10_000, 30)
        docs.append((i, text.upper().replace(" ", "!! ") if bad else text))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_on_held_out_rows(spark, documents):
    docs, labels = corpus()
    got = {r.doc_id: r.score for r in Q.score(documents(docs), Q.train(documents(docs), labelled(spark, labels))).collect()}
    assert np.mean([(got[i] >= Q.THRESHOLD) == y for i, y, _ in labels if out(i)]) > 0.97


def test_toxicity_on_held_out_rows(spark, documents):
    docs, labels = corpus(1200)
    model, limits = X.train(documents(docs), labelled(spark, labels))
    got = {r.doc_id: r.score for r in X.score(documents(docs), model).collect()}
    assert np.mean([(got[i] >= 0.5) == y for i, _, y in labels if out(i)]) > 0.93
    assert set(limits) == {"en"} and 0 < limits["en"] < 1


@pytest.mark.parametrize("train,score", [(Q.train, Q.score), (lambda d, x: X.train(d, x)[0], X.score)])
def test_odd_rows(spark, odd, documents, train, score):
    df, rows = odd
    labels = labelled(spark, [(i, i % 2, i % 2) for i in range(1, 10)] + [(3, 1, 1), (None, 1, 1), (4, None, None), (5, 7, 7)])
    for given in (labels, labelled(spark, [])):
        model = train(df, given)
        got = score(df, model).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r.score <= 1 for r in got)
        assert score(documents([]), model).count() == 0


def test_scores_depend_on_the_text_alone(spark, documents):
    docs, labels = corpus(200)
    model = X.train(documents(docs), labelled(spark, labels))[0]
    weights = Q.train(documents(docs), labelled(spark, labels))
    other = documents([(i + 5000, t, "elsewhere") for i, t in docs])
    for model, score in ((model, X.score), (weights, Q.score)):
        one, two = ({r.doc_id: r.score for r in score(d, model).collect()} for d in (documents(docs), other.withColumnRenamed("lang", "l").withColumn("lang", other["source"])))
        assert all(abs(one[i] - two[i + 5000]) < 1e-6 for i in one)


def test_the_sample_is_bounded_and_leaves_out_the_held_out_fold(spark, documents):
    docs, labels = corpus(2000)
    got = training_sample(documents(docs + [docs[0]] * 5), labelled(spark, labels), "toxic", 200).collect()
    assert 130 < len(got) < 270 and not any(out(r.doc_id) for r in got)
    assert 0.35 < np.mean([r.y for r in got]) < 0.65


def test_dot_products_match_the_sparse_vectors():
    words = Q.WordFeatures(Q.features)
    texts = [b"a b b C!! 12", b"", b"x"]
    weights = np.random.default_rng(1).normal(size=(1 << Q.BITS) + 1)
    counts, hashes = Q.split_batch(texts, words)
    got = Q.dot(weights, hashes, counts)
    for t, g in zip(texts, got):
        where, value = Q.sparse(Q.split_batch([t], words)[1])
        assert abs(g - (weights[where] @ value + weights[-1])) < 1e-9


def test_padding_keeps_texts_apart():
    model, rng = X.new_model(), np.random.default_rng(1)
    texts = [rng.integers(0, 1 << X.BITS, (n, 2)) for n in (5, 0, 1, 40)]
    counts = np.array([len(t) for t in texts])
    together = X.scores(model, np.concatenate(texts), counts)
    assert np.allclose(together, X.scores(model, np.concatenate(texts), counts, size=1), atol=1e-6)
    assert np.allclose(together, [X.scores(model, t, np.array([len(t)]))[0] for t in texts], atol=1e-6)


@pytest.mark.parametrize("name,label,least", [("op9_quality_ftrl", "quality", 0.97), ("op2_toxicity", "toxic", 0.97)])
def test_held_out_accuracy_of_the_queries(spark, name, label, least):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = QUERIES[name](spark, FOLDER).join(labels, "doc_id").filter("held_out").selectExpr(f"avg(int(predicted = {label}))").first()
    assert got[0] > least


def test_shapes_are_those_of_whole_words():
    assert Q.features(b"x" * 64 + b"9A!!!") == (b"x" * 64 + b"9a!!!", b"a0A!!")


def plain_score(model, text):
    """The classifier's formula word by word, filter by filter, with zero vectors beside the text."""
    zero = np.zeros(X.DIM)
    vectors = [model["emb"][a].astype(float) + model["emb"][b] for a, b in text]
    run = [*vectors, zero, zero]
    pooled = []
    for width, n in X.FILTERS.items():
        for f in range(n):
            w, b = model[f"w{width}"][:, f].astype(float), float(model[f"b{width}"][f])
            at = [float(np.concatenate(run[i : i + width]) @ w) + b for i in range(len(run) - width + 1)]
            pooled.append(max(0.0, *at))
    return 1 / (1 + np.exp(-(np.array(pooled) @ model["out"].astype(float) + float(model["bias"][0]))))


def test_convolution_and_pooling_match_a_plain_loop():
    model, rng = X.new_model(), np.random.default_rng(3)
    for name in ("b1", "b2", "b3", "bias"):
        model[name] = rng.normal(0, 0.2, model[name].shape).astype(np.float32)
    texts = [rng.integers(0, 1 << X.BITS, (n, 2)) for n in (1, 2, 3, 7, 30)]
    got = X.scores(model, np.concatenate(texts), np.array([len(t) for t in texts]))
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-5)


def test_a_training_step_follows_the_numeric_gradient(monkeypatch):
    """One Adagrad step from nothing moves every parameter against the sign of the loss's numeric gradient."""
    monkeypatch.setattr(X, "BATCH", 2)
    rng = np.random.default_rng(5)
    examples = [(rng.integers(0, 1 << X.BITS, (6, 2)), 1), (rng.integers(0, 1 << X.BITS, (9, 2)), 0)]
    before, after = X.new_model(), X.fit(examples, epochs=1)

    def loss(model):
        p = [plain_score(model, t) for t, _ in examples]
        return -np.mean([np.log(q if y else 1 - q) for q, (_, y) in zip(p, examples)])

    checked = 0
    for name in ("out", "bias", "w1", "w2", "w3", "b2", "emb"):
        places = [np.unravel_index(i, before[name].shape) for i in rng.choice(before[name].size, min(12, before[name].size), replace=False)]
        places = [(int(examples[0][0][i, 0]), d) for i in range(3) for d in (0, 7)] if name == "emb" else places
        for at in places:
            up, down = ({k: v.astype(float) for k, v in before.items()} for _ in range(2))
            up[name][at] += 1e-4
            down[name][at] -= 1e-4
            slope = (loss(up) - loss(down)) / 2e-4
            if abs(slope) > 1e-3:
                assert np.sign(after[name][at] - before[name][at]) == -np.sign(slope), (name, at)
                checked += 1
    assert checked > 15


def test_ftrl_matches_a_plain_loop_over_features():
    """FTRL-proximal by its published formulas, one feature after the other, in dictionaries."""
    rng = np.random.default_rng(8)
    size = 40
    examples = [(np.sort(rng.choice(size, 6, replace=False)), rng.random(6), int(rng.random() < 0.5)) for _ in range(60)]
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= Q.L1:
            return 0.0
        return -(z[i] - (Q.L1 if z[i] > 0 else -Q.L1)) / ((Q.BETA + n[i] ** 0.5) / Q.ALPHA + Q.L2)

    model = Q.Ftrl(size)
    for where, value, y in examples:
        model.learn(where, value, y)
        x = dict(zip([*where.tolist(), "bias"], [*value.tolist(), 1.0]))
        w = {i: weight(i) for i in x}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - y) * v
            sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / Q.ALPHA
            z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
    got = model.weights(slice(None))
    assert np.allclose(got, [weight(i) for i in range(size)] + [weight("bias")], atol=1e-12)
    assert np.count_nonzero(got) > 10 and model.weights(np.array([0])).shape == (1,)


def test_toxicity_learns_from_every_labelled_row_whatever_the_shards(spark, documents, monkeypatch):
    """However small the shards, every turn goes over all labelled rows of the learning folds, and the mean model works."""
    docs, labels = corpus(900)
    seen = spark.sparkContext.accumulator(0)
    plain = X.fit

    def counting(examples, epochs, *rest):
        seen.add(len(examples) * epochs)
        return plain(examples, epochs, *rest)

    monkeypatch.setattr(X, "fit", counting)
    learnt = sum(not out(i) for i, _, _ in labels)
    model, limits = X.train(documents(docs), labelled(spark, labels), shard=100)
    assert seen.value == X.ROUNDS * learnt
    got = {r.doc_id: r.score for r in X.score(documents(docs), model).collect()}
    assert np.mean([(got[i] >= 0.5) == y for i, _, y in labels if out(i)]) > 0.93 and 0 < limits["en"] < 1


@pytest.mark.parametrize("shard", [10_000, 200])
def test_every_row_is_gone_over_as_often_in_many_shards_as_in_one(spark, documents, monkeypatch, shard):
    docs, labels = corpus(500)
    seen = spark.sparkContext.accumulator(0)
    plain = X.fit

    def counting(examples, epochs, *rest):
        seen.add(len(examples) * epochs)
        return plain(examples, epochs, *rest)

    monkeypatch.setattr(X, "fit", counting)
    X.train(documents(docs), labelled(spark, labels), shard=shard)
    assert seen.value == X.EPOCHS * sum(not out(i) for i, _, _ in labels)


def test_blocks_hold_every_parameter():
    model = X.new_model()
    state = {"model": model, "squares": {k: v + 1 for k, v in model.items()}}
    again = X.from_blocks(X.in_blocks(state))
    assert all(np.array_equal(again[kind][k], v) for kind in state for k, v in state[kind].items())


def test_thresholds_are_the_best_cuts(spark):
    rng = np.random.default_rng(4)
    rows = [(lang, int(rng.random() < 0.4), round(float(rng.random()), 2)) for lang in ("a", "b") for _ in range(300)] + [("one", 1, 0.3)]
    got = X.thresholds(spark.createDataFrame(rows, "lang string, y int, score double"))
    assert set(got) == {"a", "b"}
    for lang in got:
        mine = [(y, s) for at, y, s in rows if at == lang]
        s = sorted({x for _, x in mine})
        cuts = [0.0] + [(p + q) / 2 for p, q in zip(s, s[1:])]
        right = [np.mean([x < c for y, x in mine if y == 0]) + np.mean([x >= c for y, x in mine if y == 1]) for c in cuts]
        assert abs(right[int(np.argmin(np.abs(np.array(cuts) - got[lang])))] - max(right)) < 1e-9
