"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

A word's vector is the sum of two hashed embeddings: of the word without its punctuation and case, and of its first four
letters, so that inflected forms share what they have in common. Filters one, two and three words wide slide over the
whole text, each keeps its greatest response, and a logistic layer turns these into a score. Training (Adagrad) takes all
labelled rows of the learning folds. They are dealt to shards by a hash; a task goes over one shard, starting from the
common model, and what the shards moved is averaged, block by block of the parameters, into the next common model. A shard
that leaves an embedding alone has no say in it. However many the shards, every row is gone over EPOCHS times; few rows are
one shard. The greatest responses have one place each, so a step touches few embeddings. Scores use the text alone. The
language is used after scoring only: each language's threshold is the score that tells all its training documents apart
best, and gives the column ``flagged``.

Defined cases: a text without words (null, empty) is scored from the biases; labels other than 0 and 1 and null IDs
aren't learnt from; repeated IDs are learnt once; without labels of both classes every score is 0; languages without
training documents of both classes, null among them, have the threshold 0.5; an empty table gives no rows; other columns
are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import previous_value, running_sum
from .common import arrow_batches, shuffles_dropped, stored_and_measured, table, text_of
from .learning import WordFeatures, held_out, split_batch, training_rows

#: Documents of a shard (as the mean of its size). All shards together hold all labelled documents.
SHARD = 6000
#: Parts that the embeddings are averaged in.
BLOCKS = 64
BITS = 16
PLACE = np.uint16  # holds BITS bits
DIM = 16
FILTERS = {1: 24, 2: 12, 3: 12}
#: Turns over every labelled row: all in a row over the only shard, or as many over all shards, averaged after each.
EPOCHS = ROUNDS = 6
FIRST_SQUARE = 1e-6
RATE = 0.05
BATCH = 16
SEED = 7
PREFIX = 4
PUNCTUATION = b".,;:!?\"'()[]{}<>*_-#$%&|/\\"


def features(word: bytes) -> tuple[bytes, bytes]:
    """A word without its punctuation, in lower case, and its first letters."""
    plain = word.decode("utf-8", "replace").lower().encode().strip(PUNCTUATION)
    return plain, b"<" + plain.decode("utf-8", "replace")[:PREFIX].encode()


def rows_of(hashes: np.ndarray) -> np.ndarray:
    """Rows of the embedding table: two for each word."""
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def new_model() -> dict:
    rng = np.random.default_rng(SEED)
    model = {"emb": rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32), "out": np.zeros(sum(FILTERS.values()), np.float32), "bias": np.zeros(1, np.float32)}
    for width, n in FILTERS.items():
        model[f"w{width}"] = rng.normal(0, 1 / np.sqrt(width * DIM), (width * DIM, n)).astype(np.float32)
        model[f"b{width}"] = np.zeros(n, np.float32)
    model["out"][:] = rng.normal(0, 0.3, len(model["out"]))
    return model


def responses(model: dict, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The greatest response of every filter in each text, the place (in the padded run of words) it is at, the padded
    vectors, and each text's first place. Texts are padded so that no filter sees two of them."""
    pad = max(FILTERS) - 1
    ends = np.cumsum(counts + pad)
    firsts = ends - counts - pad
    x = np.zeros((int(ends[-1]) if len(ends) else 0, DIM), np.float32)
    inside = np.repeat(firsts - (np.cumsum(counts) - counts), counts) + np.arange(len(words))
    x[inside] = model["emb"][words[:, 0]] + model["emb"][words[:, 1]]
    best, at = [], []
    for width in FILTERS:
        n = len(x) - width + 1
        windows = np.lib.stride_tricks.as_strided(x, (n, width * DIM), (x.strides[0], x.strides[1]))
        r = np.full((len(x), FILTERS[width]), -np.inf, np.float32)
        r[:n] = windows @ model[f"w{width}"] + model[f"b{width}"]
        for k in range(1, width):
            r[ends - k] = -np.inf  # would reach into the next text
        if model.get("places"):
            across = np.ascontiguousarray(r.T)
            where = np.stack([i + across[:, i:j].argmax(axis=1) for i, j in zip(firsts.tolist(), ends.tolist())])
            at.append(where)
            best.append(r[where, np.arange(FILTERS[width])])
        else:
            best.append(np.maximum.reduceat(r, firsts, axis=0))
    return np.maximum(np.concatenate(best, axis=1), 0), at, x, firsts


def scores(model: dict, words: np.ndarray, counts: np.ndarray, size: int = 200_000) -> np.ndarray:
    """Scores of a batch of texts, some at a time so that memory is bounded by a group or the longest text."""
    out, first, start = [], 0, 0
    while first < len(counts):
        last, total = first + 1, int(counts[first])
        while last < len(counts) and total + counts[last] <= size:
            total += int(counts[last])
            last += 1
        pooled = responses(model, words[start : start + total], counts[first:last])[0]
        out.append(logistic(pooled @ model["out"] + model["bias"][0]))
        first, start = last, start + total
    return np.concatenate(out).astype(np.float64) if out else np.empty(0)


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, state: dict | None = None, weight: dict | None = None, seed: int = SEED) -> dict:
    """A model from (rows of words, label). ``state``, a model and its squared gradients, is carried on in place; ``weight``
    is what an example of a class counts."""
    if state is None:
        state = {"model": (fresh := new_model()), "squares": {k: np.full(v.shape, FIRST_SQUARE, np.float32) for k, v in fresh.items()}}
    model, squares = state["model"], state["squares"]
    rng = np.random.default_rng(seed)
    if weight is None:
        positive = sum(y for _, y in examples)
        weight = {1: len(examples) / (2 * positive), 0: len(examples) / (2 * (len(examples) - positive))}

    def step(name: str, grad: np.ndarray, where=slice(None)) -> None:
        squares[name][where] += grad * grad
        model[name][where] -= RATE * grad / np.sqrt(squares[name][where])

    for _ in range(epochs):
        order = rng.permutation(len(examples))
        for k in range(0, len(order), BATCH):
            some = [examples[i] for i in order[k : k + BATCH]]
            words, y = np.concatenate([w for w, _ in some]), np.array([y for _, y in some])
            counts = np.array([len(w) for w, _ in some])
            pooled, at, x, firsts = responses(model | {"places": True}, words, counts)
            p = logistic(pooled @ model["out"] + model["bias"][0])
            g = ((p - y) * np.array([weight[v] for v in y.tolist()]) / len(some)).astype(np.float32)
            back = np.outer(g, model["out"]) * (pooled > 0)
            step("out", pooled.T @ g)
            step("bias", np.array([g.sum()], np.float32))
            dx = np.zeros_like(x)
            first = 0
            for width, n in FILTERS.items():
                grad_w, w = np.zeros_like(model[f"w{width}"]), model[f"w{width}"]
                gb, where = back[:, first : first + n], at.pop(0)
                doc, f = np.nonzero(gb)
                gf, place = gb[doc, f][:, None], (where[doc, f] * DIM)[:, None] + np.arange(width * DIM)
                # Added up text after text and filter after filter, as a plain loop would.
                each = np.zeros((len(some), width * DIM, n), np.float32)
                each[doc, :, f] = gf * x.ravel()[place]
                np.add.reduce(each, axis=0, out=grad_w)
                np.add.at(dx.ravel(), place.ravel(), (gf * w.T[f]).ravel())
                step(f"b{width}", back[:, first : first + n].sum(axis=0))
                step(f"w{width}", grad_w)
                first += n
            inside = np.repeat(firsts - (np.cumsum(counts) - counts), counts) + np.arange(len(words))
            moved = dx[inside]
            touched = np.flatnonzero(moved.any(axis=1))
            moved = moved[touched]
            for half in (0, 1):
                rows, inverse = np.unique(words[touched, half], return_inverse=True)
                grad = np.zeros(len(rows) * DIM, np.float32)
                np.add.at(grad, (inverse[:, None] * DIM + np.arange(DIM)).ravel(), moved.ravel())
                step("emb", grad.reshape(-1, DIM), rows)
    return model


def thresholds(scored: DataFrame) -> dict[str, float]:
    """For each language with both classes among ``scored`` (lang, y, score) the threshold with the best balanced accuracy,
    in the middle of the scores it lies between, the lowest of equals. Exact over all rows, no language in one task."""
    counted = scored.groupBy("lang", "score").agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
    both = counted.groupBy("lang").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1")).filter("t0 > 0 AND t1 > 0")
    run = previous_value(counted, "score", ["score"], "before", ["lang"])
    for n in ("0", "1"):
        run = running_sum(run, f"n{n}", ["score"], f"b{n}", ["lang"])
    right = (F.col("b0") - F.col("n0")) / F.col("t0") - (F.col("b1") - F.col("n1")) / F.col("t1")
    cut = F.when(F.col("before").isNull(), 0.0).otherwise((F.col("before") + F.col("score")) / 2)
    best = run.join(both, "lang").groupBy("lang").agg(F.max_by(cut, F.struct(right, -F.col("score"))).alias("cut"))
    return {r["lang"]: r["cut"] for r in best.collect()}


def in_blocks(state: dict) -> dict[int, np.ndarray]:
    """The parameters and their squared gradients in blocks: equal parts of the embeddings, and the rest as number -1."""
    rest = [state[kind][k].ravel() for kind in ("model", "squares") for k in state[kind] if k != "emb"]
    parts = [np.array_split(state[kind]["emb"], BLOCKS) for kind in ("model", "squares")]
    return {-1: np.concatenate(rest)[:, None]} | {i: np.concatenate(pair, axis=1) for i, pair in enumerate(zip(*parts))}


def from_blocks(blocks: dict[int, np.ndarray]) -> dict:
    """The inverse of ``in_blocks``."""
    emb = np.concatenate([blocks[i] for i in range(BLOCKS)])
    state = {"model": new_model()}
    state["squares"] = {k: np.empty_like(v) for k, v in state["model"].items()}
    at = 0
    for j, kind in enumerate(("model", "squares")):
        for k, v in state[kind].items():
            if k == "emb":
                state[kind][k] = np.ascontiguousarray(emb[:, j * DIM : (j + 1) * DIM])
            else:
                state[kind][k] = blocks[-1][at : at + v.size, 0].reshape(v.shape).copy()
                at += v.size
    return state


def learning(held, epochs: int, weight: dict, seed: int):
    """What a task does with a shard: go over it in the order of a hash, and say how far that moved each block."""
    def learn(t: pa.Table) -> pa.Table:
        t = t.take(pa.array(np.lexsort((t["doc_id"].to_numpy(), t["at"].to_numpy()))))
        examples = [(np.frombuffer(w, PLACE).reshape(-1, 2), y) for w, y in zip(t["words"].to_pylist(), t["y"].to_pylist())]
        learnt = {kind: {k: v.copy() for k, v in held.value[kind].items()} for kind in held.value}
        fit(examples, epochs, learnt, weight, seed)
        before, after = in_blocks(held.value), in_blocks(learnt)
        return pa.table({"block": pa.array(list(after), pa.int32()), "moved": pa.array([(after[i] - before[i]).tobytes() for i in after], pa.binary())})

    return learn


def averaging(held):
    """A block moved by the mean of the moves of those shards that moved the row at all."""
    def joined(t: pa.Table) -> pa.Table:
        block = t["block"][0].as_py()
        old = in_blocks(held.value)[block]
        moves, moved = np.zeros(old.shape), np.zeros((len(old), 1))
        for raw in t["moved"]:
            move = np.frombuffer(raw.as_py(), np.float32).reshape(old.shape)
            moves += move
            moved += move.any(axis=1, keepdims=True)
        new = (old + moves / np.maximum(moved, 1)).astype(np.float32)
        return pa.table({"block": pa.array([block], pa.int32()), "values": pa.array([new.tobytes()], pa.binary()), "width": pa.array([old.shape[1]], pa.int32())})

    return joined


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", shard: int = SHARD) -> tuple[dict | None, dict[str, float]]:
    """The model (None without both classes) and the threshold of each language, from all labelled rows of the learning
    folds."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordFeatures(features)
        for b in batches:
            counts, hashes = split_batch(b.column(1).to_pylist(), known)
            made = [words.tobytes() for words in np.split(rows_of(hashes).astype(PLACE), np.cumsum(counts)[:-1])] if len(counts) else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(made, pa.binary())], names=["doc_id", "y", "lang", "words"])

    made = training_rows(docs, labels, label).mapInArrow(make, "doc_id long, y int, lang string, words binary")
    with shuffles_dropped(docs.sparkSession):
        rows, sizes = stored_and_measured(made, "toxicity", n0=F.count_if(F.col("y") == 0), n1=F.count_if(F.col("y") == 1))
    if not sizes["n0"] or not sizes["n1"]:
        return None, {}
    total = sizes["n0"] + sizes["n1"]
    shards = -(-total // shard)
    weight = {y: total / (2 * sizes[f"n{y}"]) for y in (0, 1)}
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("at", F.xxhash64("doc_id", F.lit("order")))
    turns, epochs = (1, EPOCHS) if shards == 1 else (ROUNDS, 1)
    state = {"model": (model := new_model()), "squares": {k: np.full(v.shape, FIRST_SQUARE, np.float32) for k, v in model.items()}}
    context = docs.sparkSession.sparkContext
    for turn in range(turns):
        with shuffles_dropped(docs.sparkSession):
            held = context.broadcast(state)
            moves = dealt.groupBy("shard").applyInArrow(learning(held, epochs, weight, SEED + turn), "block int, moved binary")
            got = moves.groupBy("block").applyInArrow(averaging(held), "block int, values binary, width int").collect()
            held.destroy()
        state = from_blocks({r["block"]: np.frombuffer(r["values"], np.float32).reshape(-1, r["width"]) for r in got})
    held_model = context.broadcast(state["model"])

    def rescore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [np.frombuffer(w, PLACE).reshape(-1, 2) for w in b.column(2).to_pylist()]
            found = scores(held_model.value, np.concatenate(words), np.array([len(w) for w in words])) if words else np.empty(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found)], names=["lang", "y", "score"])

    scored = rows.select("lang", "y", "words").mapInArrow(rescore, "lang string, y int, score double")
    return state["model"], thresholds(scored)


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang, score of every row; the language is passed by, not used."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"], text_of(docs).cast("binary").alias("text"))
    if model is None:
        return rows.select("doc_id", "lang", F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordFeatures(features)
        for b in batches:
            counts, hashes = split_batch(b.column(2).to_pylist(), known)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores(held.value, rows_of(hashes), counts))], names=["doc_id", "lang", "score"])

    return rows.mapInArrow(run, "doc_id long, lang string, score double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model, limits = train(docs, table(spark, sf_dir, "labels"))
    limit = F.lit(0.5)
    for lang, value in limits.items():
        limit = F.when(F.col("lang") == lang, F.lit(value)).otherwise(limit)
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        limit.alias("threshold"), (F.col("score") >= limit).alias("flagged"),
    )
