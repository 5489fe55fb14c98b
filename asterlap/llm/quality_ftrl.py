"""Quality classifier: logistic regression on hashed word n-grams, fitted with follow-the-regularised-leader (FTRL).

Features are hashed single words, pairs of words, and the same of the words' shapes (letters as a, capitals as A, digits
as 0, runs as one), plus a mark where a word repeats the one before. Each family is an average over the text, so a
document is a sparse vector whose entries add up to one in each family. FTRL keeps, for every weight, a sum of gradients
and of their squares; a weight is zero until its evidence exceeds the L1 penalty. A score is the sparse dot product of
the document's features and the weights, through the logistic function. The fit sees a bounded, documented sample of the
labelled rows of the learning folds; every document is scored, whole, where it is.

Defined cases: a text without words (null, empty) has the bias alone as its score; labels other than 0 and 1 and null
IDs aren't learnt from; repeated IDs are learnt once; without labels of both classes every score is 0.5; an empty table
gives no rows; other columns are ignored.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, table, text_of
from .learning import WordFeatures, held_out, split_batch, training_sample

#: Documents the fit may see at most (as the mean of the sample's size).
SAMPLE = 8000
BITS = 18
EPOCHS = 2
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.02, 0.02
THRESHOLD = 0.3
FAMILIES = 5
RUNS = (
    (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0"),
    (re.compile(rb"([^A-Za-z0-9])\1+"), rb"\1\1"),
)


def features(word: bytes) -> tuple[bytes, bytes]:
    """A word in lower case, and its shape."""
    shape = word
    for pattern, sign in RUNS:
        shape = pattern.sub(sign, shape)
    return word.lower(), shape


def spread(x: np.ndarray) -> np.ndarray:
    """Hashes as places among 2**BITS weights."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(64 - BITS)).astype(np.int64)


def places(hashes: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each family the places of its features, word by word, and whether a word follows another of its text (only
    then do the pair features count)."""
    before = np.roll(hashes, 1, axis=0)
    follows = np.ones(len(hashes), bool)
    follows[(np.cumsum(counts) - counts)[counts > 0]] = False
    step = np.uint64(0x9E3779B97F4A7C15)
    word, shape = hashes[:, 0], hashes[:, 1]
    same = np.where(follows & (word == before[:, 0]), np.uint64(7), np.uint64(11))
    families = [word, shape ^ step, before[:, 0] * step + word, before[:, 1] * step + (shape ^ (step >> np.uint64(1))), same]
    return [spread(f) for f in families], follows


def per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over the words of each text."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[ends] - total[ends - counts]


def dot(weights: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sparse dot products of a batch of documents."""
    families, follows = places(hashes, counts)
    out = np.full(len(counts), weights[-1])
    for i, f in enumerate(families):
        w = weights[f]
        if i >= 2:
            w = w * follows
        out += per_text(w, counts) / np.maximum(counts - (i >= 2), 1)
    return out


def sparse(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of one document's features."""
    families, follows = places(hashes, np.array([len(hashes)]))
    where, value = [], []
    for i, f in enumerate(families):
        f = f[follows] if i >= 2 else f
        where.append(f)
        value.append(np.full(len(f), 1.0 / max(len(hashes) - (i >= 2), 1)))
    where, value = np.concatenate(where), np.concatenate(value)
    distinct, inverse = np.unique(where, return_inverse=True)
    return distinct, np.bincount(inverse, value, len(distinct))


class Ftrl:
    """FTRL-proximal with a learning rate for each weight. The last weight is the bias."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, where) -> np.ndarray:
        z, n = self.z[where], self.n[where]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, where: np.ndarray, value: np.ndarray, y: int) -> None:
        where, value = np.append(where, len(self.z) - 1), np.append(value, 1.0)
        w = self.weights(where)
        g = (logistic(float(w @ value)) - y) * value
        sigma = (np.sqrt(self.n[where] + g * g) - np.sqrt(self.n[where])) / ALPHA
        self.z[where] += g - sigma * w
        self.n[where] += g * g


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights from (places, values, label), in the order given."""
    model = Ftrl(1 << BITS)
    for _ in range(epochs):
        for where, value, y in examples:
            model.learn(where, value, y)
    return model.weights(slice(None)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """The weights. Features are made where the sample's documents are; one task fits them, in the order of a hash."""
    chosen = training_sample(docs, labels, label, sample).select("doc_id", "text", "y")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordFeatures(features)
        for b in batches:
            made = []
            for t in b.column(1).to_pylist():
                where, value = sparse(split_batch([t], known)[1])
                made.append((where.astype(np.int32).tobytes(), value.astype(np.float32).tobytes()))
            cols = list(zip(*made)) or [(), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array(c, pa.binary()) for c in cols)], names=["doc_id", "y", "places", "vals"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [
            (np.frombuffer(p, np.int32), np.frombuffer(v, np.float32).astype(np.float64), y)
            for b in batches for y, p, v in zip(*(b.column(c).to_pylist() for c in (1, 2, 3)))
        ]
        if {y for _, _, y in examples} == {0, 1}:
            yield pa.RecordBatch.from_arrays([pa.array([fit(examples).tobytes()], pa.binary())], names=["weights"])

    made = chosen.mapInArrow(make, "doc_id long, y int, places binary, vals binary")
    ordered = made.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit("order")), "doc_id")
    row = ordered.mapInArrow(learn, "weights binary").first()
    return np.frombuffer(row[0], np.float32) if row else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordFeatures(features)
        for b in batches:
            counts, hashes = split_batch(b.column(1).to_pylist(), known)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(logistic(dot(held.value, hashes, counts)))], names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def op9_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
