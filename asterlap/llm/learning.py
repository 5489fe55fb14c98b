"""What the classifiers share: the labelled documents of the learning folds, all or a bounded sample, and features of words
seen before."""

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits
from .common import text_of

FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the ID as text, modulo FOLDS; 0, the held-out fold, for a null ID."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


#: Labelled IDs that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 500_000


def _known(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, y of the learning folds; an ID with several labels has the largest."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id")) != 0))
    return known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).groupBy("doc_id").agg(F.max("y").alias("y"))


def _with_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text (bytes), y, lang; an ID with several texts has the largest."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), F.coalesce(docs["lang"], F.lit("")).alias("lang"))
    found = texts.join(known, "doc_id").groupBy("doc_id").agg(F.max(F.struct("text", "lang")).alias("t"), F.max("y").alias("y"))
    return found.select("doc_id", F.col("t.text").cast("binary").alias("text"), "y", F.col("t.lang").alias("lang"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text (bytes), y, lang of every labelled document of the learning folds."""
    known = _known(labels, label)
    return _with_texts(docs.filter(fold(docs["doc_id"]) != 0), F.broadcast(known) if fits(known, BROADCAST_IDS) else known)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, text (bytes), y, lang of about ``limit`` labelled documents of the learning folds, half of them, as far
    as there are so many, of each class. They are chosen by a hash of the ID, alike in every run.

    An ID with several labels has the largest, one with several texts the largest text. So the chosen IDs, whose number
    is bounded by ``limit`` (a binomial number with that mean), bound the sample, and they alone are broadcast."""
    known = _known(labels, label)
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.lit(0.0)
    for y, n in sizes.items():
        chance = F.when(F.col("y") == y, F.lit(limit / 2 / n)).otherwise(chance)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(drawn < chance)
    return _with_texts(docs, F.broadcast(chosen))


class WordFeatures(dict):
    """Two 64-bit features of every word, made once for each word; remembers a bounded number of words."""

    def __init__(self, features, limit: int = 400_000):
        super().__init__()
        self.features, self.limit, self.raw = features, limit, bytearray()

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        for text in self.features(word):
            self.raw += xxhash.xxh3_64_digest(text)
        return place

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
            self.raw = bytearray()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(bytes(self.raw), np.uint64).reshape(-1, 2)[places]


def split_batch(texts: list[bytes], features: WordFeatures) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each text, and the features of all words in a row."""
    words = [t.split() for t in texts]
    return np.fromiter(map(len, words), np.int64, len(words)), features.of([w for ws in words for w in ws])


