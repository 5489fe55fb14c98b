"""Order-preserving packing of documents into sequences, cut by dynamic programming.

Each task takes its documents in the order they are stored in, as one run of tokens. Cuts are allowed at the ends of
documents (free), of sentences (a small penalty for a cut document) and, where a stretch has neither for long, every few
tokens (a larger penalty). The cheapest cuts, padding plus penalties, follow from best(j) = min over cuts i at most one
sequence before j of best(i) + place(i), plus terms of j alone: a sliding minimum, which a monotone queue keeps in
constant time per cut. A run is settled block by block, what follows the last full sequence but a few being carried on,
so memory is bounded and a block's end costs no padding. Nothing is shuffled.

Sentence ends are told from IDs: a token that ends in . ! or ? before one that starts with white space, and line ends.

Defined cases: null and empty texts are the end ID alone; repeated rows and null IDs are packed like others; a document
longer than a sequence is cut; an empty table gives no rows; other columns are ignored.
"""

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_batches, table, text_of
from .tokens import spaced_words, worker_tokens

VOCABULARY = "byte_bpe_50k.json"
LENGTH = 1024
END_ID = 0
#: Cost of a cut, in tokens of padding: at a document's end, at a sentence's end, elsewhere.
AT_DOCUMENT, AT_SENTENCE, ELSEWHERE = 0, 4, 24
#: A stretch without a sentence end longer than LONG_STRETCH can be cut every STEP tokens.
LONG_STRETCH, STEP = 96, 16
BLOCK_TOKENS = 1_000_000


def cut_tables(tokenizer, size: int) -> tuple[np.ndarray, np.ndarray]:
    """By token ID: whether it ends a sentence (or is a line end); whether it starts with white space."""
    ends, spaced = np.zeros(size, bool), np.zeros(size, bool)
    for piece, i in tokenizer.get_vocab().items():
        text = tokenizer.decoder.decode([piece])
        ends[i] = text.rstrip("\"')").endswith((".", "!", "?")) or text.endswith("\n")
        spaced[i] = text[:1].isspace()
    return ends, spaced


def allowed_cuts(ids: np.ndarray, document_ends: np.ndarray, ends: np.ndarray, spaced: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places in a run at which it may be cut (0 and its end included, ascending, at most ``length`` apart), and what each costs."""
    last = ends[ids[:-1]] & (spaced[ids[1:]])
    places = np.flatnonzero(last) + 1
    cost = np.full(len(ids) + 1, -1, np.int64)
    cost[places] = AT_SENTENCE
    cost[document_ends] = AT_DOCUMENT
    cost[[0, len(ids)]] = AT_DOCUMENT
    places = np.flatnonzero(cost >= 0)
    gaps = np.diff(places)
    step = min(STEP, length)
    for i in np.flatnonzero(gaps > min(LONG_STRETCH, length)).tolist():
        between = np.arange(places[i] + step, places[i + 1], step)
        cost[between] = ELSEWHERE
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, length: int = LENGTH) -> list[int]:
    """The cheapest cuts of a run from places[0] to places[-1]: padding of every sequence plus the costs of its cuts.

    ``costs`` are those of cutting at each place. Places must not be more than ``length`` apart."""
    at, cost = places.tolist(), costs.tolist()
    # value(i) = best(i) + place(i); the queue holds places by falling age and rising value.
    came, queue, values = [0] * len(at), deque([0]), [at[0]] + [0] * (len(at) - 1)
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0]] < here - length:
            queue.popleft()
        i = queue[0]
        came[j] = i
        # best(j) = value(i) + length - place(j) + cost(j), so place(j) falls out of value(j).
        values[j] = value = values[i] + length + cost[j]
        while queue and values[queue[-1]] > value:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return [at[0], *cuts[::-1]]


def pieces_of(cuts: list[int], documents: list[tuple]) -> Iterator[tuple]:
    """(document, from, to, number of the sequence, offset in it) for the documents (.., from, to) between cuts."""
    s = 0
    for doc in documents:
        place = doc[-2]
        while place < doc[-1]:
            while cuts[s + 1] <= place:
                s += 1
            to = min(doc[-1], cuts[s + 1])
            yield doc, place, to, s, place - cuts[s]
            place = to


def pack(docs: DataFrame, vocabulary: str, end_id: int = END_ID, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, as bytes) of every piece."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(vocabulary, spaced_words)
        ends, spaced = cut_tables(tokens.tokenizer, tokens.tokenizer.get_vocab_size() + 1)
        sequence = TaskContext.get().partitionId() << 33
        # Pieces of documents that are not settled yet: doc_id, tokens of the document, its IDs before, IDs.
        waiting: list[tuple] = []

        def settle(final: bool) -> pa.RecordBatch | None:
            nonlocal waiting, sequence
            if not waiting:
                return None
            sizes = np.array([len(w[3]) // 4 for w in waiting], np.int64)
            places = np.cumsum(sizes)
            ids = np.frombuffer(b"".join(w[3] for w in waiting), "<u4")
            cuts = best_cuts(*allowed_cuts(ids, places, ends, spaced, length), length)
            if not final:
                cuts = cuts[:-2]  # the last sequences may be cut otherwise once it is known what follows
            if len(cuts) < 2:
                return None
            documents = [(i, int(p - n), min(int(p), cuts[-1])) for i, (n, p) in enumerate(zip(sizes, places)) if p - n < cuts[-1]]
            out, data = [], []
            for (i, first, _), a, b, s, offset in pieces_of(cuts, documents):
                doc_id, total, before, own = waiting[i]
                data.append(own[4 * (a - first) : 4 * (b - first)])
                out.append((doc_id, before + a - first, b - a, zlib.crc32(data[-1]), total, sequence + s, offset))
            left = []
            for w, n, p in zip(waiting, sizes.tolist(), places.tolist()):
                if p > cuts[-1]:
                    taken = max(0, cuts[-1] - (p - n))
                    left.append((w[0], w[1], w[2] + taken, w[3][4 * taken :]))
            waiting, sequence = left, sequence + len(cuts) - 1
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())][: None if with_ids else -1], names=[*names, "ids"][: None if with_ids else -1])

        held = 0
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), tokens.encode(b.column(1).to_pylist())):
                waiting.append((doc_id, len(ids) // 4 + 1, 0, ids + end))
                held += len(ids) // 4 + 1
            if held >= BLOCK_TOKENS:
                done = settle(False)
                held = sum(len(w[3]) // 4 for w in waiting)
                if done:
                    yield done
        done = settle(True)
        if done:
            yield done

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names) + (", ids binary" if with_ids else ""))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
