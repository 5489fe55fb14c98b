"""Word-piece token counts by a linear longest-match automaton.

The vocabulary's pieces, for a word's start and for its rest, form a trie. Each node knows where greedy longest match
goes on when the trie doesn't (its failure link) and how many pieces it has then taken (its popped tokens). A word is
read once, byte by byte, with no stepping back; its number of pieces is a sum of popped counts, and no piece is built.
Counts of words seen before are remembered, up to a bound.

The vocabulary is a tokenizers file. Of a WordPiece model, pieces with the continuing prefix go on within a word; of
any other, all pieces may start a word or go on. Where pieces have end-of-word marks, those that have one match only
where the word ends, and the others only where it goes on: a word's last byte is then another symbol than that byte
elsewhere. A word is a run of anything but ASCII white space, in lower case. A word that can't be taken apart counts as
one unknown token.

Defined cases: null and empty texts have no words; words of any length are read in full; repeated rows and null IDs are
counted like others; an empty table gives no rows; other columns are ignored.
"""

import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_batches, table, text_of

VOCABULARY = "word_bpe_49k.json"
#: Added to the last byte of a word, and of a piece with an end-of-word mark.
LAST = 256
#: Longer words aren't remembered.
LONG_WORD = 64
ROOT, REST = 0, 1


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the others, in
    order, for those from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


Piece = tuple[int, ...]


def ending(piece: bytes) -> Piece:
    """The symbols of a piece, or word, that ends with its last byte."""
    return (*piece[:-1], piece[-1] + LAST)


def vocabulary(path: str) -> tuple[set[Piece], set[Piece], bool]:
    """Pieces that may start a word, pieces that may go on, and whether ends of words are marked."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pieces, letters = model["vocab"], byte_letters()
    mark = model.get("end_of_word_suffix") or ""

    def symbols(piece: str) -> Piece:
        plain = piece.removesuffix(mark)
        found = bytes(letters[c] for c in plain) if all(c in letters for c in plain) else plain.encode()
        return ending(found) if found and plain != piece else tuple(found)

    if model["type"] == "WordPiece":
        more = model["continuing_subword_prefix"]
        starts = {tuple(p.encode()) for p in pieces if not p.startswith(more)}
        return starts, {tuple(p[len(more) :].encode()) for p in pieces if p.startswith(more)}, False
    whole = {symbols(p) for p in pieces} - {()}
    return whole, whole, bool(mark)


class LongestMatch(dict):
    """Greedy longest-match piece counts of words; as a mapping, remembers those of words seen."""

    def __init__(self, starts: Iterable[Iterable[int]], rests: Iterable[Iterable[int]], marked: bool = False, limit: int = 500_000):
        super().__init__()
        self.limit, self.marked = limit, marked
        # Edges are keyed by node * 512 + symbol.
        self.edges: dict[int, int] = {}
        self.fail: list[int] = [-1, -1]
        self.popped: list[int] = [0, 0]
        ends = [False, False]
        for root, pieces in ((ROOT, starts), (REST, rests)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 9 | byte
                    if key not in self.edges:
                        self.edges[key] = len(ends)
                        ends.append(False)
                        self.fail.append(-1)
                        self.popped.append(0)
                    node = self.edges[key]
                ends[node] = True
        self._link(ends)

    def _link(self, ends: list[bool]) -> None:
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.edges.items():
            below.setdefault(key >> 9, []).append((key & 511, node))
        queue = deque((ROOT, REST))
        while queue:
            parent = queue.popleft()
            for byte, node in below.get(parent, ()):
                queue.append(node)
                if ends[node]:
                    self.fail[node], self.popped[node] = REST, 1
                    continue
                at, count = self.fail[parent], self.popped[parent]
                while at >= 0 and at << 9 | byte not in self.edges:
                    count += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.edges[at << 9 | byte], count

    def pieces(self, word: bytes) -> int:
        """The number of pieces of a word; 0 if it can't be taken apart."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = ROOT
        count = 0
        for byte in ending(word) if self.marked and word else word:
            while (to := edges.get(node << 9 | byte)) is None:
                count += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = to
        while node > REST:
            count += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return count

    def __missing__(self, word: bytes) -> int:
        count = self.pieces(word)
        if len(word) <= LONG_WORD and len(self) < self.limit:
            self[word] = count
        return count


@lru_cache(maxsize=2)
def worker_automaton(path: str) -> LongestMatch:
    """One for all tasks of a Python worker."""
    return LongestMatch(*vocabulary(path))


def counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens (unknown words are one each), n_unknown of every row."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_automaton(path)
        for b in batches:
            words, tokens, unknown = [], [], []
            for text in b.column(1).to_pylist():
                found = list(map(automaton.__getitem__, text.lower().encode().split()))
                none = found.count(0)
                words.append(len(found))
                tokens.append(sum(found) + none)
                unknown.append(none)
            numbers = [pa.array(c, pa.int64()) for c in (words, tokens, unknown)]
            yield pa.RecordBatch.from_arrays([b.column(0), *numbers], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
