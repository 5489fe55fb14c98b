"""Removal of passages that occur more than once anywhere, behind a count-min prefilter.

Documents are stored in chunks of bounded size. Every chunk makes a sketch of its windows of 35 words: the cells they
fall into, for each row of the sketch, sorted and differenced, so a chunk's sketch costs little more than a byte a
window and row however wide the whole sketch is. Slices of the sketch (ranges of cells) are merged on their own: a cell
counts as repeated if several chunks hit it, or one of them twice. Each chunk gets back which of its cells are repeated.
A count can only be too high, so no repeated window is lost. In the second pass, only windows whose cells are repeated
in every row are grouped exactly, by a 128-bit hash; a chunk sends each of them once, so no window is a hot key, and
ranges of hashes are grouped on their own. The
third pass removes the words that truly repeated windows cover. The sketch is as wide as the corpus needs and no part
of it is broadcast: what a chunk needs is read from the shared folder.

Defined cases: a null text has no words; texts below a window's length have none and stay whole; repeated rows and
copies are removed in full (their windows start elsewhere too) if they have a window; null IDs are kept; an empty table
gives no rows; other columns, whatever their names, are carried along by the stage and ignored by the query.
"""

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_batches, free_name, scratch, stored, table, text_of
from .shared_files import read_partition
from .word_hashes import WordHashes, batch_windows

WINDOW = 35
#: Text per chunk; with a corpus of many TB, take more, so that there are fewer pairs of a chunk and a slice.
CHUNK_BYTES = 12_000_000
ROWS = 2
#: Cells of a row of the sketch per word of the corpus.
CELLS_PER_WORD = 6
SLICE_BITS = 24
#: Odd multipliers, one for each row of the sketch.
MIXERS = (0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def in_chunks(docs: DataFrame, chunk: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents with the number of their chunk, stored."""
    arrow_batches(docs.sparkSession)
    place = docs.columns.index("text")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = done + np.cumsum(sizes)
            done = int(ends[-1]) if len(ends) else done
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first + (ends - sizes) // chunk_bytes)], names=[*b.schema.names, chunk])

    return stored(docs.mapInArrow(assign, docs.withColumn(chunk, F.lit(0).cast("long")).schema), "windows-chunks")


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Pieces of batches of the same chunk, chunk by chunk. The first column is the chunk."""
    current, pieces = None, []
    for b in batches:
        numbers = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                if pieces and numbers[i] != current:
                    yield current, pieces
                    pieces = []
                current = int(numbers[i])
                pieces.append(b.slice(i, j - i))
    if pieces:
        yield current, pieces


def _texts(piece: pa.RecordBatch) -> list[bytes]:
    return piece.column(1).to_pylist()


def _chunk_hashes(pieces: list[pa.RecordBatch], size: int, hashes: WordHashes) -> np.ndarray:
    return np.concatenate([batch_windows(_texts(p), size, hashes)[3] for p in pieces])


def cells(pairs: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each window in a row of the sketch, of 2**bits cells."""
    mixed = (pairs[:, 0] ^ (pairs[:, 1] >> np.uint64(row + 1))) * np.uint64(MIXERS[row]) + pairs[:, 1]
    return (mixed * np.uint64(MIXERS[-1 - row])) >> np.uint64(64 - bits)


def pack(ordered: np.ndarray) -> bytes:
    """Sorted numbers of 32 or 64 bits as differences, compressed byte plane by byte plane."""
    steps = np.diff(ordered, prepend=ordered.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, ordered.itemsize).T).tobytes())


def unpack(packed: bytes, kind=np.uint32) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _at_most_twice(ordered: np.ndarray) -> np.ndarray:
    """Sorted numbers, each at most twice."""
    third = np.zeros(len(ordered), bool)
    third[2:] = ordered[2:] == ordered[:-2]
    return ordered[~third]


def sketch(chunks: DataFrame, size: int, bits: int) -> DataFrame:
    """(part, chunk, packed): the cells of each chunk in each slice of each row of the sketch."""
    slice_bits = min(bits, SLICE_BITS)
    slices = 1 << (bits - slice_bits)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk, pieces in by_chunk(batches):
            pairs = _chunk_hashes(pieces, size, hashes)
            for row in range(ROWS):
                ordered = _at_most_twice(np.sort(cells(pairs, row, bits)))
                parts = (ordered >> np.uint64(slice_bits)).astype(np.int64)
                cuts = np.searchsorted(parts, np.arange(slices + 1))
                offsets = (ordered & np.uint64((1 << slice_bits) - 1)).astype(np.uint32)
                used = [s for s in range(slices) if cuts[s] < cuts[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row * slices + s for s in used], pa.int64()), pa.array([chunk] * len(used), pa.int64()),
                        pa.array([pack(offsets[cuts[s] : cuts[s + 1]]) for s in used], pa.binary()),
                    ],
                    names=["part", "chunk", "packed"],
                )

    return chunks.mapInArrow(make, "part long, chunk long, packed binary")


def repeated_cells(sketches: DataFrame, bits: int) -> DataFrame:
    """(chunk, part, packed): the cells of each chunk that are hit twice or more in the merged sketch."""
    width = 1 << min(bits, SLICE_BITS)

    def merge(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        once, twice = np.zeros(width, bool), np.zeros(width, bool)
        for packed in part.column("packed"):
            offsets = unpack(packed.as_py())
            twice[offsets[1:][offsets[1:] == offsets[:-1]]] = True
            twice[offsets[once[offsets]]] = True
            once[offsets] = True
        out = []
        for chunk, packed in zip(part.column("chunk").to_pylist(), part.column("packed")):
            offsets = unpack(packed.as_py())
            if len(hit := np.unique(offsets[twice[offsets]])):
                out.append((chunk, key[0].as_py(), pack(hit)))
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"chunk": pa.array(columns[0], pa.int64()), "part": pa.array(columns[1], pa.int64()), "packed": pa.array(columns[2], pa.binary())})

    return sketches.groupBy("part").applyInArrow(merge, "chunk long, part long, packed binary")


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are among the ordered ones. A small table by low bits turns most of them away first."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    low = np.uint64((1 << 22) - 1)
    table = np.zeros(1 << 22, bool)
    table[ordered & low] = True
    found = table[values & low]
    rest = values[found]
    places = np.minimum(np.searchsorted(ordered, rest), len(ordered) - 1)
    found[found] = ordered[places] == rest
    return found


def candidates(chunks: DataFrame, replies: str, size: int, bits: int) -> DataFrame:
    """(part, chunk, k1, k2, several): once for each chunk, the windows estimated repeated, by ranges of the first half of
    their hash: the first halves packed, the second halves, and whether the chunk has the window several times."""
    slice_bits = min(bits, SLICE_BITS)
    slices = 1 << (bits - slice_bits)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk, pieces in by_chunk(batches):
            got = read_partition(replies, "chunk", chunk, {"part": pa.int64(), "packed": pa.binary()})
            rows = [[np.empty(0, np.uint64)] for _ in range(ROWS)]
            for part, packed in sorted(zip(got["part"].to_pylist(), got["packed"].to_pylist())):
                row, s = divmod(part, slices)
                rows[row].append(unpack(packed).astype(np.uint64) + np.uint64(s << slice_bits))
            # Several tasks may have read the chunk, each with replies of its own.
            flagged = [np.unique(np.concatenate(r)) for r in rows]
            found = []
            for p in pieces:
                pairs = batch_windows(_texts(p), size, hashes)[3]
                for row in range(ROWS):
                    pairs = pairs[member(cells(pairs, row, bits), flagged[row])]
                found.append(pairs)
            k1, k2, n = counted(*np.concatenate(found).T)
            cuts = np.searchsorted(k1 >> np.uint64(64 - slices.bit_length()), np.arange(2 * slices + 1))
            out = [(s, chunk, pack(k1[i:j]), k2[i:j].tobytes(), (n[i:j] > 1).tobytes()) for s, (i, j) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if i < j]
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "chunk", "k1", "k2", "several"])

    return chunks.mapInArrow(make, "part long, chunk long, k1 binary, k2 binary, several binary")


def counted(k1: np.ndarray, k2: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with their number (or the sum of their ``n``)."""
    order = np.lexsort((k2, k1))
    k1, k2 = k1[order], k2[order]
    first = np.ones(len(k1), bool)
    first[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    number = np.bincount(np.cumsum(first) - 1, None if n is None else n[order], first.sum()).astype(np.int64)
    return k1[first], k2[first], number


def repeated(windows: DataFrame) -> DataFrame:
    """(chunk, k1, k2): those of the chunks' windows that occur twice or more in all. The exact grouping: a range of
    hashes, with each chunk's windows once, is one task's group, of a size that the number of ranges bounds. To know its
    own windows again, a chunk needs 80 bits of their hashes."""

    def group(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        rows = [
            (chunk, unpack(k1, np.uint64), np.frombuffer(k2, np.uint64), np.frombuffer(several, bool))
            for chunk, k1, k2, several in zip(*(part.column(c).to_pylist() for c in ("chunk", "k1", "k2", "several")))
        ]
        all1, all2, more = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
        k1, k2, n = counted(all1, all2, 1 + more.astype(np.int64))
        k1, k2 = k1[n > 1], k2[n > 1]
        out = []
        for chunk, own1, own2, _ in rows:
            hit = pairs_among(own1, own2, k1, k2)
            if hit.any():
                out.append((chunk, pack(own1[hit]), _high(own2[hit]).tobytes()))
        columns = list(zip(*out)) or [()] * 3
        return pa.table({c: pa.array(v, k) for c, v, k in zip(("chunk", "k1", "k2"), columns, (pa.int64(), pa.binary(), pa.binary()))})

    return windows.groupBy("part").applyInArrow(group, "chunk long, k1 binary, k2 binary")


def _high(k2: np.ndarray) -> np.ndarray:
    """The high 16 bits, on which every word of a window bears; the low ones of a product of 64 bits are weaker."""
    return (k2 >> np.uint64(48)).astype(np.uint16)


def pairs_among(one: np.ndarray, two: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Which pairs (one, two) are among (k1, k2), ordered by k1."""
    found = np.zeros(len(one), bool)
    maybe = np.flatnonzero(member(one, k1))
    places = np.searchsorted(k1, one[maybe])
    while len(maybe):
        found[maybe] |= k2[places] == two[maybe]
        places += 1
        more = places < len(k1)
        more[more] = k1[places[more]] == one[maybe[more]]
        maybe, places = maybe[more], places[more]
    return found


def _kept_text(text: bytes, keep: np.ndarray) -> bytes:
    """The kept words with the white space that was between them, a blank where words are missing."""
    parts = re.split(rb"([ \t-\r]+)", text.strip())
    out, last = [], None
    for i in np.flatnonzero(keep).tolist():
        if last is not None:
            out.append(parts[2 * i - 1] if last == i - 1 else b" ")
        out.append(parts[2 * i])
        last = i
    return b"".join(out)


def _removal(chunks: DataFrame, truth: str, size: int, make_row: Callable, schema: str | StructType) -> DataFrame:
    """What ``make_row(texts, words, firsts, removed)`` returns for every piece of a chunk, as columns of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk, pieces in by_chunk(batches):
            got = read_partition(truth, "chunk", chunk, {"k1": pa.binary(), "k2": pa.binary()})
            k1 = np.concatenate([np.empty(0, np.uint64), *(unpack(k, np.uint64) for k in got["k1"].to_pylist())])
            k2 = np.frombuffer(b"".join(got["k2"].to_pylist()), np.uint16)
            order = np.argsort(k1)
            k1, k2 = k1[order], k2[order]
            for p in pieces:
                texts = _texts(p)
                words, firsts, starts, pairs = batch_windows(texts, size, hashes)
                hit = starts[pairs_among(pairs[:, 0], _high(pairs[:, 1]), k1, k2)]
                edge = np.zeros(sum(map(len, words)) + 1, np.int64)
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + size, -1)
                yield make_row(p, texts, words, firsts, np.cumsum(edge[:-1]) > 0)

    return chunks.mapInArrow(run, schema)


def _passes(docs: DataFrame, chunk: str, size: int, chunk_bytes: int) -> tuple[DataFrame, str]:
    """The stored chunks and the folder of each chunk's repeated windows."""
    spark = docs.sparkSession
    chunks = in_chunks(docs, chunk, chunk_bytes)
    texts = chunks.select(chunk, text_of(chunks).cast("binary").alias("text"))
    # A word and its blank take two bytes at least; five is usual. This only sets how wide the sketch is.
    size_all = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(16, int(CELLS_PER_WORD * size_all / 5).bit_length())
    replies, truth = scratch(spark, "windows-cells"), scratch(spark, "windows-repeated")
    repeated_cells(sketch(texts, size, bits), bits).repartition("chunk").write.partitionBy("chunk").parquet(replies)
    repeated(candidates(texts, replies, size, bits)).repartition("chunk").write.partitionBy("chunk").parquet(truth)
    return chunks, truth


def removed(docs: DataFrame, size: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by blanks) of every row."""
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    chunks, truth = _passes(plain, "chunk", size, chunk_bytes)

    def row(piece, texts, words, firsts, gone):
        n, cut, digest = [], [], []
        for ws, first in zip(words, firsts.tolist()):
            g = gone[first : first + len(ws)]
            n.append(len(ws))
            cut.append(int(g.sum()))
            kept = ws if not cut[-1] else [ws[i] for i in np.flatnonzero(~g).tolist()]
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [piece.column(2), pa.array(n, pa.int64()), pa.array(cut, pa.int64()), pa.array(digest, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    rows = chunks.select("chunk", text_of(chunks).cast("binary").alias("text"), "doc_id")
    return _removal(rows, truth, size, row, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cleaned(docs: DataFrame, size: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents, with their columns, without repeated passages; n_chars, if there, is counted anew. Texts without
    such passages are unchanged, and a document that loses all its words is dropped."""
    chunk = free_name(docs, "chunk")
    chunks, truth = _passes(docs, chunk, size, chunk_bytes)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    text, whole = free_name(docs, "text_"), free_name(docs, "whole")

    def row(piece, texts, words, firsts, gone):
        new, stay = [], []
        for t, ws, first in zip(texts, words, firsts.tolist()):
            g = gone[first : first + len(ws)]
            new.append(_kept_text(t, ~g) if g.any() else None)
            stay.append(not (len(ws) and g.all()))
        return pa.RecordBatch.from_arrays([*piece.columns[2:], pa.array(new, pa.binary()), pa.array(stay)], names=[*piece.schema.names[2:], text, whole])

    rows = chunks.select(chunk, text_of(chunks).cast("binary").alias(text), "text", *[f"`{c}`" for c in others])
    schema = rows.drop(chunk, text).schema.add(text, "binary").add(whole, "boolean")
    done = _removal(rows, truth, size, row, schema).filter(F.col(whole))
    final = F.coalesce(F.col(text).cast("string"), F.col("text"))
    values = {"text": final, "n_chars": F.length(final).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return done.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op6_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select rid, unnest(generate_series(1, len(w) - 34)) as i, w from d where len(w) >= 35),
keyed as (select rid, i, md5(array_to_string(w[i:i+34], ' ')) as k from win),
again as (select rid, i from (select *, count(*) over (partition by k) as n from keyed) where n > 1),
gone as (select distinct rid, i + j as p from again, (select unnest(generate_series(0, 34)) as j)),
word as (select rid, unnest(generate_series(1, len(w))) as p, unnest(w) as x from d),
kept as (select rid, string_agg(x, ' ' order by p) as t, count(*) as n from word anti join gone using (rid, p) group by rid)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(kept.n, 0))::bigint as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
from d left join kept using (rid)
"""
