"""Length-delimited binary records of token IDs, with an offset index for reading them in any order.

A record is: the length of its data (unsigned 64 bits), a masked CRC-32 of those eight bytes (32 bits), the data (token
IDs of 16 bits each if the vocabulary allows, else 32), a masked CRC-32 of the data; all little-endian. The mask rotates a checksum right by 15 bits and adds
0xA282EAD8, so data that holds checksums keeps apart from them. Documents are dealt out by ranges of doc_id, sorted, and
each task writes one file through the shared folder's own file system, under a name of its own attempt: only files named
in the index, which Spark commits, exist for readers, so a task that is run again or twice leaves no second copy. The
index (Parquet) has file, offset, size, width of an ID and first token of every record; readers take any of its rows, in any order, open
each file once, seek, and check lengths and checksums.

Defined cases: null texts are empty and have just the end ID; null IDs come first; rows with equal IDs, repeated rows
included, are records of their own, next to each other; an empty table gives an empty index; other columns are ignored.
"""

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_batches, scratch, stored, table, text_of
from .shared_files import opened
from .tokens import words, worker_tokens

#: Fixed values of the format.
MASK_DELTA = 0xA282EAD8
HEAD, TAIL = 12, 4
VOCABULARY = "word_bpe_49k.json"
END_ID = 1


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def framed(data: bytes) -> bytes:
    length = len(data).to_bytes(8, "little")
    return b"".join((length, masked(length).to_bytes(4, "little"), data, masked(data).to_bytes(4, "little")))


def unframed(record: bytes) -> bytes:
    """The data of a record; raises ValueError if a length or checksum is wrong."""
    length, data = record[:8], record[HEAD:-TAIL]
    if masked(length) != int.from_bytes(record[8:HEAD], "little") or int.from_bytes(length, "little") != len(data):
        raise ValueError("a record has another length than its head says")
    if masked(data) != int.from_bytes(record[-TAIL:], "little"):
        raise ValueError("a record's data don't match its checksum")
    return data


def write_records(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Writes the texts' IDs below ``path`` in ascending order of doc_id; returns the stored index: doc_id, file,
    offset, size (bytes of the record), width (bytes of an ID), n_tokens, start (IDs of all documents before)."""
    arrow_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    width = 2 if max(worker_tokens(vocabulary, words).tokenizer.get_vocab_size(), end_id) < 1 << 16 else 4
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task = worker_tokens(vocabulary, words), TaskContext.get()
        system, folder = opened(path)
        system.create_dir(folder, recursive=True)
        name, part = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.records", task.partitionId()
        offset = start = 0
        with system.open_output_stream(f"{folder}/{name}") as out:
            for b in batches:
                data = [narrowed(ids + end, width) for ids in tokens.encode(b.column(1).to_pylist())]
                sizes = np.array([len(d) for d in data], np.int64)
                out.write(b"".join(map(framed, data)))
                offsets, counts = np.cumsum(sizes + HEAD + TAIL), np.cumsum(sizes // width)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0), pa.array([part] * len(data), pa.int32()), pa.array([name] * len(data)), pa.array(offset + offsets - sizes - HEAD - TAIL),
                        pa.array(sizes + HEAD + TAIL), pa.array(sizes // width), pa.array(start + counts - sizes // width),
                    ],
                    names=["doc_id", "part", "file", "offset", "size", "n_tokens", "start_in_file"],
                )
                offset, start = offset + int(offsets[-1]), start + int(counts[-1])

    schema = "doc_id long, part int, file string, offset long, size long, n_tokens long, start_in_file long"
    index = stored(ordered.mapInArrow(write, schema), "records-index")
    # One row per file: their number is that of the tasks.
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    placed = index.join(F.broadcast(files), "part")
    return placed.select("doc_id", "file", "offset", "size", F.lit(width).alias("width"), "n_tokens", (F.col("start_in_file") + F.col("before")).alias("start"))


def narrowed(ids: bytes, width: int) -> bytes:
    """IDs of 32 bits in ``width`` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widened(data: bytes, width: int) -> bytes:
    """IDs of ``width`` bytes in 32 bits each."""
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def _read(index: DataFrame, path: str, name: str, kind: pa.DataType, value: Callable[[bytes], object], schema: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = opened(path)
        current, file = None, None
        try:
            for b in batches:
                rows = list(zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4))))
                values: list = [None] * len(rows)
                counts = [0] * len(rows)
                for i in sorted(range(len(rows)), key=rows.__getitem__):
                    if rows[i][0] != current:
                        if file:
                            file.close()
                        current = rows[i][0]
                        file = system.open_input_file(f"{folder}/{current}")
                    file.seek(rows[i][1])
                    ids = widened(unframed(file.read(rows[i][2])), rows[i][3])
                    values[i], counts[i] = value(ids), len(ids) // 4
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(5), pa.array(counts, pa.int64()), pa.array(values, kind)], names=["doc_id", "start", "n_tokens", name])
        finally:
            if file:
                file.close()

    columns = ["doc_id", "file", "offset", "size", "width", "start"]
    return index.select(*columns).mapInArrow(read, f"doc_id long, start long, n_tokens long, {schema}")


def read_records(index: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (32 bits each) of the index rows given, which may be any, in any order."""
    return _read(index, path, "ids", pa.binary(), bytes, "ids binary")


def read_checksums(index: DataFrame, path: str) -> DataFrame:
    """The same records read and checked; ids_crc32, of the IDs in 32 bits each, in place of the IDs."""
    return _read(index, path, "ids_crc32", pa.int64(), zlib.crc32, "ids_crc32 long")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "records")
    index = write_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    return read_checksums(index, path)
