"""Token ids of documents in seekable binary files.

A file is a run of zstandard frames, each readable alone and with its own content checksum, then a skippable
frame with the directory of documents, then the seek table of the zstandard seekable format (one entry per
frame: compressed size, plain size, low 32 bits of the plain bytes' XXH64). A reader takes the directory and the
table from the end of a file and decompresses only the frames that hold the documents it wants.

Files are written by Spark's text writer: one row is one file, and its line separator is the magic number that
ends a seek table. They so reach any store that Spark reaches, and a task that is lost leaves none behind.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import block_offsets
from ..session import materialize
from .tokens import WordEncoder, encoder

# Fixed values of the zstandard seekable format.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_TOKENS = 1 << 17
FILE_TOKENS = 1 << 21
ENTRY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("first", "<u4"), ("count", "<u4"), ("before", "<i8")])


class _File:
    """Frames, seek table and directory of one file while it is built."""

    def __init__(self, block: int, number: int):
        self.block, self.number, self.frames, self.table, self.entries = block, number, [], [], []
        self.open: list[np.ndarray] = []
        self.open_tokens = self.tokens = 0
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)

    def add(self, doc_id, ids: np.ndarray, before: int) -> None:
        self.entries.append((doc_id or 0, doc_id is not None, len(self.frames), self.open_tokens, len(ids), before))
        self.open.append(ids)
        self.open_tokens += len(ids)
        self.tokens += len(ids)
        if self.open_tokens >= FRAME_TOKENS:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            plain = np.concatenate(self.open).astype("<u4")
            # the four bytes of the ids are stored apart, which compresses the high ones away
            plain = np.ascontiguousarray(plain.view(np.uint8).reshape(-1, 4).T).tobytes()
            packed = self.zstd.compress(plain)
            self.frames.append(packed)
            self.table.append(struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.open, self.open_tokens = [], 0

    def data(self) -> bytes:
        """All bytes but the last four, which the writer's line separator adds."""
        self.close_frame()
        directory = struct.pack("<qI", self.block, self.number) + np.array(self.entries, ENTRY).tobytes()
        directory = self.zstd.compress(directory)
        table = b"".join(self.table) + struct.pack("<IB", len(self.table), CHECKSUM_FLAG)
        return b"".join(
            [*self.frames, struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)), directory,
             struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + 4), table]
        )


def _write_files(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, block = encoder(WordEncoder, path), TaskContext.get().partitionId()
    file, number, before = _File(block, 0), 0, 0
    end = struct.pack("<I", end_id)
    row = lambda f: pa.RecordBatch.from_pydict({"data": pa.array([f.data()], pa.binary())})
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.frombuffer(encode(text.as_py() or b"") + end, "<u4")
            file.add(doc_id, ids, before)
            before += len(ids)
            if file.tokens >= FILE_TOKENS:
                yield row(file)
                number += 1
                file = _File(block, number)
    if file.entries:
        yield row(file)


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, partitions: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each document and write the files in ascending doc_id.

    A null text has the end id alone; rows without a doc_id come first; rows that repeat a doc_id are all
    written, in the order of their texts' hashes, and may stand in several ranges. No row gives no file. Other columns are not read.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_key"))
    ordered = ordered.repartitionByRange(n, "doc_id", "text_key").sortWithinPartitions("doc_id", "text_key", "text").select("doc_id", "text")
    files = ordered.mapInArrow(lambda it: _write_files(it, tokenizer_file, end_id), "data binary")
    (
        files.select(F.col("data").cast("string").alias("value")).write.mode("overwrite")
        .option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
        .option("lineSep", struct.pack("<I", SEEKABLE_MAGIC).decode("latin-1")).text(path)
    )


def read_file(data: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int, int, int | None, int, np.ndarray]]:
    """(block, file number, doc_id, ids in the block before it, ids) of a file's documents, or of those ``wanted``.
    Raises ValueError where a checksum or a magic number is wrong."""
    view = memoryview(data)
    n, flag, magic = struct.unpack("<IBI", view[-9:])
    if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
        raise ValueError("not a seekable file")
    table = np.frombuffer(view[len(view) - 9 - 12 * n : len(view) - 9], np.dtype("<u4")).reshape(n, 3)
    start = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
    kind, size = struct.unpack("<II", view[start[-1] : start[-1] + 8])
    if kind != SKIPPABLE_DIRECTORY:
        raise ValueError("no directory")
    zstd = zstandard.ZstdDecompressor()
    directory = zstd.decompress(bytes(view[start[-1] + 8 : start[-1] + 8 + size]))
    block, number = struct.unpack("<qI", directory[:12])
    at, plain = -1, None
    for doc_id, known, frame, first, count, before in np.frombuffer(directory, ENTRY, offset=12).tolist():
        if wanted is not None and (not known or doc_id not in wanted):
            continue
        if frame != at:
            raw = zstd.decompress(bytes(view[start[frame] : start[frame + 1]]), max_output_size=int(table[frame, 1]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != table[frame, 2]:
                raise ValueError(f"checksum of frame {frame}")
            plain = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()
            at = frame
        yield block, number, doc_id if known else None, before, plain[first : first + count]


READ = "block long, doc_id long, before long, n_tokens long, ids binary"


def _read_files(batches: Iterator[pa.RecordBatch], wanted: set[int] | None) -> Iterator[pa.RecordBatch]:
    def made(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())],
            ["block", "doc_id", "before", "n_tokens", "ids"],
        )

    for batch in batches:
        for data in batch.column(0):
            rows, held = [], 0
            for block, _, doc_id, before, ids in read_file(data.as_buffer(), wanted):
                rows.append((block, doc_id, before, len(ids), ids.tobytes()))
                held += len(ids)
                if held >= FRAME_TOKENS * 4:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of the files at ``path``: block (files written by one task), doc_id, before (ids of the block's
    documents before it), n_tokens, ids (little-endian unsigned 32-bit). With ``doc_ids``, frames without any of
    them stay compressed."""
    wanted = None if doc_ids is None else set(doc_ids)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda it: _read_files(it, wanted), READ)


def token_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (the ids of all documents before it), n_tokens and ids_crc32 of every document of the files at ``path``.

    Each document that was written gives a row: a null or empty text its end id alone, a row without a doc_id a missing one,
    repeated rows a row each, one after the other. Files of an empty table, or no files, give no rows.
    """
    read = read_token_files(spark, path).select("block", "doc_id", "before", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    found = materialize(read, "read")  # the files are unpacked once
    offsets = block_offsets(found.groupBy("block").agg(F.sum("n_tokens").alias("tokens")), "block", "tokens")
    return found.join(offsets, "block").select(
        "doc_id", (F.col("before_tokens") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
