"""Token ids in binary files of patched frame-of-reference blocks.

Documents are range-partitioned and sorted by id, tokenized, and written as segments; each
segment holds the ids of some documents in blocks of ``BLOCK``. A block subtracts its
minimum, packs the differences at the width of their ``PERCENTILE`` percentile and lists
the larger ones as exceptions (position and value); an index holds where each block starts,
so a document's ids are read without unpacking others. Files are written by Spark's text
writer (one row per segment, a line feed behind it) and read whole, so they commit like a
table and reach any store.

A segment holds the documents of about ``common.PORTION`` bytes of text; words are encoded
once per task (``words``). A file holds ``FILE_SEGMENTS`` segments at most, so none outgrows
what a reader takes whole.

Places in the whole corpus need one number per partition; their running sum is a window
over as many rows as there are partitions.

Defined cases: null text has the end id alone; null ids come first, equal ids are in order
of text; other columns are ignored; an empty table gives no segments and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import keyed, portions, small_batches, text_bytes, tidy, with_id
from riskloom.llm.words import WordEncoder
from riskloom.session import fresh_path

BLOCK = 4096
PERCENTILE = 95
FILE_SEGMENTS = 64
MAGIC = b"PFOR\x01"
_HEAD = struct.Struct("<IIQIQI")  # partition, segment, ids before it in the partition, documents, ids, blocks
_BLOCK = struct.Struct("<IBHH")  # minimum, width, exceptions, ids


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    width = int(np.partition(rest, (len(rest) - 1) * PERCENTILE // 100)[(len(rest) - 1) * PERCENTILE // 100]).bit_length()
    large = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    body = b""
    if width:
        bits = np.unpackbits(rest.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
        body = np.packbits(bits[:, 32 - width :]).tobytes()
    return _BLOCK.pack(low, width, len(large), len(ids)) + body + large.astype("<u2").tobytes() + rest[large].astype("<u4").tobytes()


def unpack_block(data: bytes, at: int) -> np.ndarray:
    low, width, n_large, n = _BLOCK.unpack_from(data, at)
    at += _BLOCK.size
    rest = np.zeros(n, np.uint32)
    if width:
        size = (n * width + 7) // 8
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width).reshape(n, width)
        wide = np.zeros((n, 32), np.uint8)
        wide[:, 32 - width :] = bits
        rest = np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)
        at += size
    if n_large:
        rest[np.frombuffer(data, "<u2", n_large, at)] = np.frombuffer(data, "<u4", n_large, at + 2 * n_large)
    return rest + np.uint32(low)


def pack_segment(part: int, number: int, before: int, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[k : k + BLOCK]) for k in range(0, len(ids), BLOCK)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = MAGIC + _HEAD.pack(part, number, before, len(keys), len(ids), len(blocks))
    body = head + keys.astype("<i8").tobytes() + sizes.astype("<u8").tobytes() + starts.tobytes() + b"".join(blocks)
    return body + struct.pack("<I", zlib.crc32(body))


class Segment:
    """A segment of a file's bytes."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        if data[at : at + len(MAGIC)] != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        self.data = data
        self.part, self.number, self.before, n_docs, self.n_ids, n_blocks = _HEAD.unpack_from(data, at + len(MAGIC))
        k = at + len(MAGIC) + _HEAD.size
        self.keys = np.frombuffer(data, "<i8", n_docs, k)
        self.sizes = np.frombuffer(data, "<u8", n_docs, k + 8 * n_docs).astype(np.int64)
        self.starts = np.frombuffer(data, "<u8", n_blocks + 1, k + 16 * n_docs).astype(np.int64)
        self.body = k + 16 * n_docs + 8 * (n_blocks + 1)
        self.end = self.body + int(self.starts[-1]) + 4
        if zlib.crc32(memoryview(data)[at : self.end - 4]) != struct.unpack_from("<I", data, self.end - 4)[0]:
            raise ValueError(f"damaged segment at byte {at}")

    def ids(self, first: int = 0, count: int | None = None) -> np.ndarray:
        """Ids from place ``first``, by the index of blocks."""
        count = self.n_ids - first if count is None else count
        if count <= 0:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, (first + count - 1) // BLOCK
        parts = [unpack_block(self.data, self.body + int(self.starts[k])) for k in range(a, b + 1)]
        return np.concatenate(parts)[first - a * BLOCK : first - a * BLOCK + count]


def segments(data: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(data):
        segment = Segment(data, at)
        yield segment
        at = segment.end + 1  # the line feed


def _encode(json_text: str, end_id: int, spelled: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(json_text, spelled)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in portions(batches):
            bodies = batch.column(1).to_pylist()
            coded = [encoder.encode_long(bodies[0])] if len(bodies) == 1 else encoder.encode(bodies)
            bodies = [b + end for b in coded]
            sizes = np.array([len(b) // 4 for b in bodies], np.int64)
            ids = np.frombuffer(b"".join(bodies), "<u4")
            blob = pack_segment(part, number, before, np.asarray(batch.column(0)), sizes, ids)
            number, before = number + 1, before + len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["blob"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key_col: str = "_u", text_col: str = "text", spelled: bool = True) -> None:
    """Files of ``docs`` in order of the long ``key_col``, which must be unique."""
    with open(tokenizer_path, encoding="utf-8") as f:
        json_text = f.read()
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key_col).alias("u"), text_bytes(text_col).alias("body"))
    ranged = rows.repartitionByRange("u").sortWithinPartitions("u")
    blobs = ranged.mapInArrow(tidy(_encode(json_text, end_id, spelled)), "blob binary")
    blobs.select(F.col("blob").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            for s in segments(content.as_py()):
                ids, n = s.ids(), len(s.keys)
                cut = np.concatenate([[0], np.cumsum(s.sizes)])
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                columns = [np.full(n, s.part, np.int64), s.keys, cut[:-1] + s.before, s.sizes, np.array(crc, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "u", "place", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``_u``, start (ids before it in the corpus), n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = files.mapInArrow(tidy(_read), "part long, u long, place long, n_tokens long, ids_crc32 long")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(totals.select("part", before.alias("before")), "part").select(F.col("u").alias("_u"), (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", spelled: bool = True) -> DataFrame:
    """Writes the files to the shared folder and returns what they hold, per document.
    ``spelled``: a special token in a text is spelled out; otherwise it has its own id, as
    the library's encoding with the file alone gives it."""
    table, plain = keyed(docs, id_col, text_col)
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(table, path, tokenizer_path, end_id, "_u", text_col, spelled)
    return with_id(read_tokens(docs.sparkSession, path), table, plain, id_col)
