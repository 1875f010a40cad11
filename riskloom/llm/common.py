"""Helpers that the operators of this folder share.

Rows are told apart by ``_u``, a long that rises with the id. Where ids are whole,
unique and not null it is the id itself. Otherwise (repeated rows, null ids, ids of
another type) the rows are sorted once by (id, text), nulls first, and numbered.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import materialise

TASK_BYTES = 16 << 20  # text that one group of a shuffle should hold
PORTION = 4 << 20  # text that a task looks at together
BATCH_BYTES = 8 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it


def keyed(df: DataFrame, id_col: str, *columns: str) -> tuple[DataFrame, bool]:
    """``_u``, ``id_col`` and ``columns`` of ``df``, and whether ``_u`` is the id; see the
    module text for ``_u``."""
    rows = df.select(id_col, *columns)
    whole = isinstance(rows.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if whole:
        odd = rows.groupBy(id_col).count().where((F.col("count") > 1) | F.col(id_col).isNull())
        whole = odd.isEmpty()
    if whole:
        return rows.select(F.col(id_col).cast("long").alias("_u"), id_col, *columns), True
    order = [F.col(c).asc_nulls_first() for c in (id_col, *columns)]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ranged.select(F.monotonically_increasing_id().alias("_u"), id_col, *columns), "keyed"), False


def text_bytes(c: str = "text") -> Column:
    """UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.col(c).cast("binary"), F.lit(b""))


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else untouched."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets(df: DataFrame, size: Column, per_task: int = TASK_BYTES) -> int:
    """How many groups of about ``per_task`` the sum of ``size`` over ``df`` makes."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return max(1, -(-int(total) // per_task))


def held_out(id_col: str, parts: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == 2, F.lit(False))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a binary column in one array, and where each begins
    (one more entry than values). Values must not be null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    if not len(at):
        at = np.zeros(1, np.int64)
    return data[at[0] : at[-1]], at - at[0]


def with_id(found: DataFrame, rows: DataFrame, plain: bool, id_col: str) -> DataFrame:
    """``found`` with the id in place of ``_u``."""
    if plain:
        kind = rows.schema[id_col].dataType
        rest = [c for c in found.columns if c != "_u"]
        return found.select(F.col("_u").cast(kind).alias(id_col), *rest)
    return rows.select("_u", id_col).join(found, "_u").drop("_u")


def small_batches(spark: SparkSession) -> None:
    """Rows reach Python by batches of at most ``BATCH_BYTES``: what is sent is held in the JVM
    and in the worker at once, whatever the length of the texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Returns freed memory to the system. Python workers live on from task to task, so what
    they hold without need still counts against their executor in the next stage."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def portions(batches: Iterator[pa.RecordBatch], size: int = PORTION) -> Iterator[pa.RecordBatch]:
    """Rows whose last column, of bytes, holds about ``size`` together; a longer value comes alone."""
    for batch in batches:
        at = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(batch.column(batch.num_columns - 1)), np.int64))])
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def tidy(run: Callable) -> Callable:
    """``run`` over batches, which gives memory back at its end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def tidy_group(run: Callable) -> Callable:
    """``run`` over one group's table, which gives memory back at its end."""

    def whole(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out

    return whole


def reduce_sum(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i + 1]]``; empty stretches give zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, 0)])
    return total[starts[1:]] - total[starts[:-1]]
