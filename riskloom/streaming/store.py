"""Keyed sink of the streaming jobs: an upsert log of parquet folders.

Each micro-batch is reduced to its last row per key and written to its own
``batch_id`` folder. Replaying a batch after a failure replaces that folder, so the
log is idempotent; readers take the last row per key. No batch rewrites old data;
``compact`` folds a long log into a fresh one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.latest import latest_by
from riskloom.session import materialise


def write_batch(batch: DataFrame, batch_id: int, path: str, key: str, order: list[str]) -> None:
    latest_by(batch, key, order).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_latest(spark: SparkSession, path: str, schema: T.StructType, key: str, order: list[str]) -> DataFrame:
    """Live rows: last per key over the whole log, deleted keys (op ``d``) removed."""
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    log = spark.read.schema(stored).option("basePath", path).parquet(path)
    deleted = F.col("op") == "d" if "op" in schema.names else None
    return latest_by(log, key, [*order, "batch_id"], deleted).drop("batch_id")


def compact(spark: SparkSession, source: str, target: str, schema: T.StructType, key: str, order: list[str]) -> None:
    read_latest(spark, source, schema, key, order).write.mode("overwrite").parquet(f"{target}/batch_id=0")


def deliver(sink: Callable[[DataFrame, int], None], dead_letters: str, retries: int = 3) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that retries ``sink`` and, when it keeps failing,
    parks the batch's rows under ``dead_letters`` with the last error."""

    def run(batch: DataFrame, batch_id: int) -> None:
        error = None
        for _ in range(1 + retries):
            try:
                return sink(batch, batch_id)
            except Exception as e:  # any sink failure counts as an attempt
                error = e
        reason = F.lit(f"{type(error).__name__}: {error}")
        batch.withColumn("reason", reason).write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")

    return run


class RowsRefused(Exception):
    """Raised by a sink that can tell which rows of its batch it refuses: ``reason`` is a column over
    the batch, NULL for every row that the sink would take."""

    def __init__(self, reason: Column) -> None:
        super().__init__("the sink refuses rows")
        self.reason = reason


def deliver_rows(sink: Callable[[DataFrame, int], None], dead_letters: str, retries: int = 3) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that retries ``sink`` and, when it keeps failing, finds the rows
    at fault: these are parked under ``dead_letters``, each with its error, and all others
    delivered together. A sink that raises ``RowsRefused`` names them, and they are parted in one
    pass, however many they are; for all other errors the batch is halved until the rows at fault
    stand alone, about log2(rows) calls for each. A sink that fails without any row is down: the whole
    batch is parked. ``sink`` must replace what it wrote for the same batch before."""

    def run(batch: DataFrame, batch_id: int) -> None:
        def tried(rows: DataFrame) -> Exception | None:
            try:
                sink(rows, batch_id)
            except Exception as e:  # any sink failure counts as an attempt
                return e
            return None

        def attempt(rows: DataFrame) -> str | None:
            error = tried(rows)
            return f"{type(error).__name__}: {error}" if error else None

        def park(rows: DataFrame) -> None:
            rows.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")

        for _ in range(1 + retries):
            error = tried(batch)
            if error is None:
                return
            if isinstance(error, RowsRefused):  # a refusal does not pass
                break
        named = error.reason if isinstance(error, RowsRefused) else F.lit(None)
        kept = materialise(batch.withColumns({"_row": F.monotonically_increasing_id(), "_reason": named.cast("string")}), "batch")
        refused = kept.where("_reason IS NOT NULL").drop("_row").withColumnRenamed("_reason", "reason")
        kept = kept.where("_reason IS NULL").drop("_reason")
        if isinstance(error, RowsRefused) and attempt(kept.drop("_row")) is None:
            return park(refused)
        part = F.shiftright("_row", 33)  # rows are numbered from 0 in each partition of the batch
        first = kept.groupBy(part.alias("part")).agg(F.min("_row").alias("low"), F.max("_row").alias("high")).orderBy("part").collect()

        def at_fault(spans: list[tuple[int, int]]) -> list[tuple[int, str]]:
            """Rows at fault in ranges of numbers, both ends included."""
            if not spans:
                return []
            low, high = spans[0][0], spans[-1][1]
            error = attempt(kept.where(F.col("_row").between(low, high)).drop("_row"))
            if error is None:
                return []
            if low == high:
                return [(low, error)]
            if len(spans) > 1:
                return at_fault(spans[: len(spans) // 2]) + at_fault(spans[len(spans) // 2 :])
            middle = (low + high) // 2
            return at_fault([(low, middle)]) + at_fault([(middle + 1, high)])

        down = attempt(kept.limit(0).drop("_row"))
        faults = [] if down else at_fault([(r["low"], r["high"]) for r in first])
        bad = kept.sparkSession.createDataFrame(faults, "_row long, reason string")
        down = down or attempt(kept.join(bad, "_row", "left_anti").drop("_row"))
        found = kept.drop("_row").withColumn("reason", F.lit(down)) if down else kept.join(bad, "_row").drop("_row")
        park(found.unionByName(refused))

    return run
