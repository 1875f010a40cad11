"""Plan shapes for wide aggregates and hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_parts(df: DataFrame, key: str, max_rows: int, spread_by: list[str]) -> DataFrame:
    """Add PART (and PARTS, the key's number of parts) so that no (key, PART) group much exceeds ``max_rows`` rows.

    Keys are counted with a map-side combine; the few over the limit get
    ceil(count / max_rows) parts and their rows are dealt by a hash of
    ``spread_by`` (which should identify a row). All other keys get PART 0. Only
    the over-limit keys are joined back: at most one per ``max_rows`` rows of ``df``,
    which Spark broadcasts when its measured size allows, and otherwise joins by
    shuffle with its skew handling.
    """
    hot = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_ROWS"))
        .where(F.col("_ROWS") > max_rows)
        .select(key, F.ceil(F.col("_ROWS") / max_rows).cast("int").alias("PARTS"))
    )
    parts = F.coalesce("PARTS", F.lit(1))
    dealt = F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    return df.join(hot, key, "left").withColumns({"PART": dealt, "PARTS": parts})


def aggregate_with_distinct(df: DataFrame, key: str, aggregates: list[Column], distinct: dict[str, str]) -> DataFrame:
    """Plain aggregates and distinct counts (name -> column) per key, over rows that move once.

    A wide buffer per key is larger than the few rows of a key that a task meets before a shuffle,
    and a copy of each row per distinct count larger still. So the rows themselves are dealt
    by the key; there each distinct count marks the first row of a value among its key's
    rows, in order of (key, value), and one aggregate sums the marks beside the rest. All rows of a
    key are read by one task, which sorts and adds them up without holding them. The result
    stays dealt by the key, so a join on it moves nothing.
    """
    rows = df.repartition(F.col(key))
    for name, c in distinct.items():
        nth = F.row_number().over(Window.partitionBy(key, c).orderBy(c))
        rows = rows.withColumn(f"_{name}", F.col(c).isNotNull() & (nth == 1))
    return rows.groupBy(key).agg(*aggregates, *[F.count_if(f"_{name}").alias(name) for name in distinct])


def dealt(df: DataFrame, key: str, per_task: int = 250_000) -> DataFrame:
    """``df`` dealt by ``key`` into as many partitions as give each about ``per_task`` rows, so that what a
    task holds does not grow with the data. The rows are counted first."""
    return df.repartition(max(1, -(-df.count() // per_task)), F.col(key))
