"""File, JDBC and Kafka sources, load ledger and snapshot sink."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("md5", T.StringType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; empty fields are NULL."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def table_name(file_name: str) -> str:
    """Table for a file: lower case, other characters to "_", no extension."""
    stem = re.sub(r"\.[A-Za-z0-9]+$", "", file_name.rsplit("/", 1)[-1])
    return re.sub(r"[^a-z0-9_]", "_", stem.lower())


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """md5 of each listed file, read in chunks by the task that holds its row."""
    from pyarrow import fs

    for batch in batches:
        sums = []
        for uri in batch["path"]:
            system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri) if uri.startswith("file:") else uri)
            digest = hashlib.md5()
            with system.open_input_stream(path) as stream:
                while chunk := stream.read(4 << 20):
                    digest.update(chunk)
            sums.append(digest.hexdigest())
        yield batch.assign(md5=sums)


def file_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Table, file, size and md5 of the files under ``path``. The listing does not
    read file contents; checksums are streamed in tasks, one file per row."""
    listed = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.lower(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""))
    return (
        listed.mapInPandas(_digests, "path string, bytes bigint, md5 string")
        .select(F.regexp_replace(stem, "[^a-z0-9_]", "_").alias("table_name"), name.alias("file"), "bytes", "md5")
    )


def pending_files(ledger: DataFrame, loaded: DataFrame) -> DataFrame:
    """Ledger rows not loaded before (same table, file, size and checksum)."""
    return ledger.join(loaded, ["table_name", "file", "bytes", "md5"], "left_anti")


def load_once(spark: SparkSession, path: str, ledger_path: str, schema: T.StructType, target: str) -> int:
    """Append the CSV files under ``path`` that the ledger does not know, then record
    them. Data is written before the ledger and keyed by checksum, so a retry after a
    lost job overwrites its own folder instead of doubling rows."""
    try:
        loaded = spark.read.schema(LEDGER).parquet(ledger_path)
    except Exception as e:  # no ledger yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        loaded = spark.createDataFrame([], LEDGER)
    todo = pending_files(file_ledger(spark, path), loaded).collect()  # one small row per new file
    for row in todo:
        read_csv(spark, f"{path}/{row['file']}", schema).write.mode("overwrite").parquet(f"{target}/md5={row['md5']}")
    if todo:
        spark.createDataFrame(todo, LEDGER).write.mode("append").parquet(ledger_path)
    return len(todo)


def load_if_empty(df: DataFrame, target: str) -> bool:
    """Write ``df`` only when ``target`` holds no rows yet."""
    spark = df.sparkSession
    try:
        filled = not spark.read.parquet(target).isEmpty()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        filled = False
    if not filled:
        df.write.mode("overwrite").parquet(target)
    return not filled


def export_snapshot(features: DataFrame, labels: DataFrame, key: str, root: str, day: str) -> str:
    """Features joined with labels as CSV under ``root/ds=day``, replacing that day
    only."""
    path = f"{root}/ds={day}"
    write_csv(features.join(labels, key), path)
    return path


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 1,
) -> DataFrame:
    """A JDBC table; with ``column`` and ``bounds`` it is read by many tasks."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if column and bounds:
        low, high = bounds
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    return reader.load()


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_records: int | None = None) -> DataFrame:
    """Key and value text of a topic from its earliest offset (needs the Kafka
    connector on the classpath)."""
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    )
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "partition", "offset")


def text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """JSON lines as a stream of ``value`` text, like a topic."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)


def upsert_messages(df: DataFrame, key: str) -> DataFrame:
    """Key and JSON value of each row, for a keyed topic (NULL value = delete)."""
    body = F.to_json(F.struct(*[c for c in df.columns if c != "op"]), {"ignoreNullFields": "false"})
    value = F.when(F.col("op") == "d", None).otherwise(body) if "op" in df.columns else body
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def empty_source(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Placeholder for an offline source that does not exist yet."""
    return spark.createDataFrame([], schema)
