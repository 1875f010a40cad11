"""End-to-end latency on live streams: each submission with the first decision in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.streaming import store
from riskloom.streaming.jobs import start

SCHEMA = "submission long, sk_id_curr string, sent timestamp, done timestamp, age long"


def decided_in_time(submitted: DataFrame, decided: DataFrame, within: str, delay: str) -> DataFrame:
    """Streams of submissions (id, sk_id_curr, created_at) and decisions (sk_id_curr, created_at),
    outer-joined: a row per submission and decision of its customer ``within`` that time, or one
    without a decision once the watermark says that none can come. State holds the rows of
    that time and ``delay`` only; a row that comes later than ``delay`` is dropped."""
    sent = submitted.select(F.col("id").alias("submission"), "sk_id_curr", F.col("created_at").alias("sent")).withWatermark("sent", delay)
    done = decided.select(F.col("sk_id_curr").alias("customer"), F.col("created_at").alias("done")).withWatermark("done", delay)
    in_time = F.expr(f"customer = sk_id_curr AND done >= sent AND done <= sent + INTERVAL {within}")
    pairs = sent.join(done, in_time, "left_outer")
    return pairs.select("submission", "sk_id_curr", "sent", "done", (-F.unix_micros("done")).alias("age"))


def latency_job(submitted: DataFrame, decided: DataFrame, out: str, checkpoint: str, within: str, delay: str, **options) -> StreamingQuery:
    """The first decision of each submission into a log under ``out``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch, batch_id, out, "submission", ["age"])

    return start(decided_in_time(submitted, decided, within, delay), sink, checkpoint, **options)


def read_latency(spark: SparkSession, out: str) -> DataFrame:
    """Seconds from each submission to its first decision in time, NULL without one."""
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = store.read_latest(spark, out, schema, "submission", ["age"])
    return rows.select("submission", "sk_id_curr", ((F.unix_micros("done") - F.unix_micros("sent")) / F.lit(1e6)).alias("seconds"))
