"""Streaming jobs: the batch operators applied to micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.cdc import cdc_key, cdc_op
from riskloom.operators import cdc, enrich, nested
from riskloom.operators.latest import latest_by
from riskloom.streaming import store


def start(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None, parked: str | None = None
) -> StreamingQuery:
    """Run ``sink`` per micro-batch: once over what is available, or every
    ``interval`` (for example "300 milliseconds"). With ``parked`` a failing batch is tried
    again, and rows at fault go to that folder; otherwise the query fails."""
    sink = store.deliver_rows(sink, parked) if parked else sink
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def cdc_job(messages: DataFrame, features: str, dead_letters: str, checkpoint: str, **options) -> StreamingQuery:
    """Change messages to the application feature log; unreadable ones aside."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = cdc.flatten(batch)
        store.write_batch(rows, batch_id, features, "sk_id_curr", ["ts_ms", *cdc.position(batch)])
        cdc.rejects(batch).write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")

    return start(messages, sink, checkpoint, **options)


def live_change(found: Column, value: str = "value") -> Column:
    """``found`` for changes that leave a row, NULL for deletes."""
    return F.when(F.coalesce(cdc_op(value), F.lit("c")) != "d", found)


def change_keys(messages: DataFrame, value: str = "value") -> DataFrame:
    """Customer ids of changes that leave a row: deletes are not enriched."""
    live = messages.where(live_change(F.lit(True), value))
    return live.select(cdc_key(value).alias("sk_id_curr")).where("sk_id_curr IS NOT NULL")


def bureau_enrich_job(
    messages: DataFrame, bureau: DataFrame, balance: DataFrame, scores: DataFrame, out: str, checkpoint: str, **options
) -> StreamingQuery:
    """Change messages to nested bureau messages (JSON text, one folder per batch)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = enrich.enrich_bureau(change_keys(batch), bureau, balance, scores)
        rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(f"{out}/batch_id={batch_id}")

    return start(messages, sink, checkpoint, **options)


def bureau_features_job(messages: DataFrame, features: str, parts: str, dead_letters: str, checkpoint: str, **options) -> StreamingQuery:
    """Nested bureau messages to the external feature log. Parts of a split customer may
    come in several batches and go to a log of their own, one row per customer and part;
    unreadable messages are put aside, each with its text."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        whole, split, bad = nested.sorted_out(nested.parse_messages(batch))
        store.write_batch(nested.nested_features(whole), batch_id, features, "sk_id_curr", ["ts"])
        store.write_batch(split, batch_id, parts, "part_key", ["ts"])
        bad.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")

    return start(messages, sink, checkpoint, **options)


def read_bureau_features(spark: SparkSession, features: str, parts: str) -> DataFrame:
    """Newest external features of every customer, from whole messages or from the newest split
    message of which all parts have come; until then the features before it hold."""
    parsed = nested.parse_messages(spark.createDataFrame([], "value string"))
    whole, split, _ = nested.sorted_out(parsed)
    schema = nested.nested_features(whole).schema
    rows = store.read_latest(spark, parts, split.schema, "part_key", ["ts"]).drop("part_key")
    message = rows.groupBy("sk_id_curr", "ts").agg(F.count(F.lit(1)).alias("came"), F.max("parts").alias("wanted"))
    newest = message.where("came >= wanted").groupBy("sk_id_curr").agg(F.max("ts").alias("newest"))
    rows = rows.join(newest, "sk_id_curr").where(F.col("ts").eqNullSafe(F.col("newest")))
    both = store.read_latest(spark, features, schema, "sk_id_curr", ["ts"]).unionByName(nested.split_features(rows.drop("newest")))
    return latest_by(both, "sk_id_curr", ["ts"])


Marts = list[DataFrame] | Callable[[DataFrame], list[DataFrame]]


def warehouse_job(messages: DataFrame, marts: Marts, features: str, checkpoint: str, **options) -> StreamingQuery:
    """Change messages to the warehouse feature log. ``marts`` are tables with a row per customer
    (bucketed by the customer, a batch moves its keys alone), or a function that makes them for
    a batch's keys from raw tables cut to these keys."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        keys = change_keys(batch)
        rows = enrich.enrich_warehouse(keys, marts(keys) if callable(marts) else marts)
        store.write_batch(rows, batch_id, features, "sk_id_curr", ["ts"])

    return start(messages, sink, checkpoint, **options)
