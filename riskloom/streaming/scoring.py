"""Decisions on live requests: look up the newest features, score, decide."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions import cdc
from riskloom.functions.decisions import SERVICE_THRESHOLD, decide
from riskloom.operators import enrich
from riskloom.operators.latest import online_features
from riskloom.streaming import store
from riskloom.streaming.jobs import start

RECORD = "sk_id_curr string, probability double, decision string, threshold double, model string, version string, reason string, ts double"
Views = Callable[[], dict[str, DataFrame]]


def requested(messages: DataFrame, value: str = "value") -> DataFrame:
    """Customer ids of request messages, plain or in a CloudEvents envelope, each once."""
    body = cdc.unwrap_cloudevent(value)
    return messages.select(F.get_json_object(body, "$.sk_id_curr").alias("sk_id_curr")).where("sk_id_curr IS NOT NULL").distinct()


def decide_requests(
    keys: DataFrame, views: dict[str, DataFrame], score: Callable[[DataFrame], DataFrame], now: Column, model: str, version: str,
    threshold: float = SERVICE_THRESHOLD,
) -> DataFrame:
    """One decision record per key. ``score`` adds ``probability`` to rows of features; a key without
    live features, or without a probability, goes under review."""
    looked_up = online_features(keys, views, now)
    known = score(looked_up.where("found")).select("sk_id_curr", "probability")
    unknown = looked_up.where("NOT found").select("sk_id_curr", F.lit(None).cast("double").alias("probability"))
    scored = F.col("probability").isNotNull()
    return known.unionByName(unknown).select(
        "sk_id_curr",
        "probability",
        F.coalesce(decide("probability", threshold), F.lit("under-review")).alias("decision"),
        F.lit(threshold).alias("threshold"),
        F.lit(model).alias("model"),
        F.lit(version).alias("version"),
        F.when(~scored, "feature_data_unavailable").alias("reason"),
        enrich.now().alias("ts"),
    )


def decisions_job(
    messages: DataFrame, views: Views, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, model: str, version: str,
    threshold: float = SERVICE_THRESHOLD, now: Column | None = None, **options,
) -> StreamingQuery:
    """Request messages to a log of decisions. The model is the same for all batches, and
    ``views`` gives the live views as they are when a batch comes."""
    now = F.current_timestamp() if now is None else now

    def sink(batch: DataFrame, batch_id: int) -> None:
        records = decide_requests(requested(batch), views(), score, now, model, version, threshold)
        store.write_batch(records, batch_id, out, "sk_id_curr", ["ts"])

    return start(messages, sink, checkpoint, **options)
