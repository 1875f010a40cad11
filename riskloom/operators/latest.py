"""Latest-row semantics: status log, online feature views, readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The three feature sources, the views they write, and view lifetimes.
SOURCES = ["application", "external", "dwh"]
VIEWS = {"application": "application_features", "external": "external_features", "dwh": "dwh_features"}
TTL_DAYS = {"application_features": 1, "external_features": 7, "dwh_features": 7}


def latest_by(df: DataFrame, key: str, order: list[str], deleted: Column | None = None) -> DataFrame:
    """The last row per key by ``order``; keys whose last row is ``deleted`` vanish.

    ``max_by`` keeps one candidate per key and task before the shuffle, so neither a
    sort nor a window ever sees all rows of a hot key.
    """
    rest = [c for c in df.columns if c != key]
    rows = df if deleted is None else df.withColumn("_gone", deleted)
    last = F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order))
    out = rows.groupBy(key).agg(last.alias("_last"))
    if deleted is not None:
        out = out.where(~F.coalesce(F.col("_last._gone"), F.lit(False)))
    return out.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def current_status(log: DataFrame) -> DataFrame:
    """Newest status of every application."""
    newest = latest_by(log.select("sk_id_curr", "id", "status", "created_at", "created_by", "metadata"), "sk_id_curr", ["created_at", "id"])
    return newest.select(
        "sk_id_curr",
        F.col("status").alias("current_status"),
        F.col("created_at").alias("status_updated_at"),
        F.col("created_by").alias("last_updated_by"),
        "metadata",
    )


def status_history(log: DataFrame, key: str | Column, limit: int | None = None) -> DataFrame:
    """One application's statuses, newest first; ``limit=1`` gives its latest."""
    history = log.where(F.col("sk_id_curr") == key).orderBy(F.col("created_at").desc(), F.col("id").desc())
    return history if limit is None else history.limit(limit)


def online_features(keys: DataFrame, views: dict[str, DataFrame], now: Column, ttl_days: dict[str, int] | None = None) -> DataFrame:
    """The requested keys with the live row of each view (``view__feature`` columns)
    and ``found``: whether any feature has a value. Rows past their view's lifetime
    do not count. Each view holds one row per key."""
    ttl_days = TTL_DAYS if ttl_days is None else ttl_days
    out, features = keys.select("sk_id_curr").distinct(), []
    for name, view in views.items():
        live = view.where(F.col("event_timestamp") > now - F.make_dt_interval(days=F.lit(ttl_days.get(name, 7))))
        columns = [c for c in view.columns if c not in ("sk_id_curr", "event_timestamp")]
        out = out.join(live.select("sk_id_curr", *[F.col(c).alias(f"{name}__{c}") for c in columns]), "sk_id_curr", "left")
        features += [F.col(f"{name}__{c}") for c in columns]
    present = reduce(lambda a, b: a | b, [c.isNotNull() for c in features])
    return out.withColumn("found", present)


def _sessions(arrivals: DataFrame, ttl_seconds: int) -> DataFrame:
    """Sessions per key: a pause longer than the lifetime empties the source set.

    Arrivals are first reduced to one row per key and time slot of the lifetime's
    length (a slot cannot contain a longer pause), so the ordered step sees at most
    one row per slot, however many arrivals a hot key has.
    """
    lifetime = ttl_seconds * 1_000_000
    at = F.unix_micros("ts")
    slots = (
        arrivals.withColumns({"at": at, "slot": F.floor(at / lifetime)})
        .groupBy("sk_id_curr", "slot")
        .agg(
            F.min("at").alias("opened"),
            F.max("at").alias("closed"),
            *[F.min(F.when(F.col("source") == s, F.col("at"))).alias(s) for s in SOURCES],
        )
    )
    order = Window.partitionBy("sk_id_curr").orderBy("slot")
    fresh = F.col("opened") - F.lag("closed").over(order) > lifetime
    return slots.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int")).withColumn(
        "session", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )


def feature_ready(arrivals: DataFrame, ttl_seconds: int, every_write: bool = False) -> DataFrame:
    """When all three sources of a key are present within the lifetime, which grows
    with each write. One event per session at the completing write; with
    ``every_write`` also one for each later write of that session."""
    sessions = _sessions(arrivals, ttl_seconds)
    complete = (
        sessions.groupBy("sk_id_curr", "session")
        .agg(*[F.min(s).alias(s) for s in SOURCES])
        .dropna(subset=SOURCES)
        .withColumn("ready", F.greatest(*SOURCES))
    )
    if not every_write:
        completing = F.coalesce(*[F.when(F.col(s) == F.col("ready"), s) for s in SOURCES])
        return complete.select("sk_id_curr", completing.alias("source"), F.timestamp_micros("ready").alias("ts"))
    lifetime = ttl_seconds * 1_000_000
    started = sessions.select("sk_id_curr", "slot", "session").join(
        complete.select("sk_id_curr", "session", "ready"), ["sk_id_curr", "session"]
    )
    slotted = arrivals.withColumn("slot", F.floor(F.unix_micros("ts") / lifetime))
    return (
        slotted.join(started, ["sk_id_curr", "slot"])
        .where(F.unix_micros("ts") >= F.col("ready"))
        .select("sk_id_curr", "source", "ts")
    )
