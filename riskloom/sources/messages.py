"""Message streams derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators import cdc

CREATED = "2024-01-01T08:00:00"


def _wire_amount(amount: Column, number: Column) -> Column:
    """Cents as base64 bytes, or as number text when ``number`` holds."""
    cents = F.round(amount * 100).cast("bigint")
    encoded = F.base64(F.unhex(F.lpad(F.hex(cents), 16, "0")))
    return F.when(
        number, F.format_string("%d.%02d", F.floor(cents / 100).cast("bigint"), F.pmod(cents, F.lit(100)))
    ).otherwise(encoded)


def _wire_date(offset: Column, iso: Column) -> Column:
    day = F.date_add(F.to_date(F.lit(CREATED)), offset.cast("int"))
    return F.when(iso, day.cast("string")).otherwise(F.unix_date(day).cast("string"))


def application_row(application: DataFrame) -> Column:
    """An application as the change stream carries it: encodings alternate by key."""
    key = F.col("SK_ID_CURR")
    even = key % 2 == 0
    made = {
        "sk_id_curr": key.cast("string"),
        "birth_date": _wire_date(F.col("DAYS_BIRTH"), even),
        "employment_start_date": _wire_date(F.col("DAYS_EMPLOYED"), ~even),
        "created_at": F.lit(CREATED),
        "updated_at": F.lit(CREATED),
    }
    made |= {c: _wire_amount(F.col(c.upper()), even) for c in cdc.AMOUNTS}
    made |= {
        f"document_id_{n}": F.when(F.col(f"FLAG_DOCUMENT_{n}") == 1, F.concat(F.lit(f"doc_{n}_"), key)).when(
            key % 3 == 1, F.lit("  ")
        )
        for n in cdc.DOCUMENTS
    }
    return F.struct(*[made.get(f.name, F.col(f.name.upper())).alias(f.name) for f in cdc.ROW.fields])


def cdc_messages(application: DataFrame) -> DataFrame:
    """``key`` and JSON ``value``: creates, updates (every 5th key), deletes (every
    53rd) and cut-off text (every 101st)."""
    key = F.col("SK_ID_CURR")
    row = application_row(application)
    deleted, updated = key % 53 == 0, key % 5 == 0
    op = F.when(deleted, "d").when(updated, "u").otherwise("c")
    payload = F.struct(
        op.alias("op"),
        F.lit(1_704_096_000_000).alias("ts_ms"),
        F.when(deleted | updated, row).alias("before"),
        F.when(~deleted, row).alias("after"),
    )
    text = F.to_json(F.struct(payload.alias("payload")))
    cut = F.when(key % 101 == 0, F.substring(text, 1, 60)).otherwise(text)
    return application.select(key.cast("string").alias("key"), cut.alias("value"))
