"""Enrichment of application keys with bureau history and warehouse features.

One stream-static join per micro-batch (or one join over a whole key table)
replaces a warehouse query per message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.skew import with_parts

KEY = "SK_ID_CURR"
RECORD = "SK_ID_BUREAU"

# Fields of the nested records, as they are named on the wire.
BUREAU_FIELDS = [
    "sk_id_bureau",
    "credit_type",
    "credit_active",
    "credit_day_overdue",
    "amt_credit_sum_overdue",
    "amt_credit_max_overdue",
    "cnt_credit_prolong",
    "amt_credit_sum_debt",
    "amt_credit_sum_limit",
    "amt_credit_sum",
]
BALANCE_FIELDS = ["sk_id_bureau", "months_balance", "status"]
SCORE_FIELDS = ["ext_source_1", "ext_source_2", "ext_source_3"]


def numeric_keys(keys: DataFrame, key: str = "sk_id_curr") -> DataFrame:
    """Keys that are whole numbers, each once: ``key`` as sent and ``customer``, its
    number. (Spark resolves names without regard to case, so the wire name
    sk_id_curr cannot stand beside SK_ID_CURR.)"""
    return (
        keys.select(F.col(key).alias("key"), F.col(key).try_cast("bigint").alias("customer"))
        .where(F.col("customer").isNotNull())
        .distinct()
    )


def rejected_keys(keys: DataFrame, key: str = "sk_id_curr") -> DataFrame:
    """Keys the enrichers drop: absent or not a whole number."""
    return keys.where(F.col(key).try_cast("bigint").isNull())


def now() -> Column:
    """Seconds since the epoch to the microsecond, the same for all rows of a batch."""
    return F.unix_micros(F.current_timestamp()) / F.lit(1e6)


def _record(fields: list[str]) -> Column:
    return F.struct(*[F.col(f.upper()).alias(f) for f in fields])


def enrich_bureau(
    keys: DataFrame, bureau: DataFrame, balance: DataFrame, scores: DataFrame, max_rows: int = 50_000
) -> DataFrame:
    """One nested message per key: ``bureau[]``, ``bureau_balance[]``,
    ``external_scores`` and ``ts``; arrays are empty for a key without history.

    A message is one row, so a customer with more than ``max_rows`` records gets
    several, numbered ``part`` of ``parts``; together they hold every record.
    """
    wanted = numeric_keys(keys)
    customers = wanted.select(F.col("customer").alias(KEY)).distinct()
    owned = bureau.join(customers, KEY, "left_semi")
    record, month = _record(BUREAU_FIELDS), _record(BALANCE_FIELDS)
    histories = balance.join(owned.select(KEY, RECORD).distinct(), RECORD)
    rows = owned.select(
        KEY, RECORD, F.lit(None).cast("bigint").alias("m"), record.alias("b"), F.lit(None).cast(month_type(balance)).alias("h")
    ).unionByName(
        histories.select(
            KEY,
            RECORD,
            F.col("MONTHS_BALANCE").try_cast("bigint").alias("m"),
            F.lit(None).cast(record_type(bureau)).alias("b"),
            month.alias("h"),
        )
    )
    nested = (
        with_parts(rows, KEY, max_rows, [RECORD, "m"])
        .groupBy(KEY, "PART")
        .agg(
            F.max("PARTS").alias("parts"),
            F.collect_list("b").alias("bureau"),
            F.collect_list("h").alias("bureau_balance"),
        )
    )
    found = scores.select(
        KEY, F.struct(*[F.col(f.upper()).try_cast("double").alias(f) for f in SCORE_FIELDS]).alias("external_scores")
    )
    empty_b, empty_h = F.array().cast(f"array<{record_type(bureau)}>"), F.array().cast(f"array<{month_type(balance)}>")
    return (
        wanted.withColumnRenamed("customer", KEY)
        .join(nested, KEY, "left")
        .join(found, KEY, "left")
        .select(
            F.col("key").alias("sk_id_curr"),
            F.coalesce("PART", F.lit(0)).alias("part"),
            F.coalesce("parts", F.lit(1)).cast("int").alias("parts"),
            F.coalesce("bureau", empty_b).alias("bureau"),
            F.coalesce("bureau_balance", empty_h).alias("bureau_balance"),
            "external_scores",
            now().alias("ts"),
        )
    )


def record_type(bureau: DataFrame) -> str:
    return bureau.select(_record(BUREAU_FIELDS).alias("r")).schema["r"].dataType.simpleString()


def month_type(balance: DataFrame) -> str:
    return balance.select(_record(BALANCE_FIELDS).alias("r")).schema["r"].dataType.simpleString()


def enrich_warehouse(keys: DataFrame, marts: list[DataFrame]) -> DataFrame:
    """Every mart column for every key, lower-cased, NULL where a mart has no row.
    Marts hold one row per customer, so the joins cannot multiply keys."""
    out = numeric_keys(keys).withColumnRenamed("customer", KEY)
    names: list[str] = []
    for mart in marts:
        columns = [c for c in mart.columns if c.lower() != KEY.lower()]
        out = out.join(mart, KEY, "left")
        names += columns
    return out.select(F.col("key").alias("sk_id_curr"), now().alias("ts"), *[F.col(c).alias(c.lower()) for c in names])


def cut_to(keys: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of a raw table that belong to the customers in ``keys``: what a mart of these
    customers alone is made of."""
    wanted = numeric_keys(keys).select(F.col("customer").alias(KEY)).distinct()
    return table.join(wanted, KEY, "left_semi")


def flatten_to_schema(df: DataFrame, expected: list[str]) -> DataFrame:
    """Exactly the ``expected`` columns in order: matched without regard to case,
    emitted in lower case, NULL when absent, extra columns dropped."""
    by_name = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(by_name[n.lower()]) if n.lower() in by_name else F.lit(None).cast("string")).alias(n.lower())
            for n in expected
        ]
    )
