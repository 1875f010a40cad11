"""Credit-card features: one aggregate per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.numeric import col, ratio, share, stats
from riskloom.operators.skew import aggregate_with_distinct

KEY = "SK_ID_CURR"


def card_features(cards: DataFrame) -> DataFrame:
    """The 44 card features, one row per customer."""
    balance, limit = col("AMT_BALANCE"), col("AMT_CREDIT_LIMIT_ACTUAL")
    paid, minimum = col("AMT_PAYMENT_CURRENT"), col("AMT_INST_MIN_REGULARITY")
    dpd, drawn = col("SK_DPD"), col("AMT_DRAWINGS_CURRENT")
    used = ratio(balance, limit)
    over = {level: (limit > 0) & (used > level) for level in (0.8, 1.0)}
    plain = [
        F.count(F.lit(1)).alias("CC_MONTHS_COUNT"),
        *stats("CC_UTILIZATION", used, "MEAN", "MAX", "STD"),
        F.count_if(over[0.8]).alias("CC_HIGH_UTIL_MONTHS"),
        F.count_if(over[1.0]).alias("CC_OVER_LIMIT_MONTHS"),
        share(over[0.8]).alias("CC_HIGH_UTIL_RATIO"),
        *stats("CC_PAYMENT_RATIO", ratio(paid, balance), "MEAN", "MIN"),
        F.avg(ratio(paid, minimum)).alias("CC_MIN_PAYMENT_RATIO"),
        F.count_if(paid < minimum).alias("CC_UNDERPAY_MONTHS"),
        share(paid < minimum).alias("CC_UNDERPAY_RATIO"),
        F.count_if(paid == 0).alias("CC_NO_PAYMENT_MONTHS"),
        share(paid == 0).alias("CC_NO_PAYMENT_RATIO"),
        *stats("CC_DPD", dpd, "TOTAL", "MEAN", "MAX"),
        F.count_if(dpd > 0).alias("CC_DPD_MONTHS"),
        F.count_if(dpd.between(1, 30)).alias("CC_DPD_1_30_MONTHS"),
        F.count_if(dpd.between(31, 60)).alias("CC_DPD_31_60_MONTHS"),
        F.count_if(dpd > 60).alias("CC_DPD_60PLUS_MONTHS"),
        share(dpd > 0).alias("CC_DPD_RATIO"),
        share(dpd > 60).alias("CC_SEVERE_DPD_RATIO"),
        F.sum(drawn).alias("CC_TOTAL_DRAWINGS"),
        *stats("CC_DRAWINGS", drawn, "MEAN", "STD"),
        *[F.sum(f"AMT_DRAWINGS_{k}_CURRENT").alias(f"CC_{k}_TOTAL") for k in ("ATM", "POS", "OTHER")],
        *[
            ratio(F.sum(f"AMT_DRAWINGS_{k}_CURRENT"), F.sum(drawn)).alias(f"CC_{k}_RATIO")
            for k in ("ATM", "POS")
        ],
        F.avg("CNT_DRAWINGS_CURRENT").alias("CC_TXN_FREQ_MEAN"),
        *[F.sum(f"CNT_DRAWINGS_{k}_CURRENT").alias(f"CC_{k}_TXN_COUNT") for k in ("ATM", "POS")],
        F.min("MONTHS_BALANCE").alias("CC_EARLIEST_MONTH"),
        F.max("MONTHS_BALANCE").alias("CC_LATEST_MONTH"),
        F.count_if(drawn == 0).alias("CC_INACTIVE_MONTHS"),
        share(drawn == 0).alias("CC_INACTIVE_RATIO"),
        *stats("CC_LIMIT", limit, "MEAN", "MAX"),
        *stats("CC_BALANCE", balance, "MEAN", "MAX"),
        ratio(F.max(balance), F.max(limit)).alias("CC_MAX_UTIL_EVER"),
    ]
    return aggregate_with_distinct(cards, KEY, plain, {"CC_CARDS_COUNT": "SK_ID_PREV"})


def numeric_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    return [
        f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, T.NumericType)
    ]


def numeric_averages(df: DataFrame, key: str, prefix: str = "cc_avg_") -> DataFrame:
    """Average of every numeric column per key; only the distinct keys if there are
    none."""
    found = numeric_columns(df, [key])
    if not found:
        return df.select(key).distinct()
    return df.groupBy(key).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in found])
