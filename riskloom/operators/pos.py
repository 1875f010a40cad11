"""Point-of-sale history: month rows -> loans -> customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import col, flag, ratio, share, stats

KEY = "SK_ID_CURR"
LOAN = "SK_ID_PREV"

# Contract statuses and day thresholds that are counted.
STATUSES = ["Active", "Completed", "Demand"]
DPD_LIMITS = {"POSITIVE": 0, "7PLUS": 7, "30PLUS": 30}


def pos_loan_level(pos: DataFrame) -> DataFrame:
    """One row per loan. Everything is a conditional count in one aggregate: a loan
    id belongs to one customer, so counting per loan needs no second pass."""
    dpd, status = F.col("SK_DPD"), F.col("NAME_CONTRACT_STATUS")
    longest, left = F.max("CNT_INSTALMENT"), F.min("CNT_INSTALMENT_FUTURE")
    ever_demand = flag(F.count_if(status == "Demand") > 0)
    return pos.groupBy(LOAN, KEY).agg(
        F.count(F.lit(1)).alias("TOTAL_MONTHS_OBSERVED"),
        F.max(dpd).alias("MAX_DPD"),
        F.avg(dpd).alias("MEAN_DPD"),
        F.max("SK_DPD_DEF").alias("MAX_DPD_DEF"),
        longest.alias("MAX_CNT_INSTALMENT"),
        left.alias("MIN_CNT_INSTALMENT_FUTURE"),
        F.min("MONTHS_BALANCE").alias("EARLIEST_MONTH"),
        F.max("MONTHS_BALANCE").alias("LATEST_MONTH"),
        *[F.count_if(dpd > days).alias(f"MONTHS_DPD_{name}") for name, days in DPD_LIMITS.items()],
        *[F.count_if(status == s).alias(f"MONTHS_{s.upper()}") for s in STATUSES],
        F.when(longest > 0, F.lit(1.0) - ratio(left, longest))
        .otherwise(F.lit(0.0))
        .alias("REPAYMENT_PROGRESS_RATIO"),
        *[
            share(dpd > days).alias("DPD_RATE" if name == "POSITIVE" else f"DPD_{name}_RATE")
            for name, days in DPD_LIMITS.items()
        ],
        *[share(status == s).alias(f"{s.upper()}_RATE") for s in STATUSES],
        ever_demand.alias("EVER_DEMAND"),
        flag(F.max(dpd) > 30).alias("SEVERE_DPD_FLAG"),
        ever_demand.alias("IS_PROBLEM_LOAN"),
    )


def risk_segment(max_dpd: Column, any_demand: Column, mean_rate: Column) -> Column:
    return (
        F.when(max_dpd > 90, "HIGH_RISK")
        .when((any_demand == 1) | (max_dpd > 30), "MEDIUM_RISK")
        .when(mean_rate > 0.05, "LOW_MEDIUM_RISK")
        .otherwise("LOW_RISK")
    )


def pos_customer_level(loans: DataFrame) -> DataFrame:
    grouped = loans.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("POS_COUNT_LOANS_TOTAL"),
        F.sum("IS_PROBLEM_LOAN").alias("POS_COUNT_PROBLEM_LOANS"),
        F.sum("EVER_DEMAND").alias("POS_COUNT_LOANS_DEMAND"),
        *[s(F.col("MAX_DPD")).alias(f"POS_{n}_MAX_DPD") for n, s in (("MEAN", F.avg), ("MAX", F.max), ("MIN", F.min))],
        F.avg("MEAN_DPD").alias("POS_MEAN_MEAN_DPD"),
        *[
            s(F.col(c)).alias(f"POS_{n}_{c}")
            for c in ("DPD_RATE", "DPD_7PLUS_RATE", "DPD_30PLUS_RATE")
            for n, s in (("MEAN", F.avg), ("MAX", F.max))
        ],
        *[
            s(F.col(c)).alias(f"POS_{n}_{name}")
            for c, name in (
                ("REPAYMENT_PROGRESS_RATIO", "REPAYMENT_PROGRESS"),
                ("MAX_CNT_INSTALMENT", "CONTRACT_LENGTH"),
            )
            for n, s in (("MEAN", F.avg), ("MAX", F.max), ("MIN", F.min))
        ],
        *[F.avg(f"{s}_RATE").alias(f"POS_MEAN_{s}_RATE") for s in ("COMPLETED", "ACTIVE", "DEMAND")],
        F.max("EVER_DEMAND").alias("POS_FLAG_ANY_DEMAND"),
        F.max("SEVERE_DPD_FLAG").alias("POS_FLAG_ANY_SEVERE_DPD"),
        F.sum("TOTAL_MONTHS_OBSERVED").alias("POS_TOTAL_MONTHS_OBSERVED"),
        F.min("EARLIEST_MONTH").alias("POS_EARLIEST_MONTH"),
        F.max("LATEST_MONTH").alias("POS_LATEST_MONTH"),
    )
    total = col("POS_COUNT_LOANS_TOTAL")
    return grouped.withColumns(
        {
            "POS_RATIO_PROBLEM_LOANS": ratio("POS_COUNT_PROBLEM_LOANS", total),
            "POS_RATIO_LOANS_DEMAND": ratio("POS_COUNT_LOANS_DEMAND", total),
            "POS_OBSERVATION_SPAN_MONTHS": col("POS_LATEST_MONTH") - col("POS_EARLIEST_MONTH"),
            "POS_RISK_SEGMENT": risk_segment(
                col("POS_MAX_MAX_DPD"), col("POS_FLAG_ANY_DEMAND"), col("POS_MEAN_DPD_RATE")
            ),
        }
    )


def pos_features(pos: DataFrame) -> DataFrame:
    """The 31 point-of-sale features, one row per customer."""
    return pos_customer_level(pos_loan_level(pos))
