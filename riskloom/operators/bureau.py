"""Credit-bureau features: two-level aggregation to one row per customer.

The raw balance history is collapsed to one row per bureau record before it is
joined, so both join sides are unique on SK_ID_BUREAU and a hot key cannot
multiply. All 53 features then come from a single aggregate per customer, over
records that move to their customer once.

Two dialects exist because the batch mart and the stream job define a few
features differently: ``batch`` follows SQL NULL rules, ``stream`` counts absent
amounts as zero and divides by the number of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import col, flag, ratio, share, stats, sum_when, to_double, to_long
from riskloom.operators.skew import aggregate_with_distinct

KEY = "SK_ID_CURR"
RECORD = "SK_ID_BUREAU"

# Status code for on-time, and the codes that mean days past due.
ON_TIME = "0"
DPD_BANDS = {"1": "1_30", "2": "31_60", "3": "61_90", "4": "91_120", "5": "120_PLUS"}
SEVERE = "5"

_LONGS = ["CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG"]
_DOUBLES = [
    "AMT_CREDIT_SUM_OVERDUE",
    "AMT_CREDIT_MAX_OVERDUE",
    "AMT_CREDIT_SUM_DEBT",
    "AMT_CREDIT_SUM_LIMIT",
    "AMT_CREDIT_SUM",
]
# Stream dialect: an absent amount counts as zero (the "ever" maximum excepted).
_ZERO_WHEN_ABSENT = [c for c in _DOUBLES if c != "AMT_CREDIT_MAX_OVERDUE"]


def bureau_base(bureau: DataFrame, dialect: str = "batch") -> DataFrame:
    typed = {c: to_long(c) for c in _LONGS} | {c: to_double(c) for c in _DOUBLES}
    if dialect == "stream":
        typed |= {c: F.coalesce(typed[c], F.lit(0.0)) for c in _ZERO_WHEN_ABSENT}
    return bureau.select(KEY, RECORD, "CREDIT_TYPE", "CREDIT_ACTIVE", *[e.alias(c) for c, e in typed.items()])


def balance_per_record(balance: DataFrame, dialect: str = "batch") -> DataFrame:
    """Month counts by status, ratios and flags for each bureau record."""
    status = F.upper("STATUS") if dialect == "stream" else F.col("STATUS")
    past_due = status.isin(*DPD_BANDS)
    return balance.groupBy(RECORD).agg(
        F.count(F.lit(1)).alias("TOTAL_MONTHS_OBSERVED"),
        F.count_if(status == ON_TIME).alias("MONTHS_ON_TIME"),
        F.count_if(status == "C").alias("MONTHS_CLOSED"),
        F.count_if(status == "X").alias("MONTHS_UNKNOWN"),
        *[F.count_if(status == code).alias(f"MONTHS_DPD_{band}") for code, band in DPD_BANDS.items()],
        F.min(to_long("MONTHS_BALANCE")).alias("EARLIEST_MONTH"),
        F.max(to_long("MONTHS_BALANCE")).alias("LATEST_MONTH"),
        F.count_if(past_due).alias("TOTAL_DPD_MONTHS"),
        share(past_due).alias("DPD_RATIO"),
        share(status == SEVERE).alias("SEVERE_DPD_RATIO"),
        flag(F.count_if(status == SEVERE) > 0).alias("HAS_SEVERE_DPD"),
        flag(F.count_if(past_due) > 0).alias("HAS_ANY_DPD"),
        share(status == ON_TIME).alias("ON_TIME_RATIO"),
        share(status == "X").alias("UNKNOWN_RATIO"),
    )


TYPES = "BUREAU_CREDIT_TYPES_COUNT"


def _risk(dialect: str) -> list[Column]:
    status = F.col("CREDIT_ACTIVE")
    n = F.count(F.lit(1))

    def level(prefix: str, value: str) -> list[Column]:
        if dialect == "batch":
            return stats(prefix, value, "TOTAL", "MEAN", "MAX")
        total = F.coalesce(F.sum(value), F.lit(0).cast("double" if value in _DOUBLES else "bigint"))
        return [total.alias(f"{prefix}_TOTAL"), ratio(total, n).alias(f"{prefix}_MEAN"), F.max(value).alias(f"{prefix}_MAX")]

    def positive(prefix: str, value: str) -> list[Column]:
        return [F.count_if(col(value) > 0).alias(f"{prefix}_COUNT"), share(col(value) > 0).alias(f"{prefix}_RATIO")]

    return [
        n.alias("BUREAU_TOTAL_COUNT"),
        *[
            F.count_if(status == value).alias(f"BUREAU_{value.upper().replace(' ', '_')}_COUNT")
            for value in ("Active", "Closed", "Bad debt", "Sold")
        ],
        share(status == "Bad debt").alias("BUREAU_BAD_DEBT_RATIO"),
        share(status == "Sold").alias("BUREAU_SOLD_RATIO"),
        share(status.isin("Bad debt", "Sold")).alias("BUREAU_HIGH_RISK_RATIO"),
        *level("BUREAU_OVERDUE_DAYS", "CREDIT_DAY_OVERDUE"),
        *positive("BUREAU_OVERDUE", "CREDIT_DAY_OVERDUE"),
        *level("BUREAU_AMT_OVERDUE", "AMT_CREDIT_SUM_OVERDUE"),
        F.max("AMT_CREDIT_MAX_OVERDUE").alias("BUREAU_AMT_MAX_OVERDUE_EVER"),
        *positive("BUREAU_AMT_OVERDUE", "AMT_CREDIT_SUM_OVERDUE"),
        *level("BUREAU_PROLONG", "CNT_CREDIT_PROLONG"),
        *positive("BUREAU_PROLONG", "CNT_CREDIT_PROLONG"),
    ]


def _advanced(dialect: str) -> list[Column]:
    debt, limit = F.col("AMT_CREDIT_SUM_DEBT"), F.col("AMT_CREDIT_SUM_LIMIT")
    active = F.col("CREDIT_ACTIVE") == "Active"
    usable = limit > 0 if dialect == "stream" else F.lit(True)
    maxed_out = usable & (debt >= limit)
    high_util = usable & (debt > limit * 0.8)

    def active_sum(value: str) -> Column:
        total = sum_when(active, value)
        return F.coalesce(total, F.lit(0.0)) if dialect == "stream" else total

    return [
        ratio(F.sum(debt), F.sum(limit)).alias("BUREAU_CREDIT_UTILIZATION_RATIO"),
        ratio(F.sum(debt), F.sum("AMT_CREDIT_SUM")).alias("BUREAU_DEBT_TO_CREDIT_RATIO"),
        ratio(F.sum("AMT_CREDIT_SUM_OVERDUE"), F.sum("AMT_CREDIT_SUM")).alias("BUREAU_OVERDUE_TO_CREDIT_RATIO"),
        active_sum("AMT_CREDIT_SUM").alias("BUREAU_ACTIVE_CREDIT_SUM"),
        active_sum("AMT_CREDIT_SUM_DEBT").alias("BUREAU_ACTIVE_DEBT_SUM"),
        active_sum("AMT_CREDIT_SUM_OVERDUE").alias("BUREAU_ACTIVE_OVERDUE_SUM"),
        ratio(active_sum("AMT_CREDIT_SUM_DEBT"), active_sum("AMT_CREDIT_SUM_LIMIT")).alias(
            "BUREAU_ACTIVE_UTILIZATION_RATIO"
        ),
        F.count_if(maxed_out).alias("BUREAU_MAXED_OUT_COUNT"),
        share(maxed_out).alias("BUREAU_MAXED_OUT_RATIO"),
        F.count_if(high_util).alias("BUREAU_HIGH_UTIL_COUNT"),
        share(high_util).alias("BUREAU_HIGH_UTIL_RATIO"),
    ]


def _history(dialect: str) -> list[Column]:
    """Roll-up of the per-record balance columns to the customer."""
    stream = dialect == "stream"

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)) if stream else F.sum(name)

    months, on_time = total("TOTAL_MONTHS_OBSERVED"), total("MONTHS_ON_TIME")
    past_due, severe = total("TOTAL_DPD_MONTHS"), total(f"MONTHS_DPD_{DPD_BANDS[SEVERE]}")
    # The batch mart counts every bureau record, the stream job only those with history.
    with_balance = F.count("TOTAL_MONTHS_OBSERVED") if stream else F.count(RECORD)
    return [
        with_balance.alias("BUREAU_WITH_BALANCE_COUNT"),
        months.alias("TOTAL_MONTHS_ALL_BUREAUS"),
        on_time.alias("TOTAL_MONTHS_ON_TIME"),
        past_due.alias("TOTAL_DPD_ALL_BUREAUS"),
        severe.alias("TOTAL_SEVERE_DPD_MONTHS"),
        F.max("DPD_RATIO").alias("WORST_DPD_RATIO"),
        F.max("SEVERE_DPD_RATIO").alias("WORST_SEVERE_DPD_RATIO"),
        F.min("ON_TIME_RATIO").alias("WORST_ON_TIME_RATIO"),
        F.avg("DPD_RATIO").alias("AVG_DPD_RATIO"),
        F.avg("ON_TIME_RATIO").alias("AVG_ON_TIME_RATIO"),
        total("HAS_SEVERE_DPD").alias("COUNT_BUREAUS_WITH_SEVERE_DPD"),
        total("HAS_ANY_DPD").alias("COUNT_BUREAUS_WITH_ANY_DPD"),
        ratio(on_time, months).alias("OVERALL_ON_TIME_RATIO"),
        ratio(past_due, months).alias("OVERALL_DPD_RATIO"),
        ratio(severe, months).alias("OVERALL_SEVERE_DPD_RATIO"),
        flag(total("HAS_SEVERE_DPD") > 0).alias("CLIENT_HAS_SEVERE_DPD_HISTORY"),
        flag(total("HAS_ANY_DPD") > 0).alias("CLIENT_HAS_ANY_DPD_HISTORY"),
    ]


def _with_history(base: DataFrame, balance: DataFrame, dialect: str = "batch") -> DataFrame:
    return base.join(balance_per_record(balance, dialect), RECORD, "left")


def _with_types(rows: DataFrame, plain: list[Column], dialect: str = "batch") -> DataFrame:
    """``plain`` aggregates per customer with the number of credit types behind the first of them."""
    absent = F.max(F.col("CREDIT_TYPE").isNull().cast("int")).alias("_ABSENT")
    out = aggregate_with_distinct(rows, KEY, [*plain, absent], {TYPES: "CREDIT_TYPE"})
    if dialect == "stream":  # an absent type is a type of its own there
        out = out.withColumn(TYPES, F.col(TYPES) + F.col("_ABSENT"))
    names = out.drop(TYPES, "_ABSENT").columns
    return out.select(*names[:2], TYPES, *names[2:])


def bureau_risk(bureau: DataFrame) -> DataFrame:
    return _with_types(bureau_base(bureau), _risk("batch"))


def bureau_advanced(bureau: DataFrame) -> DataFrame:
    return bureau_base(bureau).groupBy(KEY).agg(*_advanced("batch"))


def bureau_balance_client(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    return _with_history(bureau.select(KEY, RECORD), balance).groupBy(KEY).agg(*_history("batch"))


def bureau_features(bureau: DataFrame, balance: DataFrame, dialect: str = "batch") -> DataFrame:
    """The 53 bureau features, one row per customer with bureau records."""
    joined = _with_history(bureau_base(bureau, dialect), balance, dialect)
    return _with_types(joined, [*_risk(dialect), *_advanced(dialect), *_history(dialect)], dialect)
