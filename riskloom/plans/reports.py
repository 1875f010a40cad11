"""Registered queries: reports and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import reports
from riskloom.plans.marts import over
from riskloom.sources.domain import view


def _segments(application: DataFrame, bureau: DataFrame, previous: DataFrame) -> DataFrame:
    return reports.customer_segments(
        application.select("SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL"), bureau, previous
    )


def _timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole history of the customer with the most records."""
    pos = view(spark, sf_dir, "pos_cash_balance")
    per_customer = pos.groupBy("SK_ID_CURR").count()
    busiest = per_customer.agg(F.max(F.struct("count", (-F.col("SK_ID_CURR")).alias("k"))).alias("m"))
    return reports.record_timeline(pos.where(F.col("SK_ID_CURR") == busiest.select(-F.col("m.k")).scalar()))


def _discipline_extremes(pos: DataFrame) -> DataFrame:
    best = reports.discipline_extremes(pos, worst=False).withColumn("side", F.lit("best"))
    return best.unionByName(reports.discipline_extremes(pos, worst=True).withColumn("side", F.lit("worst")))


def ext_scores_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """External scores of both populations, one row per customer. The train row wins
    when a customer is in both, so the result does not depend on row order."""
    columns = ["SK_ID_CURR", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    both = (
        train.select(*columns, F.lit(0).alias("origin"))
        .unionByName(test.select(*columns, F.lit(1).alias("origin")))
        .groupBy("SK_ID_CURR")
        .agg(F.min(F.struct("origin", *columns[1:])).alias("first"))
    )
    return both.select("SK_ID_CURR", *[f"first.{c}" for c in columns[1:]])


def _cube(application: DataFrame, bureau: DataFrame, previous: DataFrame) -> DataFrame:
    keys = ["IS_CREDIT_VIRGIN", "CUSTOMER_RISK_SEGMENT"]
    return reports.default_rate_cube(_segments(application, bureau, previous), keys)


QUERIES = {
    "record_timeline": _timeline,
    "status_recent_vs_older": over("pos_cash_balance")(lambda p: reports.status_recent_vs_older(p, -30, -60)),
    "key_overlap": over("bureau_balance", "bureau")(lambda a, b: reports.key_overlap(a, b, "SK_ID_BUREAU")),
    "customer_segments": over("application_train", "bureau", "previous_application")(_segments),
    "segment_default_rate": over("application_train", "bureau", "previous_application")(_cube),
    "payment_discipline": over("pos_cash_balance")(reports.payment_discipline),
    "discipline_extremes": over("pos_cash_balance")(_discipline_extremes),
    "loan_terms": over("pos_cash_balance")(reports.loan_term_distribution),
    "top_terms": over("pos_cash_balance")(reports.top_terms),
    "months_distribution": over("pos_cash_balance")(reports.months_distribution),
    "status_distribution": over("pos_cash_balance")(reports.status_distribution),
    "dpd_histogram": over("pos_cash_balance")(reports.dpd_histogram),
    "status_patterns": over("bureau")(reports.status_patterns),
    "card_profile": over("credit_card_balance")(reports.card_profile),
    "column_profile": over("bureau")(
        lambda b: reports.column_profile(b, ["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "DAYS_CREDIT"])
    ),
    "amount_profile": over("previous_application")(reports.amount_profile),
    "value_counts": over("bureau")(lambda b: reports.value_counts(b, "CREDIT_TYPE")),
    "rejection_reasons": over("previous_application")(reports.rejection_reasons),
    "client_type_approval": over("previous_application")(reports.client_type_approval),
    "ext_scores_union": over("application_train", "application_test")(ext_scores_union),
}
