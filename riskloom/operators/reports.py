"""Profiles, distributions, segments and flow reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import col, ratio, share
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.skew import dealt

KEY = "SK_ID_CURR"


def record_timeline(df: DataFrame, sk_id_curr: int | None = None, sk_id_prev: int | None = None) -> DataFrame:
    """Records of one customer and/or loan, newest month first."""
    for name, value in (("SK_ID_CURR", sk_id_curr), ("SK_ID_PREV", sk_id_prev)):
        if value is not None:
            df = df.where(col(name) == value)
    return df.orderBy(F.col("MONTHS_BALANCE").desc())


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), F.col(column))


def loan_terms(pos: DataFrame, per_task: int = 250_000) -> DataFrame:
    """Each (loan, instalment count) once. Few rows repeat, so they are dealt by the loan before
    any is dropped: a task holds about ``per_task`` of them."""
    return dealt(pos.select("SK_ID_PREV", "CNT_INSTALMENT").dropna(), "SK_ID_PREV", per_task).distinct()


def term_category(instalments: Column) -> Column:
    return (
        F.when(instalments <= 12, "Short-term (≤12 months)")
        .when(instalments <= 24, "Medium-term (13-24 months)")
        .otherwise("Long-term (>24 months)")
    )


def loan_term_categories(pos: DataFrame) -> DataFrame:
    """Each (loan, instalment count) with its term category."""
    return loan_terms(pos).withColumn("loan_term_category", term_category(col("CNT_INSTALMENT")))


def loan_term_distribution(pos: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        loan_term_categories(pos)
        .groupBy("loan_term_category")
        .agg(
            n.alias("loan_count"),
            F.avg("CNT_INSTALMENT").alias("avg_installments"),
            F.min("CNT_INSTALMENT").alias("min_installments"),
            F.max("CNT_INSTALMENT").alias("max_installments"),
        )
        .orderBy(F.col("loan_count").desc(), "loan_term_category")
    )


def top_terms(pos: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most common instalment counts (a top-k report)."""
    return value_counts(loan_terms(pos), "CNT_INSTALMENT").limit(k)


def months_distribution(pos: DataFrame) -> DataFrame:
    return (
        pos.groupBy("MONTHS_BALANCE")
        .agg(F.count(F.lit(1)).alias("records"), F.count_distinct(KEY).alias("unique_customers"))
        .orderBy(F.col("MONTHS_BALANCE").desc())
    )


def status_distribution(pos: DataFrame) -> DataFrame:
    return (
        pos.groupBy("NAME_CONTRACT_STATUS")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("SK_DPD").alias("avg_dpd"), F.max("SK_DPD").alias("max_dpd"))
        .orderBy(F.col("count").desc(), "NAME_CONTRACT_STATUS")
    )


def dpd_histogram(pos: DataFrame) -> DataFrame:
    return pos.groupBy("SK_DPD").agg(F.count(F.lit(1)).alias("count")).orderBy("SK_DPD")


def status_recent_vs_older(pos: DataFrame, recent_from: int = -6, older_before: int = -24) -> DataFrame:
    """Status counts of recent and of old months side by side. One conditional
    aggregate replaces two filtered aggregates and their full outer join; statuses
    in neither period are left out as that join would, and a NULL status keeps one
    row per period because NULL keys never match."""
    month = F.col("MONTHS_BALANCE")
    recent, older = month >= recent_from, month < older_before
    tagged = pos.where(recent | older).withColumn(
        "_period", F.when(col("NAME_CONTRACT_STATUS").isNull(), recent.cast("int"))
    )
    return (
        tagged.groupBy("NAME_CONTRACT_STATUS", "_period")
        .agg(F.count_if(recent).alias("recent_count"), F.count_if(older).alias("older_count"))
        .drop("_period")
    )


def payment_discipline(pos: DataFrame) -> DataFrame:
    """Late-payment rate per customer and its band."""
    late = F.col("SK_DPD") > 0
    rate = F.col("late_payment_rate")
    return (
        pos.groupBy(KEY)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.max("SK_DPD").alias("max_dpd_ever"),
            F.avg("SK_DPD").alias("avg_dpd"),
            F.count_if(late).alias("late_payments"),
            share(late).alias("late_payment_rate"),
        )
        .withColumn(
            "discipline",
            F.when(rate == 0, "perfect")
            .when(rate <= 0.1, "good")
            .when(rate <= 0.3, "fair")
            .when(rate <= 0.5, "poor")
            .otherwise("very poor"),
        )
    )


def discipline_extremes(pos: DataFrame, worst: bool, k: int = 5, at_least: int = 5) -> DataFrame:
    """The ``k`` most or least disciplined customers with enough records."""
    rated = payment_discipline(pos).where(F.col("total_records") >= at_least)
    keys = [F.col("late_payment_rate"), F.col("max_dpd_ever")]
    order = [c.desc() for c in keys] if worst else [c.asc() for c in keys]
    return rated.orderBy(*order, KEY).limit(k)


def bureau_client_counts(bureau: DataFrame) -> DataFrame:
    """Records, distinct statuses and distinct types (NULL is a type) per customer."""

    def kinds(c: str) -> Column:
        return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))

    return bureau.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("bureau_records_count"),
        kinds("CREDIT_ACTIVE").alias("unique_statuses"),
        kinds("CREDIT_TYPE").alias("unique_credit_types"),
    )


def status_patterns(bureau: DataFrame) -> DataFrame:
    return (
        bureau_client_counts(bureau)
        .groupBy("unique_statuses", "unique_credit_types")
        .agg(F.count(F.lit(1)).alias("client_count"))
        .orderBy(F.col("client_count").desc(), "unique_statuses", "unique_credit_types")
    )


def card_profile(cards: DataFrame) -> DataFrame:
    """One row: balances, payments, utilisation, delinquency and spending."""
    balance, paid = col("AMT_BALANCE"), col("AMT_PAYMENT_CURRENT")
    dpd, drawn = col("SK_DPD"), col("AMT_DRAWINGS_CURRENT")
    used = ratio(balance, "AMT_CREDIT_LIMIT_ACTUAL")
    median = (
        exact_quantiles(cards.select(used.alias("used")), ["used"], [0.5]).select("q0").scalar()
    )
    return cards.agg(
        *[f(balance).alias(f"{n}_balance") for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))],
        *[f(paid).alias(f"{n}_payment") for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))],
        F.count_if(paid == 0).alias("zero_payment_months"),
        F.count_if(balance > paid).alias("underpayment_months"),
        *[f(used).alias(f"{n}_utilization") for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))],
        F.count_if(used > 0.8).alias("high_utilization_months"),
        F.count_if(used > 1.0).alias("over_limit_months"),
        F.avg(dpd).alias("avg_dpd"),
        F.max(dpd).alias("max_dpd"),
        F.count_if(dpd == 0).alias("on_time_months"),
        F.count_if(dpd.between(1, 30)).alias("dpd_1_30_months"),
        F.count_if(dpd.between(31, 60)).alias("dpd_31_60_months"),
        F.count_if(dpd > 60).alias("dpd_60plus_months"),
        F.count_if(dpd > 0).alias("any_dpd_months"),
        F.avg(drawn).alias("avg_monthly_spending"),
        F.avg("AMT_DRAWINGS_ATM_CURRENT").alias("avg_atm_withdrawals"),
        F.avg("AMT_DRAWINGS_POS_CURRENT").alias("avg_pos_purchases"),
        F.avg("CNT_DRAWINGS_CURRENT").alias("avg_transactions_per_month"),
        F.avg("CNT_DRAWINGS_ATM_CURRENT").alias("avg_atm_transactions"),
        F.count_if(drawn == 0).alias("inactive_months"),
    ).withColumn("median_utilization", median)


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: min, max, mean, median, std and zero/sign/NULL counts."""
    entry = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("double").alias("value")) for c in columns])
    )
    v = F.col("value")
    summary = df.select(entry.alias("e")).select("e.*").groupBy("column").agg(
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.count_if(v == 0).alias("zero_count"),
        F.count_if(v < 0).alias("negative_count"),
        F.count_if(v > 0).alias("positive_count"),
        F.count_if(v.isNull()).alias("null_count"),
    )
    middle = exact_quantiles(df, columns, [0.5]).select("column", F.col("q0").alias("median"))
    return summary.join(F.broadcast(middle), "column", "left")  # one row per column


def amount_profile(previous: DataFrame) -> DataFrame:
    """One row: requested against approved amounts."""
    asked, credit = col("AMT_APPLICATION"), col("AMT_CREDIT")
    middle = exact_quantiles(previous, ["AMT_APPLICATION", "AMT_CREDIT"], [0.5])
    medians = middle.agg(
        F.max(F.when(F.col("column") == "AMT_APPLICATION", F.col("q0"))).alias("requested"),
        F.max(F.when(F.col("column") == "AMT_CREDIT", F.col("q0"))).alias("approved"),
    ).select(F.struct("*")).scalar()
    return previous.agg(
        F.avg(asked).alias("avg_requested"),
        F.avg(credit).alias("avg_approved"),
        F.avg(ratio(credit, asked)).alias("avg_approval_ratio"),
        F.count_if(credit > asked).alias("over_approved_count"),
        F.count_if(credit < asked).alias("under_approved_count"),
    ).withColumns({"median_requested": medians["requested"], "median_approved": medians["approved"]})


def rejection_reasons(previous: DataFrame) -> DataFrame:
    return value_counts(previous.where("NAME_CONTRACT_STATUS != 'Approved'"), "CODE_REJECT_REASON")


def client_type_approval(previous: DataFrame) -> DataFrame:
    approved = col("NAME_CONTRACT_STATUS") == "Approved"
    return previous.groupBy("NAME_CLIENT_TYPE").agg(
        F.count(F.lit(1)).alias("application_count"),
        F.count_if(approved).alias("approved_count"),
        F.avg(approved.cast("int")).alias("approval_rate"),
    )


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys of ``left`` also occur in ``right``, in one pass: both
    key sets are unioned, marked by side and reduced per key."""
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = sides.where(col(key).isNotNull()).groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    both = (F.col("l") == 1) & (F.col("r") == 1)
    return per_key.agg(
        F.count_if(F.col("l") == 1).alias("left_keys"),
        F.count_if(F.col("r") == 1).alias("right_keys"),
        F.count_if(both).alias("common_keys"),
        ratio(F.count_if(both), F.count_if(F.col("l") == 1)).alias("coverage"),
    )


def customer_segments(application: DataFrame, bureau: DataFrame, previous: DataFrame) -> DataFrame:
    """Applications with history statistics, first-time flags and a risk segment."""
    status, active = col("NAME_CONTRACT_STATUS"), col("CREDIT_ACTIVE")
    history = previous.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("PREV_APP_COUNT"),
        F.count_if(status == "Approved").alias("PREV_APP_APPROVED"),
        F.count_if(status == "Refused").alias("PREV_APP_REFUSED"),
        F.avg("AMT_APPLICATION").alias("PREV_APP_AMT_MEAN"),
        F.avg("AMT_CREDIT").alias("PREV_APP_CREDIT_MEAN"),
    )
    external = bureau.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("BUREAU_COUNT"),
        F.count_if(active == "Active").alias("BUREAU_ACTIVE_COUNT"),
        F.count_if(active == "Closed").alias("BUREAU_CLOSED_COUNT"),
        F.min("DAYS_CREDIT").alias("DAYS_FIRST_CREDIT"),
        F.sum("AMT_CREDIT_SUM").alias("BUREAU_TOTAL_DEBT"),
        F.sum("AMT_CREDIT_SUM_OVERDUE").alias("BUREAU_TOTAL_OVERDUE"),
    )
    filled = (
        application.join(history, KEY, "left")
        .join(external, KEY, "left")
        .fillna(0, subset=[c for c in history.columns + external.columns if c != KEY])
    )
    new, virgin = col("PREV_APP_COUNT") == 0, col("BUREAU_COUNT") == 0
    approval = F.coalesce(ratio("PREV_APP_APPROVED", "PREV_APP_COUNT"), F.lit(0.0))
    return filled.withColumns(
        {
            "IS_FIRST_TIME_CUSTOMER": new.cast("int"),
            "IS_CREDIT_VIRGIN": virgin.cast("int"),
            "PREV_APPROVAL_SHARE": approval,
            "MONTHS_CREDIT_HISTORY": F.when(
                col("DAYS_FIRST_CREDIT") < 0, -col("DAYS_FIRST_CREDIT") / F.lit(30.44)
            ).otherwise(0.0),
            "EXTERNAL_DEBT_INCOME_RATIO": F.when(
                col("AMT_INCOME_TOTAL") > 0, ratio("BUREAU_TOTAL_DEBT", "AMT_INCOME_TOTAL")
            ).otherwise(0.0),
            "CUSTOMER_RISK_SEGMENT": F.when(virgin & new, "HIGH_RISK_NEW_TO_CREDIT")
            .when(~virgin & new, "MEDIUM_RISK_NEW_TO_LENDER")
            .when(~virgin & ~new & (approval > 0.5), "LOW_RISK_REPEAT_APPROVED")
            .when(~virgin & ~new & (approval <= 0.5), "MEDIUM_RISK_REPEAT_REJECTED")
            .otherwise("UNKNOWN_RISK"),
        }
    )


def default_rate_by(df: DataFrame, keys: list[str], target: str = "TARGET") -> DataFrame:
    """Customers and default rate for each combination of ``keys``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.avg(target).alias("default_rate"))


def default_rate_cube(df: DataFrame, keys: list[str], target: str = "TARGET") -> DataFrame:
    """All single- and multi-key combinations in one pass; ``grouping`` tells them
    apart (bits set for the keys rolled up)."""
    return df.cube(*keys).agg(
        F.grouping_id().alias("grouping"), F.count(F.lit(1)).alias("count"), F.avg(target).alias("default_rate")
    )
