"""Previous-application features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import col, ratio, share, stats, to_double, to_long
from riskloom.operators.skew import aggregate_with_distinct

KEY = "SK_ID_CURR"
LOAN = "SK_ID_PREV"

_DOUBLES = [
    "AMT_APPLICATION",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_DOWN_PAYMENT",
    "RATE_DOWN_PAYMENT",
    "RATE_INTEREST_PRIMARY",
    "DAYS_DECISION",
    "CNT_PAYMENT",
    "AMT_GOODS_PRICE",
    "NFLAG_INSURED_ON_APPROVAL",
]
_TEXTS = [
    "NAME_CONTRACT_STATUS",
    "NAME_CONTRACT_TYPE",
    "NAME_PORTFOLIO",
    "NAME_CLIENT_TYPE",
    "NAME_PAYMENT_TYPE",
    "CHANNEL_TYPE",
    "NAME_GOODS_CATEGORY",
    "NAME_CASH_LOAN_PURPOSE",
    "NAME_YIELD_GROUP",
    "CODE_REJECT_REASON",
]


def previous_base(previous: DataFrame) -> DataFrame:
    return previous.select(
        KEY,
        LOAN,
        *[to_double(c).alias(c) for c in _DOUBLES],
        to_long("NFLAG_LAST_APPL_IN_DAY").alias("NFLAG_LAST_APPL_IN_DAY"),
        *_TEXTS,
    )


def previous_features(previous: DataFrame) -> DataFrame:
    """The 80 previous-application features, one row per customer."""
    status, kind, portfolio = col("NAME_CONTRACT_STATUS"), col("NAME_CONTRACT_TYPE"), col("NAME_PORTFOLIO")
    asked, credit, decided = col("AMT_APPLICATION"), col("AMT_CREDIT"), col("DAYS_DECISION")
    down = col("AMT_DOWN_PAYMENT")
    approved = status == "Approved"

    def counts(source: Column, names: dict[str, str]) -> list[Column]:
        return [F.count_if(source == value).alias(f"PREV_{name}_COUNT") for name, value in names.items()]

    def share_of(name: str, condition: Column) -> Column:
        return share(condition).alias(f"PREV_{name}")

    distinct = {
        "PREV_UNIQUE_APP_COUNT": LOAN,
        "PREV_PORTFOLIO_DIVERSITY": "NAME_PORTFOLIO",
        "PREV_CHANNEL_DIVERSITY": "CHANNEL_TYPE",
        "PREV_PAYMENT_TYPE_DIVERSITY": "NAME_PAYMENT_TYPE",
        "PREV_GOODS_DIVERSITY": "NAME_GOODS_CATEGORY",
        "PREV_PURPOSE_DIVERSITY": "NAME_CASH_LOAN_PURPOSE",
    }
    plain = [
        F.count(F.lit(1)).alias("PREV_APP_COUNT"),
        *counts(status, {"APPROVED": "Approved", "REFUSED": "Refused", "CANCELED": "Canceled"}),
        share_of("APPROVAL_RATE", approved),
        share_of("REFUSAL_RATE", status == "Refused"),
        share_of("CANCEL_RATE", status == "Canceled"),
        *stats("PREV_AMT_APPLICATION", asked, "TOTAL", "MEAN", "MAX", "STD"),
        *stats("PREV_AMT_CREDIT", credit, "TOTAL", "MEAN", "MAX", "STD"),
        *stats("PREV_CREDIT_TO_APP_RATIO", ratio(credit, asked), "MEAN", "MIN", "MAX", "STD"),
        F.count_if(credit > asked).alias("PREV_OVER_APPROVED_COUNT"),
        F.count_if(credit < asked).alias("PREV_UNDER_APPROVED_COUNT"),
        share_of("OVER_APPROVAL_RATIO", credit > asked),
        *stats("PREV_ANNUITY", "AMT_ANNUITY", "MEAN", "MAX", "STD"),
        F.avg(ratio("AMT_ANNUITY", credit)).alias("PREV_ANNUITY_TO_CREDIT_RATIO"),
        *stats("PREV_DOWN_PAYMENT", down, "TOTAL", "MEAN", "MAX"),
        F.count_if(down > 0).alias("PREV_WITH_DOWN_PAYMENT_COUNT"),
        share_of("DOWN_PAYMENT_RATIO", down > 0),
        F.avg("RATE_DOWN_PAYMENT").alias("PREV_DOWN_PAYMENT_RATE_MEAN"),
        *stats("PREV_INTEREST_RATE", "RATE_INTEREST_PRIMARY", "MEAN", "MAX", "MIN", "STD"),
        *stats("PREV_DAYS_DECISION", decided, "MEAN", "MIN", "MAX", "STD"),
        *[
            F.count_if(decided > -days).alias(f"PREV_APPS_LAST_{name}")
            for name, days in {"30D": 30, "90D": 90, "1Y": 365, "2Y": 730}.items()
        ],
        *[
            F.count_if((decided > -days) & approved).alias(f"PREV_RECENT_APPROVED_{name}")
            for name, days in {"1Y": 365, "90D": 90}.items()
        ],
        *counts(kind, {f"{n.upper()}_LOAN": f"{n} loans" for n in ("Cash", "Consumer", "Revolving")}),
        share_of("CASH_LOAN_RATIO", kind == "Cash loans"),
        *counts(portfolio, {f"{n.upper()}_PORTFOLIO": n for n in ("Cash", "POS", "Cards")}),
        share_of("CASH_PORTFOLIO_RATIO", portfolio == "Cash"),
        *counts(col("NAME_CLIENT_TYPE"), {"REPEATER_APP": "Repeater", "NEW_CLIENT_APP": "New"}),
        share_of("REPEATER_RATIO", col("NAME_CLIENT_TYPE") == "Repeater"),
        *counts(col("NAME_PAYMENT_TYPE"), {"BANK_PAYMENT": "Cash through the bank"}),
        F.count_if(col("NFLAG_LAST_APPL_IN_DAY") == 0).alias("PREV_MULTIPLE_SAME_DAY_COUNT"),
        F.avg("NFLAG_INSURED_ON_APPROVAL").alias("PREV_INSURANCE_RATIO"),
        *counts(
            col("NAME_YIELD_GROUP"), {"HIGH_YIELD": "high", "LOW_ACTION": "low_action", "MIDDLE_YIELD": "middle"}
        ),
        *counts(col("CODE_REJECT_REASON"), {f"{n}_REJECT": n for n in ("HC", "LIMIT", "SCO", "CLIENT")}),
        *stats("PREV_PAYMENT_TERMS", "CNT_PAYMENT", "MEAN", "MAX", "MIN", "STD"),
        *stats("PREV_GOODS_PRICE", "AMT_GOODS_PRICE", "MEAN", "MAX"),
        F.avg(ratio("AMT_GOODS_PRICE", credit)).alias("PREV_GOODS_TO_CREDIT_RATIO"),
    ]
    return aggregate_with_distinct(previous_base(previous), KEY, plain, distinct)


def approved_loans(previous: DataFrame) -> DataFrame:
    """(customer, approved loan), ready to link to payments: a relation, since a list
    per customer would have no bound."""
    return previous.where(col("NAME_CONTRACT_STATUS") == "Approved").select(KEY, LOAN)


def linkage_features(previous: DataFrame) -> DataFrame:
    """Totals of the approved loans, one row per customer."""
    approved = col("NAME_CONTRACT_STATUS") == "Approved"
    portfolio = col("NAME_PORTFOLIO")
    return previous.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("PREV_APP_COUNT"),
        F.count_if(approved).alias("PREV_APPROVED_COUNT"),
        share(approved).alias("PREV_APPROVAL_RATE"),
        *[
            F.count_if(approved & (portfolio == name)).alias(f"PREV_APPROVED_{name.upper()}_COUNT")
            for name in ("POS", "Cash", "Cards")
        ],
        F.count_if(approved & (col("DAYS_DECISION") > -365)).alias("PREV_RECENT_APPROVED_COUNT"),
        F.max(F.when(approved, col("AMT_CREDIT"))).alias("PREV_LAST_APPROVED_AMOUNT"),
        # The minimum of negative day offsets: the oldest approval, as defined.
        F.min(F.when(approved, col("DAYS_DECISION"))).alias("PREV_LAST_APPROVED_DAYS"),
    )


def high_impact_features(previous: DataFrame) -> DataFrame:
    status, decided = col("NAME_CONTRACT_STATUS"), col("DAYS_DECISION")
    down = col("AMT_DOWN_PAYMENT")
    portfolio_kinds = F.count_distinct("NAME_PORTFOLIO") + F.max(col("NAME_PORTFOLIO").isNull().cast("int"))
    return previous.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("PREV_APP_COUNT"),
        share(status == "Approved").alias("PREV_APPROVAL_RATE"),
        share(status == "Refused").alias("PREV_REFUSAL_RATE"),
        F.avg(ratio("AMT_CREDIT", "AMT_APPLICATION")).alias("PREV_APPROVAL_RATIO_MEAN"),
        F.sum("AMT_CREDIT").alias("PREV_TOTAL_CREDIT_HISTORY"),
        F.sum("AMT_APPLICATION").alias("PREV_TOTAL_REQUESTED_HISTORY"),
        F.count_if(col("CODE_REJECT_REASON") == "HC").alias("PREV_HIGH_RISK_REJECTS"),
        F.count_if(col("RATE_INTEREST_PRIMARY") > 0.2).alias("PREV_HIGH_INTEREST_COUNT"),
        F.count_if(down.isNull() | (down == 0)).alias("PREV_NO_DOWN_PAYMENT_COUNT"),
        F.count_if(col("NAME_CLIENT_TYPE") == "Repeater").alias("PREV_REPEAT_CUSTOMER_APPS"),
        portfolio_kinds.alias("PREV_PRODUCT_DIVERSITY"),
        F.min(decided).alias("PREV_MOST_RECENT_APP_DAYS"),
        F.count_if(decided > -90).alias("PREV_APPS_LAST_90_DAYS"),
        F.count_if(decided > -365).alias("PREV_APPS_LAST_YEAR"),
    )
