"""Registered queries: feature marts and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import application, bureau, cards, pos, previous
from riskloom.sources.domain import view


def over(*names: str):
    """Decorator: call ``fn`` with the named derived tables of ``sf_dir``."""

    def wrap(fn):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(*[view(spark, sf_dir, n) for n in names])

        return query

    return wrap


QUERIES = {
    "mart_application": over("application_train")(application.mart_application),
    "mart_application_train": over("application_train")(application.mart_application_train),
    "stg_application": over("application_train")(application.stage_application),
    "select_not_null": over("application_train")(
        lambda df: application.assume_not_null(df.select("SK_ID_CURR", "AMT_ANNUITY", "NAME_EDUCATION_TYPE"), ["SK_ID_CURR"])
    ),
    "bureau_risk": over("bureau")(bureau.bureau_risk),
    "bureau_advanced": over("bureau")(bureau.bureau_advanced),
    "bureau_balance_agg": over("bureau_balance")(bureau.balance_per_record),
    "bureau_balance_client": over("bureau", "bureau_balance")(bureau.bureau_balance_client),
    "mart_bureau_features": over("bureau", "bureau_balance")(bureau.bureau_features),
    "mart_credit_card_balance": over("credit_card_balance")(cards.card_features),
    "pos_loan_level": over("pos_cash_balance")(pos.pos_loan_level),
    "mart_pos_cash_balance": over("pos_cash_balance")(pos.pos_features),
    "mart_previous_application": over("previous_application")(previous.previous_features),
    "prev_linkage": over("previous_application")(previous.linkage_features),
    "prev_approved_loans": over("previous_application")(previous.approved_loans),
    "prev_high_impact": over("previous_application")(previous.high_impact_features),
    "cc_dynamic_avg": over("credit_card_balance")(lambda df: cards.numeric_averages(df, "SK_ID_CURR")),
}
