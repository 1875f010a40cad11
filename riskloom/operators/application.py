"""Projections over the application table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.numeric import ratio

# The approved application columns.
APPLICATION_COLUMNS = [
    "SK_ID_CURR",
    "CNT_CHILDREN",
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_GOODS_PRICE",
    "NAME_CONTRACT_TYPE",
    "NAME_INCOME_TYPE",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
    "NAME_HOUSING_TYPE",
    "OCCUPATION_TYPE",
    "ORGANIZATION_TYPE",
    "DAYS_BIRTH",
    "DAYS_EMPLOYED",
    "FLAG_MOBIL",
    "FLAG_EMP_PHONE",
    "FLAG_WORK_PHONE",
    "FLAG_PHONE",
    "FLAG_EMAIL",
    "FLAG_OWN_CAR",
    "FLAG_OWN_REALTY",
    "OWN_CAR_AGE",
] + [f"FLAG_DOCUMENT_{n}" for n in range(2, 22)]

# Staging name for each source column.
STAGING_NAMES = {
    "SK_ID_CURR": "application_id",
    "TARGET": "is_default",
    "AMT_CREDIT": "loan_amount",
    "AMT_ANNUITY": "annuity_amount",
    "AMT_GOODS_PRICE": "goods_price",
    "AMT_INCOME_TOTAL": "total_income",
    "EXT_SOURCE_1": "external_score_1",
    "EXT_SOURCE_2": "external_score_2",
    "EXT_SOURCE_3": "external_score_3",
    "DAYS_BIRTH": "days_birth",
    "DAYS_EMPLOYED": "days_employed",
    "DAYS_ID_PUBLISH": "days_id_published",
    "CNT_CHILDREN": "children_count",
    "CODE_GENDER": "gender",
    "NAME_EDUCATION_TYPE": "education_type",
    "NAME_FAMILY_STATUS": "family_status",
    "NAME_INCOME_TYPE": "income_type",
    "ORGANIZATION_TYPE": "organization_type",
    "REGION_POPULATION_RELATIVE": "region_population_relative",
}


def mart_application(application: DataFrame) -> DataFrame:
    return application.where("SK_ID_CURR IS NOT NULL").select(*APPLICATION_COLUMNS)


def mart_application_train(application: DataFrame) -> DataFrame:
    return application.where("SK_ID_CURR IS NOT NULL").select("SK_ID_CURR", "TARGET")


def stage_application(application: DataFrame, limit: int | None = None, stamp: bool = False) -> DataFrame:
    """Renamed, lightly cleaned applications with three derived columns.

    ``limit`` is the development-target row limit; ``stamp`` adds the load time.
    """
    valid = application.where("SK_ID_CURR IS NOT NULL AND AMT_CREDIT > 0")
    staged = valid.select(
        *[F.col(source).alias(name) for source, name in STAGING_NAMES.items()],
        F.round(-F.col("DAYS_BIRTH") / F.lit(365.25), 1).alias("age_years"),
        F.when(
            F.col("AMT_INCOME_TOTAL") > 0, F.round(ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"), 2)
        ).alias("credit_income_ratio"),
        F.coalesce("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3").isNull().cast("int").alias(
            "missing_all_external_scores"
        ),
    )
    if stamp:
        staged = staged.withColumn("dbt_loaded_at", F.current_timestamp())
    return staged if limit is None else staged.limit(limit)


def assume_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Make ``columns`` NOT NULL in the schema; a stray NULL becomes the type's
    default value, so no row is lost. Joins on such a key skip their NULL filter."""

    def filled(name: str) -> Column:
        kind = df.schema[name].dataType
        return F.coalesce(F.col(name), F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)).alias(name)

    return df.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])
