"""Domain tables derived from the given parquet tables.

The same SQL text runs on Spark (base tables passed in as DataFrames) and on
DuckDB (base tables are views), so every operator has a common input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DOCUMENT_FLAGS = ",\n".join(
    f"  CAST(CASE WHEN c_custkey % {n} = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLAG_DOCUMENT_{n}"
    for n in range(2, 22)
)

_APPLICATION_TRAIN = """SELECT
  CAST(c_custkey AS BIGINT) AS SK_ID_CURR,
  CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS TARGET,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS CODE_GENDER,
  CAST(CAST(c_custkey % 4 AS INT) AS BIGINT) AS CNT_CHILDREN,
  CAST(25000.0 + abs(c_acctbal) * 20 AS DOUBLE) AS AMT_INCOME_TOTAL,
  CAST(CASE WHEN c_custkey % 50 = 0 THEN 0.0 ELSE 50000.0 + (c_custkey * 7919) % 900000 END AS DOUBLE) AS AMT_CREDIT,
  CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 5000.0 + (c_custkey * 31) % 40000 END AS DOUBLE) AS AMT_ANNUITY,
  CAST(CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 45000.0 + (c_custkey * 7907) % 900000 END AS DOUBLE) AS AMT_GOODS_PRICE,
  CASE WHEN c_custkey % 10 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN c_custkey % 3 = 0 THEN 'Working' WHEN c_custkey % 3 = 1 THEN 'Pensioner' ELSE 'Commercial associate' END AS NAME_INCOME_TYPE,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS NAME_EDUCATION_TYPE,
  CASE WHEN c_custkey % 5 < 3 THEN 'Married' ELSE 'Single / not married' END AS NAME_FAMILY_STATUS,
  CAST(c_nationkey AS VARCHAR(10)) AS ORGANIZATION_TYPE,
  CAST(CAST(-(7500 + (c_custkey * 37) % 17500) AS INT) AS BIGINT) AS DAYS_BIRTH,
  CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE CAST(-((c_custkey * 11) % 15000) AS INT) END AS BIGINT) AS DAYS_EMPLOYED,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE ((c_custkey * 13) % 1000) / 1000.0 END AS DOUBLE) AS EXT_SOURCE_1,
  CAST(CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE ((c_custkey * 17) % 1000) / 1000.0 END AS DOUBLE) AS EXT_SOURCE_2,
  CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE ((c_custkey * 19) % 1000) / 1000.0 END AS DOUBLE) AS EXT_SOURCE_3,
  CASE WHEN c_custkey % 4 = 0 THEN 'Rented apartment' ELSE 'House / apartment' END AS NAME_HOUSING_TYPE,
  CASE WHEN c_custkey % 3 = 1 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Laborers' ELSE 'Managers' END AS OCCUPATION_TYPE,
  CAST(1 AS BIGINT) AS FLAG_MOBIL,
  CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLAG_EMP_PHONE,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLAG_WORK_PHONE,
  CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLAG_PHONE,
  CAST(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLAG_EMAIL,
  CAST(CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLAG_OWN_CAR,
  CAST(CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS FLAG_OWN_REALTY,
  CAST(CASE WHEN c_custkey % 6 = 0 THEN c_custkey % 30 ELSE NULL END AS BIGINT) AS OWN_CAR_AGE,
  CAST(-((c_custkey * 23) % 6000) AS BIGINT) AS DAYS_ID_PUBLISH,
  CAST((c_custkey % 70) / 1000.0 AS DOUBLE) AS REGION_POPULATION_RELATIVE,
""" + _DOCUMENT_FLAGS + """
FROM customer"""

_BUREAU = """SELECT
  CAST(o_custkey AS BIGINT) AS SK_ID_CURR,
  CAST(o_orderkey AS BIGINT) AS SK_ID_BUREAU,
  CASE WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderkey % 2 = 0 THEN 'Bad debt' ELSE 'Sold' END AS CREDIT_ACTIVE,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderpriority END AS CREDIT_TYPE,
  CAST(CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN o_orderkey % 120 ELSE 0 END AS BIGINT) AS CREDIT_DAY_OVERDUE,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN floor(o_totalprice / 100) ELSE 0.0 END AS DOUBLE) AS AMT_CREDIT_SUM_OVERDUE,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN floor(o_totalprice / 50) ELSE NULL END AS DOUBLE) AS AMT_CREDIT_MAX_OVERDUE,
  CAST(o_orderkey % 4 AS BIGINT) AS CNT_CREDIT_PROLONG,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE floor(o_totalprice * (o_orderkey % 11) / 10) END AS DOUBLE) AS AMT_CREDIT_SUM_DEBT,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 0.0 ELSE floor(o_totalprice / 2) END AS DOUBLE) AS AMT_CREDIT_SUM_LIMIT,
  CAST(floor(o_totalprice) AS DOUBLE) AS AMT_CREDIT_SUM,
  CAST(-((o_orderkey * 17) % 3000) AS BIGINT) AS DAYS_CREDIT
FROM orders"""

# Histories of every eighth record are filed under the next id, so some records have none.
_BUREAU_BALANCE = """SELECT
  CAST(CASE WHEN l_orderkey % 8 = 0 THEN l_orderkey + 1 ELSE l_orderkey END AS BIGINT) AS SK_ID_BUREAU,
  CAST(CAST((year(l_shipdate) - 2002) * 12 + month(l_shipdate) AS INT) AS BIGINT) AS MONTHS_BALANCE,
  CASE WHEN l_returnflag = 'N' THEN '0' WHEN l_returnflag = 'A' AND l_linenumber % 2 = 0 THEN 'C' WHEN l_returnflag = 'A' THEN 'X' ELSE CAST(1 + l_linenumber % 5 AS VARCHAR(2)) END AS STATUS
FROM lineitem"""

_POS_CASH_BALANCE = """SELECT
  CAST(l.l_orderkey AS BIGINT) AS SK_ID_PREV,
  CAST(o.o_custkey AS BIGINT) AS SK_ID_CURR,
  CAST(CAST((year(l_shipdate) - 2002) * 12 + month(l_shipdate) AS INT) AS BIGINT) AS MONTHS_BALANCE,
  CAST(CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS DOUBLE) AS CNT_INSTALMENT,
  CAST(CASE WHEN l_linenumber = 6 THEN NULL ELSE floor(l_quantity / l_linenumber) END AS DOUBLE) AS CNT_INSTALMENT_FUTURE,
  CASE WHEN l_returnflag = 'A' THEN 'Completed' WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'Demand' ELSE 'Active' END AS NAME_CONTRACT_STATUS,
  CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber > 5 THEN CAST(floor(l_extendedprice) AS BIGINT) % 120 WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice) AS BIGINT) % 10 ELSE 0 END AS BIGINT) AS SK_DPD,
  CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN CAST(floor(l_extendedprice) AS BIGINT) % 60 ELSE 0 END AS BIGINT) AS SK_DPD_DEF
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

_CREDIT_CARD_BALANCE = """SELECT
  CAST(o.o_custkey AS BIGINT) AS SK_ID_CURR,
  CAST(l.l_suppkey AS BIGINT) AS SK_ID_PREV,
  CAST(CAST((year(l_shipdate) - 2002) * 12 + month(l_shipdate) AS INT) AS BIGINT) AS MONTHS_BALANCE,
  CAST(CASE WHEN l_linenumber = 5 THEN 0.0 ELSE floor(l_extendedprice) END AS DOUBLE) AS AMT_BALANCE,
  CAST(CASE WHEN l_discount = 0 THEN 0.0 ELSE 1000.0 * l_quantity END AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL,
  CAST(CASE WHEN l_linenumber = 2 THEN NULL WHEN l_returnflag = 'R' THEN 0.0 ELSE floor(l_extendedprice / 10) END AS DOUBLE) AS AMT_PAYMENT_CURRENT,
  CAST(CASE WHEN l_linenumber = 3 THEN NULL ELSE floor(l_extendedprice / 20) END AS DOUBLE) AS AMT_INST_MIN_REGULARITY,
  CAST(CASE WHEN l_linenumber = 4 THEN NULL WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice) AS BIGINT) % 95 ELSE 0 END AS BIGINT) AS SK_DPD,
  CAST(CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE floor(l_extendedprice / 4) END AS DOUBLE) AS AMT_DRAWINGS_CURRENT,
  CAST(CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE floor(l_extendedprice / 8) END AS DOUBLE) AS AMT_DRAWINGS_ATM_CURRENT,
  CAST(CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE floor(l_extendedprice / 16) END AS DOUBLE) AS AMT_DRAWINGS_POS_CURRENT,
  CAST(0.0 AS DOUBLE) AS AMT_DRAWINGS_OTHER_CURRENT,
  CAST(CAST(l_linenumber AS BIGINT) AS BIGINT) AS CNT_DRAWINGS_CURRENT,
  CAST(CAST(l_linenumber % 3 AS BIGINT) AS BIGINT) AS CNT_DRAWINGS_ATM_CURRENT,
  CAST(CAST(l_linenumber % 2 AS BIGINT) AS BIGINT) AS CNT_DRAWINGS_POS_CURRENT
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

_PREVIOUS_APPLICATION = """SELECT
  CAST(o_custkey AS BIGINT) AS SK_ID_CURR,
  CAST(o_orderkey AS BIGINT) AS SK_ID_PREV,
  CAST(floor(o_totalprice) AS DOUBLE) AS AMT_APPLICATION,
  CAST(CASE WHEN o_orderkey % 6 = 0 THEN 0.0 ELSE floor(o_totalprice * (8 + o_orderkey % 5) / 10) END AS DOUBLE) AS AMT_CREDIT,
  CAST(CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE floor(o_totalprice / 12) END AS DOUBLE) AS AMT_ANNUITY,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 0.0 ELSE floor(o_totalprice / 20) END AS DOUBLE) AS AMT_DOWN_PAYMENT,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 10) / 100.0 END AS DOUBLE) AS RATE_DOWN_PAYMENT,
  CAST(CASE WHEN o_orderkey % 4 <> 0 THEN NULL ELSE (o_orderkey % 40) / 100.0 END AS DOUBLE) AS RATE_INTEREST_PRIMARY,
  CAST(CAST(-((o_orderkey * 13) % 1000) AS DOUBLE) AS DOUBLE) AS DAYS_DECISION,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(6 + 6 * (o_orderkey % 8) AS DOUBLE) END AS DOUBLE) AS CNT_PAYMENT,
  CAST(floor(o_totalprice * 0.9) AS DOUBLE) AS AMT_GOODS_PRICE,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS DOUBLE) END AS DOUBLE) AS NFLAG_INSURED_ON_APPROVAL,
  CAST(CASE WHEN o_orderkey % 31 = 0 THEN 0 ELSE 1 END AS BIGINT) AS NFLAG_LAST_APPL_IN_DAY,
  CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Cash loans' WHEN o_orderkey % 3 = 1 THEN 'Consumer loans' ELSE 'Revolving loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Cash' WHEN o_orderkey % 4 = 1 THEN 'POS' WHEN o_orderkey % 4 = 2 THEN 'Cards' ELSE NULL END AS NAME_PORTFOLIO,
  CASE WHEN o_orderkey % 10 < 7 THEN 'Repeater' ELSE 'New' END AS NAME_CLIENT_TYPE,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Cash through the bank' ELSE 'XNA' END AS NAME_PAYMENT_TYPE,
  o_orderpriority AS CHANNEL_TYPE,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Mobile' ELSE 'Furniture' END AS NAME_GOODS_CATEGORY,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Repairs' ELSE 'XAP' END AS NAME_CASH_LOAN_PURPOSE,
  CASE WHEN o_orderkey % 4 = 0 THEN 'high' WHEN o_orderkey % 4 = 1 THEN 'low_action' ELSE 'middle' END AS NAME_YIELD_GROUP,
  CASE WHEN o_orderstatus = 'O' AND o_orderkey % 4 = 0 THEN 'HC' WHEN o_orderstatus = 'O' AND o_orderkey % 4 = 1 THEN 'LIMIT' WHEN o_orderstatus = 'O' AND o_orderkey % 4 = 2 THEN 'SCO' WHEN o_orderstatus = 'O' THEN 'CLIENT' ELSE 'XAP' END AS CODE_REJECT_REASON
FROM orders"""

# Second population for the union of external scores; its ids overlap the first.
_APPLICATION_TEST = """SELECT
  CAST(s_suppkey * 2 AS BIGINT) AS SK_ID_CURR,
  CAST((s_suppkey * 7 % 1000) / 1000.0 AS DOUBLE) AS EXT_SOURCE_1,
  CAST(CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE (s_suppkey * 11 % 1000) / 1000.0 END AS DOUBLE) AS EXT_SOURCE_2,
  CAST((s_suppkey * 3 % 1000) / 1000.0 AS DOUBLE) AS EXT_SOURCE_3
FROM supplier"""

_STATUS_LOG = """SELECT
  CAST(event_id AS BIGINT) AS id,
  CAST(user_id AS VARCHAR(20)) AS sk_id_curr,
  CASE event_type WHEN 'signup' THEN 'submitted' WHEN 'view' THEN 'bureau_requested'
       WHEN 'click' THEN 'ml_scoring' WHEN 'purchase' THEN 'approved' ELSE 'error' END AS status,
  ts AS created_at,
  CASE WHEN event_id % 3 = 0 THEN 'api-service' ELSE 'ml-scoring-service' END AS created_by,
  props AS metadata
FROM events"""

# Feature arrivals per key: which of the three sources wrote, and when.
_SOURCE_ARRIVALS = """SELECT
  CAST(user_id AS VARCHAR(20)) AS sk_id_curr,
  CASE WHEN event_type IN ('view', 'signup') THEN 'application' WHEN event_type = 'click' THEN 'external' ELSE 'dwh' END AS source,
  ts,
  value
FROM events"""

# A fixed score with ties, and two more "models" over the same customers.
_SCORES = """SELECT
  CAST(c_custkey AS BIGINT) AS SK_ID_CURR,
  CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS TARGET,
  CAST(((c_custkey * 7919) % 700 + CASE WHEN c_acctbal < 0 THEN 300 ELSE 0 END) AS DOUBLE) / 1000.0 AS P_A,
  CAST(((c_custkey * 104729) % 800 + CASE WHEN c_acctbal < 0 THEN 200 ELSE 0 END) AS DOUBLE) / 1000.0 AS P_B,
  CAST(((c_custkey * 1299709) % 900 + CASE WHEN c_acctbal < 0 THEN 100 ELSE 0 END) AS DOUBLE) / 1000.0 AS P_C
FROM customer"""

VIEWS = {
    "application_train": _APPLICATION_TRAIN,
    "application_test": _APPLICATION_TEST,
    "bureau": _BUREAU,
    "bureau_balance": _BUREAU_BALANCE,
    "pos_cash_balance": _POS_CASH_BALANCE,
    "credit_card_balance": _CREDIT_CARD_BALANCE,
    "previous_application": _PREVIOUS_APPLICATION,
    "status_log": _STATUS_LOG,
    "source_arrivals": _SOURCE_ARRIVALS,
    "scores": _SCORES,
}

_BASE_TABLE = re.compile(r"\b(FROM|JOIN) (customer|orders|lineitem|supplier|events)\b")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a lazy DataFrame; Catalyst prunes it to what is read."""
    text = VIEWS[name]
    tables = {t: base_table(spark, sf_dir, t) for _, t in _BASE_TABLE.findall(text)}
    found = spark.sql(_BASE_TABLE.sub(r"\1 {\2}", text), **tables)
    # The files hold zone-less UTC times: make them instants whatever the session zone.
    naive = [f.name for f in found.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return found.withColumns(
        {c: F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(c)).cast("timestamp") for c in naive}
    )


def with_views(names: list[str], body: str) -> str:
    """DuckDB text: the named derived tables as CTEs in front of ``body``."""
    ctes = [f"f_{n} AS ({VIEWS[n]})" for n in names]
    head = "WITH " + ",\n".join(ctes)
    return head + ("" if body.startswith(",") else "\n") + body
