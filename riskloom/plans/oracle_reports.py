"""DuckDB texts for the reports."""

from __future__ import annotations

from riskloom.plans.oracle_marts import D, I, S, columns, n
from riskloom.sources.domain import with_views

_POS, _CC, _PV, _BU = "pos_cash_balance", "credit_card_balance", "previous_application", "bureau"


def _q(views: str | list[str], body: str) -> str:
    return with_views([views] if isinstance(views, str) else views, body)


_POS_ROW = columns(
    *[(I, c, c) for c in ("SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF")],
    *[(D, c, c) for c in ("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE")],
    (S, "NAME_CONTRACT_STATUS", "NAME_CONTRACT_STATUS"),
)

_SEGMENTS = """, p AS (
  SELECT SK_ID_CURR, count(*) AS n, sum((NAME_CONTRACT_STATUS = 'Approved')::INT) AS ok,
    sum((NAME_CONTRACT_STATUS = 'Refused')::INT) AS refused, avg(AMT_APPLICATION) AS asked, avg(AMT_CREDIT) AS got
  FROM f_previous_application GROUP BY 1),
b AS (
  SELECT SK_ID_CURR, count(*) AS n, sum((CREDIT_ACTIVE = 'Active')::INT) AS act, sum((CREDIT_ACTIVE = 'Closed')::INT) AS closed,
    min(DAYS_CREDIT) AS first_day, sum(AMT_CREDIT_SUM) AS debt, sum(AMT_CREDIT_SUM_OVERDUE) AS overdue
  FROM f_bureau GROUP BY 1),
s AS (
  SELECT a.SK_ID_CURR, a.TARGET, a.AMT_INCOME_TOTAL, coalesce(p.n, 0) AS PREV_APP_COUNT, coalesce(ok, 0) AS PREV_APP_APPROVED,
    coalesce(refused, 0) AS PREV_APP_REFUSED, coalesce(asked, 0) AS PREV_APP_AMT_MEAN, coalesce(got, 0) AS PREV_APP_CREDIT_MEAN,
    coalesce(b.n, 0) AS BUREAU_COUNT, coalesce(act, 0) AS BUREAU_ACTIVE_COUNT, coalesce(closed, 0) AS BUREAU_CLOSED_COUNT,
    coalesce(first_day, 0) AS DAYS_FIRST_CREDIT, coalesce(debt, 0) AS BUREAU_TOTAL_DEBT,
    coalesce(overdue, 0) AS BUREAU_TOTAL_OVERDUE, (p.n IS NULL)::INT AS IS_FIRST_TIME_CUSTOMER,
    (b.n IS NULL)::INT AS IS_CREDIT_VIRGIN, coalesce(ok / p.n, 0) AS PREV_APPROVAL_SHARE,
    CASE WHEN first_day < 0 THEN -first_day / 30.44::DOUBLE ELSE 0 END AS MONTHS_CREDIT_HISTORY,
    CASE WHEN a.AMT_INCOME_TOTAL > 0 THEN coalesce(debt, 0) / a.AMT_INCOME_TOTAL ELSE 0 END AS EXTERNAL_DEBT_INCOME_RATIO,
    CASE WHEN b.n IS NULL AND p.n IS NULL THEN 'HIGH_RISK_NEW_TO_CREDIT'
      WHEN b.n IS NULL THEN 'UNKNOWN_RISK'
      WHEN p.n IS NULL THEN 'MEDIUM_RISK_NEW_TO_LENDER'
      WHEN ok / p.n > 0.5 THEN 'LOW_RISK_REPEAT_APPROVED' ELSE 'MEDIUM_RISK_REPEAT_REJECTED' END AS CUSTOMER_RISK_SEGMENT
  FROM f_application_train a LEFT JOIN p USING (SK_ID_CURR) LEFT JOIN b USING (SK_ID_CURR))
"""
_SEGMENT_VIEWS = ["application_train", "bureau", "previous_application"]
_SEGMENT_COLUMNS = columns(
    *[
        (I, c, c)
        for c in [
            "SK_ID_CURR",
            "TARGET",
            "PREV_APP_COUNT",
            "PREV_APP_APPROVED",
            "PREV_APP_REFUSED",
            "BUREAU_COUNT",
            "BUREAU_ACTIVE_COUNT",
            "BUREAU_CLOSED_COUNT",
            "DAYS_FIRST_CREDIT",
            "IS_FIRST_TIME_CUSTOMER",
            "IS_CREDIT_VIRGIN",
        ]
    ],
    *[
        (D, c, c)
        for c in [
            "AMT_INCOME_TOTAL",
            "PREV_APP_AMT_MEAN",
            "PREV_APP_CREDIT_MEAN",
            "BUREAU_TOTAL_DEBT",
            "BUREAU_TOTAL_OVERDUE",
            "PREV_APPROVAL_SHARE",
            "MONTHS_CREDIT_HISTORY",
            "EXTERNAL_DEBT_INCOME_RATIO",
        ]
    ],
    (S, "CUSTOMER_RISK_SEGMENT", "CUSTOMER_RISK_SEGMENT"),
)

_DISCIPLINE = """, d AS (
  SELECT SK_ID_CURR, count(*) AS total_records, max(SK_DPD) AS max_dpd_ever, avg(SK_DPD) AS avg_dpd,
    coalesce(count(*) FILTER (WHERE SK_DPD > 0), 0) AS late_payments
  FROM f_pos_cash_balance GROUP BY 1),
r AS (SELECT *, late_payments / total_records AS rate FROM d)
"""
_DISCIPLINE_COLUMNS = columns(
    (I, "SK_ID_CURR", "SK_ID_CURR"),
    (I, "total_records", "total_records"),
    (I, "max_dpd_ever", "max_dpd_ever"),
    (D, "avg_dpd", "avg_dpd"),
    (I, "late_payments", "late_payments"),
    (D, "rate", "late_payment_rate"),
    (
        S,
        "CASE WHEN rate = 0 THEN 'perfect' WHEN rate <= 0.1::DOUBLE THEN 'good' WHEN rate <= 0.3::DOUBLE THEN 'fair' "
        "WHEN rate <= 0.5 THEN 'poor' ELSE 'very poor' END",
        "discipline",
    ),
)

_USED = "AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0)"
_PROFILE = [
    *[(D, f"{f}(AMT_BALANCE)", f"{f}_balance") for f in ("min", "max", "avg")],
    *[(D, f"{f}(AMT_PAYMENT_CURRENT)", f"{f}_payment") for f in ("min", "max", "avg")],
    (I, n("AMT_PAYMENT_CURRENT = 0"), "zero_payment_months"),
    (I, n("AMT_BALANCE > AMT_PAYMENT_CURRENT"), "underpayment_months"),
    *[(D, f"{f}({_USED})", f"{f}_utilization") for f in ("min", "max", "avg")],
    (D, f"median({_USED})", "median_utilization"),
    (I, n(f"{_USED} > 0.8::DOUBLE"), "high_utilization_months"),
    (I, n(f"{_USED} > 1"), "over_limit_months"),
    (D, "avg(SK_DPD)", "avg_dpd"),
    (I, "max(SK_DPD)", "max_dpd"),
    (I, n("SK_DPD = 0"), "on_time_months"),
    (I, n("SK_DPD >= 1 AND SK_DPD <= 30"), "dpd_1_30_months"),
    (I, n("SK_DPD >= 31 AND SK_DPD <= 60"), "dpd_31_60_months"),
    (I, n("SK_DPD > 60"), "dpd_60plus_months"),
    (I, n("SK_DPD > 0"), "any_dpd_months"),
    (D, "avg(AMT_DRAWINGS_CURRENT)", "avg_monthly_spending"),
    (D, "avg(AMT_DRAWINGS_ATM_CURRENT)", "avg_atm_withdrawals"),
    (D, "avg(AMT_DRAWINGS_POS_CURRENT)", "avg_pos_purchases"),
    (D, "avg(CNT_DRAWINGS_CURRENT)", "avg_transactions_per_month"),
    (D, "avg(CNT_DRAWINGS_ATM_CURRENT)", "avg_atm_transactions"),
    (I, n("AMT_DRAWINGS_CURRENT = 0"), "inactive_months"),
]


def _profile_of(name: str) -> str:
    spec = columns(
        (S, f"'{name}'", '"column"'),
        *[(D, f"{f}({name})", g) for f, g in (("min", '"min"'), ("max", '"max"'), ("avg", "mean"), ("median", '"median"'), ("stddev_samp", '"std"'))],
        (I, n(f"{name} = 0"), "zero_count"),
        (I, n(f"{name} < 0"), "negative_count"),
        (I, n(f"{name} > 0"), "positive_count"),
        (I, n(f"{name} IS NULL"), "null_count"),
    )
    return f"SELECT {spec} FROM f_bureau"


REPORTS = {
    "record_timeline": _q(
        _POS,
        f"SELECT {_POS_ROW} FROM f_pos_cash_balance WHERE SK_ID_CURR = (SELECT SK_ID_CURR FROM f_pos_cash_balance "
        "GROUP BY 1 ORDER BY count(*) DESC, SK_ID_CURR LIMIT 1) ORDER BY MONTHS_BALANCE DESC",
    ),
    "status_recent_vs_older": _q(
        _POS,
        """, x AS (SELECT NAME_CONTRACT_STATUS, count(*) AS c FROM f_pos_cash_balance WHERE MONTHS_BALANCE >= -30 GROUP BY 1),
y AS (SELECT NAME_CONTRACT_STATUS, count(*) AS c FROM f_pos_cash_balance WHERE MONTHS_BALANCE < -60 GROUP BY 1)
SELECT coalesce(x.NAME_CONTRACT_STATUS, y.NAME_CONTRACT_STATUS) AS NAME_CONTRACT_STATUS,
  coalesce(x.c, 0) AS recent_count, coalesce(y.c, 0) AS older_count
FROM x FULL JOIN y ON x.NAME_CONTRACT_STATUS = y.NAME_CONTRACT_STATUS""",
    ),
    "key_overlap": _q(
        ["bureau_balance", "bureau"],
        """, l AS (SELECT DISTINCT SK_ID_BUREAU FROM f_bureau_balance), r AS (SELECT DISTINCT SK_ID_BUREAU FROM f_bureau)
SELECT (SELECT count(*) FROM l) AS left_keys, (SELECT count(*) FROM r) AS right_keys,
  (SELECT count(*) FROM l JOIN r USING (SK_ID_BUREAU)) AS common_keys,
  round((SELECT count(*) FROM l JOIN r USING (SK_ID_BUREAU)) / (SELECT count(*) FROM l), 6) AS coverage""",
    ),
    "customer_segments": _q(_SEGMENT_VIEWS, f"{_SEGMENTS} SELECT {_SEGMENT_COLUMNS} FROM s"),
    "segment_default_rate": _q(
        _SEGMENT_VIEWS,
        f"""{_SEGMENTS} SELECT IS_CREDIT_VIRGIN::BIGINT AS IS_CREDIT_VIRGIN, CUSTOMER_RISK_SEGMENT,
  CAST(grouping(IS_CREDIT_VIRGIN, CUSTOMER_RISK_SEGMENT) AS BIGINT) AS "grouping", count(*) AS "count",
  round(avg(TARGET), 6) AS default_rate FROM s GROUP BY CUBE (IS_CREDIT_VIRGIN, CUSTOMER_RISK_SEGMENT)""",
    ),
    "payment_discipline": _q(_POS, f"{_DISCIPLINE} SELECT {_DISCIPLINE_COLUMNS} FROM r"),
    "discipline_extremes": _q(
        _POS,
        f"""{_DISCIPLINE}
SELECT * FROM (SELECT {_DISCIPLINE_COLUMNS}, 'best' AS side FROM r WHERE total_records >= 5
  ORDER BY rate, r.max_dpd_ever, r.SK_ID_CURR LIMIT 5)
UNION ALL SELECT * FROM (SELECT {_DISCIPLINE_COLUMNS}, 'worst' AS side FROM r WHERE total_records >= 5
  ORDER BY rate DESC, r.max_dpd_ever DESC, r.SK_ID_CURR LIMIT 5)""",
    ),
    "loan_terms": _q(
        _POS,
        """, t AS (SELECT DISTINCT SK_ID_PREV, CNT_INSTALMENT FROM f_pos_cash_balance WHERE CNT_INSTALMENT IS NOT NULL)
SELECT CASE WHEN CNT_INSTALMENT > 24 THEN 'Long-term (>24 months)' WHEN CNT_INSTALMENT > 12 THEN 'Medium-term (13-24 months)'
  ELSE 'Short-term (≤12 months)' END AS loan_term_category, count(*) AS loan_count,
  round(avg(CNT_INSTALMENT), 6) AS avg_installments, min(CNT_INSTALMENT) AS min_installments,
  max(CNT_INSTALMENT) AS max_installments FROM t GROUP BY 1""",
    ),
    "top_terms": _q(
        _POS,
        """, t AS (SELECT DISTINCT SK_ID_PREV, CNT_INSTALMENT FROM f_pos_cash_balance WHERE CNT_INSTALMENT IS NOT NULL)
SELECT CNT_INSTALMENT, count(*) AS "count" FROM t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "months_distribution": _q(
        _POS,
        """SELECT MONTHS_BALANCE, count(*) AS records, count(DISTINCT SK_ID_CURR) AS unique_customers
FROM f_pos_cash_balance GROUP BY 1""",
    ),
    "status_distribution": _q(
        _POS,
        """SELECT NAME_CONTRACT_STATUS, count(*) AS "count", round(avg(SK_DPD), 6) AS avg_dpd, max(SK_DPD) AS max_dpd
FROM f_pos_cash_balance GROUP BY 1""",
    ),
    "dpd_histogram": _q(_POS, 'SELECT SK_DPD, count(*) AS "count" FROM f_pos_cash_balance GROUP BY 1'),
    "status_patterns": _q(
        _BU,
        """, c AS (SELECT SK_ID_CURR, count(DISTINCT coalesce(CREDIT_ACTIVE, '(none)')) AS unique_statuses,
  count(DISTINCT coalesce(CREDIT_TYPE, '(none)')) AS unique_credit_types FROM f_bureau GROUP BY 1)
SELECT unique_statuses, unique_credit_types, count(*) AS client_count FROM c GROUP BY 1, 2""",
    ),
    "card_profile": _q(_CC, f"SELECT {columns(*_PROFILE)} FROM f_credit_card_balance"),
    "column_profile": _q(
        _BU,
        " UNION ALL ".join(
            _profile_of(c) for c in ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "DAYS_CREDIT")
        ),
    ),
    "amount_profile": _q(
        _PV,
        "SELECT "
        + columns(
            (D, "avg(AMT_APPLICATION)", "avg_requested"),
            (D, "avg(AMT_CREDIT)", "avg_approved"),
            (D, "median(AMT_APPLICATION)", "median_requested"),
            (D, "median(AMT_CREDIT)", "median_approved"),
            (D, "avg(AMT_CREDIT / nullif(AMT_APPLICATION, 0))", "avg_approval_ratio"),
            (I, n("AMT_CREDIT > AMT_APPLICATION"), "over_approved_count"),
            (I, n("AMT_CREDIT < AMT_APPLICATION"), "under_approved_count"),
        )
        + " FROM f_previous_application",
    ),
    "value_counts": _q(_BU, 'SELECT CREDIT_TYPE, count(*) AS "count" FROM f_bureau GROUP BY 1'),
    "rejection_reasons": _q(
        _PV,
        """SELECT CODE_REJECT_REASON, count(*) AS "count" FROM f_previous_application
WHERE NAME_CONTRACT_STATUS <> 'Approved' GROUP BY 1""",
    ),
    "client_type_approval": _q(
        _PV,
        """SELECT NAME_CLIENT_TYPE, count(*) AS application_count,
  count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') AS approved_count,
  round(avg((NAME_CONTRACT_STATUS = 'Approved')::INT), 6) AS approval_rate FROM f_previous_application GROUP BY 1""",
    ),
    "ext_scores_union": _q(
        ["application_train", "application_test"],
        """SELECT SK_ID_CURR, EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3 FROM f_application_train
UNION ALL SELECT SK_ID_CURR, EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3 FROM f_application_test
WHERE SK_ID_CURR NOT IN (SELECT SK_ID_CURR FROM f_application_train)""",
    ),
}
