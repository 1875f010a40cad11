"""DuckDB texts for the feature marts, written independently of the operators."""

from __future__ import annotations

from riskloom.sources.domain import with_views

D, I, S = "d", "i", "s"


def typed(kind: str, expression: str, name: str) -> str:
    """One output column: doubles rounded as in ``tidy``, integers as BIGINT."""
    if kind == D:
        return f"round(CAST({expression} AS DOUBLE) + 1e-10, 6) + 0.0 AS {name}"
    if kind == I:
        return f"CAST({expression} AS BIGINT) AS {name}"
    return f"{expression} AS {name}"


def columns(*specs: tuple[str, str, str]) -> str:
    return ",\n  ".join(typed(*s) for s in specs)


def passthrough(doubles: list[str] = (), ints: list[str] = (), texts: list[str] = ()) -> str:
    return columns(*[(D, c, c) for c in doubles], *[(I, c, c) for c in ints], *[(S, c, c) for c in texts])


def n(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def pct(cond: str) -> str:
    return f"{n(cond)} / CAST(count(*) AS DOUBLE)"


# --- bureau -----------------------------------------------------------------

_RISK = [
    (I, "count(*)", "BUREAU_TOTAL_COUNT"),
    (I, "count(DISTINCT CREDIT_TYPE)", "BUREAU_CREDIT_TYPES_COUNT"),
    (I, n("CREDIT_ACTIVE = 'Active'"), "BUREAU_ACTIVE_COUNT"),
    (I, n("CREDIT_ACTIVE = 'Closed'"), "BUREAU_CLOSED_COUNT"),
    (I, n("CREDIT_ACTIVE = 'Bad debt'"), "BUREAU_BAD_DEBT_COUNT"),
    (I, n("CREDIT_ACTIVE = 'Sold'"), "BUREAU_SOLD_COUNT"),
    (D, pct("CREDIT_ACTIVE = 'Bad debt'"), "BUREAU_BAD_DEBT_RATIO"),
    (D, pct("CREDIT_ACTIVE = 'Sold'"), "BUREAU_SOLD_RATIO"),
    (D, pct("CREDIT_ACTIVE IN ('Bad debt', 'Sold')"), "BUREAU_HIGH_RISK_RATIO"),
    (I, "sum(CREDIT_DAY_OVERDUE)", "BUREAU_OVERDUE_DAYS_TOTAL"),
    (D, "avg(CREDIT_DAY_OVERDUE)", "BUREAU_OVERDUE_DAYS_MEAN"),
    (I, "max(CREDIT_DAY_OVERDUE)", "BUREAU_OVERDUE_DAYS_MAX"),
    (I, n("CREDIT_DAY_OVERDUE > 0"), "BUREAU_OVERDUE_COUNT"),
    (D, pct("CREDIT_DAY_OVERDUE > 0"), "BUREAU_OVERDUE_RATIO"),
    (D, "sum(AMT_CREDIT_SUM_OVERDUE)", "BUREAU_AMT_OVERDUE_TOTAL"),
    (D, "avg(AMT_CREDIT_SUM_OVERDUE)", "BUREAU_AMT_OVERDUE_MEAN"),
    (D, "max(AMT_CREDIT_SUM_OVERDUE)", "BUREAU_AMT_OVERDUE_MAX"),
    (D, "max(AMT_CREDIT_MAX_OVERDUE)", "BUREAU_AMT_MAX_OVERDUE_EVER"),
    (I, n("AMT_CREDIT_SUM_OVERDUE > 0"), "BUREAU_AMT_OVERDUE_COUNT"),
    (D, pct("AMT_CREDIT_SUM_OVERDUE > 0"), "BUREAU_AMT_OVERDUE_RATIO"),
    (I, "sum(CNT_CREDIT_PROLONG)", "BUREAU_PROLONG_TOTAL"),
    (D, "avg(CNT_CREDIT_PROLONG)", "BUREAU_PROLONG_MEAN"),
    (I, "max(CNT_CREDIT_PROLONG)", "BUREAU_PROLONG_MAX"),
    (I, n("CNT_CREDIT_PROLONG > 0"), "BUREAU_PROLONG_COUNT"),
    (D, pct("CNT_CREDIT_PROLONG > 0"), "BUREAU_PROLONG_RATIO"),
]
_ADVANCED = [
    (D, "sum(AMT_CREDIT_SUM_DEBT) / nullif(sum(AMT_CREDIT_SUM_LIMIT), 0)", "BUREAU_CREDIT_UTILIZATION_RATIO"),
    (D, "sum(AMT_CREDIT_SUM_DEBT) / nullif(sum(AMT_CREDIT_SUM), 0)", "BUREAU_DEBT_TO_CREDIT_RATIO"),
    (D, "sum(AMT_CREDIT_SUM_OVERDUE) / nullif(sum(AMT_CREDIT_SUM), 0)", "BUREAU_OVERDUE_TO_CREDIT_RATIO"),
    (D, "sum(AMT_CREDIT_SUM) FILTER (WHERE CREDIT_ACTIVE = 'Active')", "BUREAU_ACTIVE_CREDIT_SUM"),
    (D, "sum(AMT_CREDIT_SUM_DEBT) FILTER (WHERE CREDIT_ACTIVE = 'Active')", "BUREAU_ACTIVE_DEBT_SUM"),
    (D, "sum(AMT_CREDIT_SUM_OVERDUE) FILTER (WHERE CREDIT_ACTIVE = 'Active')", "BUREAU_ACTIVE_OVERDUE_SUM"),
    (
        D,
        "sum(AMT_CREDIT_SUM_DEBT) FILTER (WHERE CREDIT_ACTIVE = 'Active') / "
        "nullif(sum(AMT_CREDIT_SUM_LIMIT) FILTER (WHERE CREDIT_ACTIVE = 'Active'), 0)",
        "BUREAU_ACTIVE_UTILIZATION_RATIO",
    ),
    (I, n("AMT_CREDIT_SUM_DEBT >= AMT_CREDIT_SUM_LIMIT"), "BUREAU_MAXED_OUT_COUNT"),
    (D, pct("AMT_CREDIT_SUM_DEBT >= AMT_CREDIT_SUM_LIMIT"), "BUREAU_MAXED_OUT_RATIO"),
    (I, n("AMT_CREDIT_SUM_DEBT > AMT_CREDIT_SUM_LIMIT * 0.8::DOUBLE"), "BUREAU_HIGH_UTIL_COUNT"),
    (D, pct("AMT_CREDIT_SUM_DEBT > AMT_CREDIT_SUM_LIMIT * 0.8::DOUBLE"), "BUREAU_HIGH_UTIL_RATIO"),
]
_PAST_DUE = "STATUS IN ('1', '2', '3', '4', '5')"
_PER_RECORD = [
    (I, "count(*)", "TOTAL_MONTHS_OBSERVED"),
    (I, n("STATUS = '0'"), "MONTHS_ON_TIME"),
    (I, n("STATUS = 'C'"), "MONTHS_CLOSED"),
    (I, n("STATUS = 'X'"), "MONTHS_UNKNOWN"),
    (I, n("STATUS = '1'"), "MONTHS_DPD_1_30"),
    (I, n("STATUS = '2'"), "MONTHS_DPD_31_60"),
    (I, n("STATUS = '3'"), "MONTHS_DPD_61_90"),
    (I, n("STATUS = '4'"), "MONTHS_DPD_91_120"),
    (I, n("STATUS = '5'"), "MONTHS_DPD_120_PLUS"),
    (I, "min(MONTHS_BALANCE)", "EARLIEST_MONTH"),
    (I, "max(MONTHS_BALANCE)", "LATEST_MONTH"),
    (I, n(_PAST_DUE), "TOTAL_DPD_MONTHS"),
    (D, pct(_PAST_DUE), "DPD_RATIO"),
    (D, pct("STATUS = '5'"), "SEVERE_DPD_RATIO"),
    (I, "(" + n("STATUS = '5'") + " > 0)", "HAS_SEVERE_DPD"),
    (I, f"({n(_PAST_DUE)} > 0)", "HAS_ANY_DPD"),
    (D, pct("STATUS = '0'"), "ON_TIME_RATIO"),
    (D, pct("STATUS = 'X'"), "UNKNOWN_RATIO"),
]
_RECORD_RAW = """record AS (
  SELECT SK_ID_BUREAU, count(*) AS months,
    count(*) FILTER (WHERE upper(STATUS) = '0') AS on_time,
    count(*) FILTER (WHERE upper(STATUS) IN ('1', '2', '3', '4', '5')) AS past_due,
    count(*) FILTER (WHERE upper(STATUS) = '5') AS severe
  FROM f_bureau_balance GROUP BY SK_ID_BUREAU)"""
_HISTORY = [
    (I, "count(SK_ID_BUREAU)", "BUREAU_WITH_BALANCE_COUNT"),
    (I, "sum(months)", "TOTAL_MONTHS_ALL_BUREAUS"),
    (I, "sum(on_time)", "TOTAL_MONTHS_ON_TIME"),
    (I, "sum(past_due)", "TOTAL_DPD_ALL_BUREAUS"),
    (I, "sum(severe)", "TOTAL_SEVERE_DPD_MONTHS"),
    (D, "max(past_due / months)", "WORST_DPD_RATIO"),
    (D, "max(severe / months)", "WORST_SEVERE_DPD_RATIO"),
    (D, "min(on_time / months)", "WORST_ON_TIME_RATIO"),
    (D, "avg(past_due / months)", "AVG_DPD_RATIO"),
    (D, "avg(on_time / months)", "AVG_ON_TIME_RATIO"),
    (I, "sum((severe > 0)::INT)", "COUNT_BUREAUS_WITH_SEVERE_DPD"),
    (I, "sum((past_due > 0)::INT)", "COUNT_BUREAUS_WITH_ANY_DPD"),
    (D, "sum(on_time) / sum(months)", "OVERALL_ON_TIME_RATIO"),
    (D, "sum(past_due) / sum(months)", "OVERALL_DPD_RATIO"),
    (D, "sum(severe) / sum(months)", "OVERALL_SEVERE_DPD_RATIO"),
    (I, "(sum((severe > 0)::INT) > 0)", "CLIENT_HAS_SEVERE_DPD_HISTORY"),
    (I, "(sum((past_due > 0)::INT) > 0)", "CLIENT_HAS_ANY_DPD_HISTORY"),
]


def _z(expression: str) -> str:
    return f"coalesce({expression}, 0)"


def _stream_variant() -> list[tuple[str, str, str]]:
    """The mart columns under the stream rules: absent amounts are zero, means
    divide by the record count, limits must be positive, history totals are 0."""
    changed = {
        "BUREAU_CREDIT_TYPES_COUNT": "count(DISTINCT CREDIT_TYPE) + max((CREDIT_TYPE IS NULL)::INT)",
        "BUREAU_OVERDUE_DAYS_TOTAL": _z("sum(CREDIT_DAY_OVERDUE)"),
        "BUREAU_OVERDUE_DAYS_MEAN": _z("sum(CREDIT_DAY_OVERDUE)") + " / count(*)::DOUBLE",
        "BUREAU_PROLONG_TOTAL": _z("sum(CNT_CREDIT_PROLONG)"),
        "BUREAU_PROLONG_MEAN": _z("sum(CNT_CREDIT_PROLONG)") + " / count(*)::DOUBLE",
        "BUREAU_MAXED_OUT_COUNT": n("AMT_CREDIT_SUM_LIMIT > 0 AND AMT_CREDIT_SUM_DEBT >= AMT_CREDIT_SUM_LIMIT"),
        "BUREAU_MAXED_OUT_RATIO": pct("AMT_CREDIT_SUM_LIMIT > 0 AND AMT_CREDIT_SUM_DEBT >= AMT_CREDIT_SUM_LIMIT"),
        "BUREAU_HIGH_UTIL_COUNT": n(
            "AMT_CREDIT_SUM_LIMIT > 0 AND AMT_CREDIT_SUM_DEBT > AMT_CREDIT_SUM_LIMIT * 0.8::DOUBLE"
        ),
        "BUREAU_HIGH_UTIL_RATIO": pct(
            "AMT_CREDIT_SUM_LIMIT > 0 AND AMT_CREDIT_SUM_DEBT > AMT_CREDIT_SUM_LIMIT * 0.8::DOUBLE"
        ),
        "BUREAU_WITH_BALANCE_COUNT": "count(months)",
    }
    zero_if_null = {
        "BUREAU_ACTIVE_CREDIT_SUM",
        "BUREAU_ACTIVE_DEBT_SUM",
        "BUREAU_ACTIVE_OVERDUE_SUM",
        "TOTAL_MONTHS_ALL_BUREAUS",
        "TOTAL_MONTHS_ON_TIME",
        "TOTAL_DPD_ALL_BUREAUS",
        "TOTAL_SEVERE_DPD_MONTHS",
        "COUNT_BUREAUS_WITH_SEVERE_DPD",
        "COUNT_BUREAUS_WITH_ANY_DPD",
    }
    out = []
    for kind, expression, name in _RISK + _ADVANCED + _HISTORY:
        expression = changed.get(name, expression)
        if name in zero_if_null:
            expression = _z(expression)
        if name.startswith("CLIENT_HAS"):
            expression = f"coalesce({expression}, false)"
        out.append((kind, expression, name))
    return out


STREAM_BUREAU_COLUMNS = _stream_variant()
STREAM_BUREAU_BASE = """base AS (
  SELECT SK_ID_CURR, SK_ID_BUREAU, CREDIT_TYPE, CREDIT_ACTIVE, CREDIT_DAY_OVERDUE, CNT_CREDIT_PROLONG,
    AMT_CREDIT_MAX_OVERDUE, coalesce(AMT_CREDIT_SUM_OVERDUE, 0) AS AMT_CREDIT_SUM_OVERDUE,
    coalesce(AMT_CREDIT_SUM_DEBT, 0) AS AMT_CREDIT_SUM_DEBT,
    coalesce(AMT_CREDIT_SUM_LIMIT, 0) AS AMT_CREDIT_SUM_LIMIT,
    coalesce(AMT_CREDIT_SUM, 0) AS AMT_CREDIT_SUM
  FROM f_bureau)"""


def bureau_stream_sql(extra: str = "") -> str:
    body = f""", {_RECORD_RAW}, {STREAM_BUREAU_BASE}
SELECT {columns((S, "CAST(SK_ID_CURR AS VARCHAR)", "SK_ID_CURR"), *STREAM_BUREAU_COLUMNS)}
FROM base LEFT JOIN record USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR"""
    return with_views(["bureau", "bureau_balance"], "").rstrip() + body


def mart_bureau_sql() -> str:
    body = f""", {_RECORD_RAW}
SELECT {columns((I, "SK_ID_CURR", "SK_ID_CURR"), *_RISK, *_ADVANCED, *_HISTORY)}
FROM f_bureau LEFT JOIN record USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR"""
    return with_views(["bureau", "bureau_balance"], "").rstrip() + body


def _simple(views: list[str], keys: list[str], specs: list, source: str) -> str:
    select = columns(*[(I, k, k) for k in keys], *specs)
    return with_views(views, f"SELECT {select} FROM {source} GROUP BY {', '.join(keys)}")


# --- cards ------------------------------------------------------------------

_USED = "AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0)"
_HIGH = f"AMT_CREDIT_LIMIT_ACTUAL > 0 AND {_USED} > 0.8::DOUBLE"
_CARDS = [
    (I, "count(*)", "CC_MONTHS_COUNT"),
    (I, "count(DISTINCT SK_ID_PREV)", "CC_CARDS_COUNT"),
    (D, f"avg({_USED})", "CC_UTILIZATION_MEAN"),
    (D, f"max({_USED})", "CC_UTILIZATION_MAX"),
    (D, f"stddev_samp({_USED})", "CC_UTILIZATION_STD"),
    (I, n(_HIGH), "CC_HIGH_UTIL_MONTHS"),
    (I, n(f"AMT_CREDIT_LIMIT_ACTUAL > 0 AND {_USED} > 1"), "CC_OVER_LIMIT_MONTHS"),
    (D, pct(_HIGH), "CC_HIGH_UTIL_RATIO"),
    (D, "avg(AMT_PAYMENT_CURRENT / nullif(AMT_BALANCE, 0))", "CC_PAYMENT_RATIO_MEAN"),
    (D, "min(AMT_PAYMENT_CURRENT / nullif(AMT_BALANCE, 0))", "CC_PAYMENT_RATIO_MIN"),
    (D, "avg(AMT_PAYMENT_CURRENT / nullif(AMT_INST_MIN_REGULARITY, 0))", "CC_MIN_PAYMENT_RATIO"),
    (I, n("AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY"), "CC_UNDERPAY_MONTHS"),
    (D, pct("AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY"), "CC_UNDERPAY_RATIO"),
    (I, n("AMT_PAYMENT_CURRENT = 0"), "CC_NO_PAYMENT_MONTHS"),
    (D, pct("AMT_PAYMENT_CURRENT = 0"), "CC_NO_PAYMENT_RATIO"),
    (I, "sum(SK_DPD)", "CC_DPD_TOTAL"),
    (D, "avg(SK_DPD)", "CC_DPD_MEAN"),
    (I, "max(SK_DPD)", "CC_DPD_MAX"),
    (I, n("SK_DPD > 0"), "CC_DPD_MONTHS"),
    (I, n("SK_DPD >= 1 AND SK_DPD <= 30"), "CC_DPD_1_30_MONTHS"),
    (I, n("SK_DPD >= 31 AND SK_DPD <= 60"), "CC_DPD_31_60_MONTHS"),
    (I, n("SK_DPD > 60"), "CC_DPD_60PLUS_MONTHS"),
    (D, pct("SK_DPD > 0"), "CC_DPD_RATIO"),
    (D, pct("SK_DPD > 60"), "CC_SEVERE_DPD_RATIO"),
    (D, "sum(AMT_DRAWINGS_CURRENT)", "CC_TOTAL_DRAWINGS"),
    (D, "avg(AMT_DRAWINGS_CURRENT)", "CC_DRAWINGS_MEAN"),
    (D, "stddev_samp(AMT_DRAWINGS_CURRENT)", "CC_DRAWINGS_STD"),
    (D, "sum(AMT_DRAWINGS_ATM_CURRENT)", "CC_ATM_TOTAL"),
    (D, "sum(AMT_DRAWINGS_POS_CURRENT)", "CC_POS_TOTAL"),
    (D, "sum(AMT_DRAWINGS_OTHER_CURRENT)", "CC_OTHER_TOTAL"),
    (D, "sum(AMT_DRAWINGS_ATM_CURRENT) / nullif(sum(AMT_DRAWINGS_CURRENT), 0)", "CC_ATM_RATIO"),
    (D, "sum(AMT_DRAWINGS_POS_CURRENT) / nullif(sum(AMT_DRAWINGS_CURRENT), 0)", "CC_POS_RATIO"),
    (D, "avg(CNT_DRAWINGS_CURRENT)", "CC_TXN_FREQ_MEAN"),
    (I, "sum(CNT_DRAWINGS_ATM_CURRENT)", "CC_ATM_TXN_COUNT"),
    (I, "sum(CNT_DRAWINGS_POS_CURRENT)", "CC_POS_TXN_COUNT"),
    (I, "min(MONTHS_BALANCE)", "CC_EARLIEST_MONTH"),
    (I, "max(MONTHS_BALANCE)", "CC_LATEST_MONTH"),
    (I, n("AMT_DRAWINGS_CURRENT = 0"), "CC_INACTIVE_MONTHS"),
    (D, pct("AMT_DRAWINGS_CURRENT = 0"), "CC_INACTIVE_RATIO"),
    (D, "avg(AMT_CREDIT_LIMIT_ACTUAL)", "CC_LIMIT_MEAN"),
    (D, "max(AMT_CREDIT_LIMIT_ACTUAL)", "CC_LIMIT_MAX"),
    (D, "avg(AMT_BALANCE)", "CC_BALANCE_MEAN"),
    (D, "max(AMT_BALANCE)", "CC_BALANCE_MAX"),
    (D, "max(AMT_BALANCE) / nullif(max(AMT_CREDIT_LIMIT_ACTUAL), 0)", "CC_MAX_UTIL_EVER"),
]

# --- point of sale -----------------------------------------------------------

# Loan level, with the status counts taken per loan id alone and joined back.
_LOAN_CTES = """months AS (
  SELECT SK_ID_PREV, SK_ID_CURR, count(*) AS TOTAL_MONTHS_OBSERVED, max(SK_DPD) AS MAX_DPD, avg(SK_DPD) AS MEAN_DPD,
    max(SK_DPD_DEF) AS MAX_DPD_DEF, max(CNT_INSTALMENT) AS MAX_CNT_INSTALMENT,
    min(CNT_INSTALMENT_FUTURE) AS MIN_CNT_INSTALMENT_FUTURE,
    min(MONTHS_BALANCE) AS EARLIEST_MONTH, max(MONTHS_BALANCE) AS LATEST_MONTH
  FROM f_pos_cash_balance GROUP BY ALL),
tallies AS (
  SELECT SK_ID_PREV, sum((SK_DPD > 0)::INT) AS late, sum((SK_DPD > 7)::INT) AS late7, sum((SK_DPD > 30)::INT) AS late30,
    sum((NAME_CONTRACT_STATUS = 'Active')::INT) AS active, sum((NAME_CONTRACT_STATUS = 'Completed')::INT) AS completed,
    sum((NAME_CONTRACT_STATUS = 'Demand')::INT) AS demand
  FROM f_pos_cash_balance GROUP BY ALL),
loan AS (
  SELECT months.*, coalesce(late, 0) AS MONTHS_DPD_POSITIVE, coalesce(late7, 0) AS MONTHS_DPD_7PLUS,
    coalesce(late30, 0) AS MONTHS_DPD_30PLUS, coalesce(active, 0) AS MONTHS_ACTIVE,
    coalesce(completed, 0) AS MONTHS_COMPLETED, coalesce(demand, 0) AS MONTHS_DEMAND,
    CASE WHEN MAX_CNT_INSTALMENT > 0 THEN 1 - MIN_CNT_INSTALMENT_FUTURE / MAX_CNT_INSTALMENT ELSE 0 END
      AS REPAYMENT_PROGRESS_RATIO,
    late / TOTAL_MONTHS_OBSERVED AS DPD_RATE, late7 / TOTAL_MONTHS_OBSERVED AS DPD_7PLUS_RATE,
    late30 / TOTAL_MONTHS_OBSERVED AS DPD_30PLUS_RATE, active / TOTAL_MONTHS_OBSERVED AS ACTIVE_RATE,
    completed / TOTAL_MONTHS_OBSERVED AS COMPLETED_RATE, demand / TOTAL_MONTHS_OBSERVED AS DEMAND_RATE,
    (demand > 0)::INT AS EVER_DEMAND, (MAX_DPD > 30)::INT AS SEVERE_DPD_FLAG, (demand > 0)::INT AS IS_PROBLEM_LOAN
  FROM months LEFT JOIN tallies USING (SK_ID_PREV))"""
# Columns by type.
_LOAN_INTS = [
    "SK_ID_PREV",
    "SK_ID_CURR",
    "TOTAL_MONTHS_OBSERVED",
    "MAX_DPD",
    "MAX_DPD_DEF",
    "EARLIEST_MONTH",
    "LATEST_MONTH",
    "MONTHS_DPD_POSITIVE",
    "MONTHS_DPD_7PLUS",
    "MONTHS_DPD_30PLUS",
    "MONTHS_ACTIVE",
    "MONTHS_COMPLETED",
    "MONTHS_DEMAND",
    "EVER_DEMAND",
    "SEVERE_DPD_FLAG",
    "IS_PROBLEM_LOAN",
]
_LOAN_DOUBLES = [
    "MEAN_DPD",
    "MAX_CNT_INSTALMENT",
    "MIN_CNT_INSTALMENT_FUTURE",
    "REPAYMENT_PROGRESS_RATIO",
    "DPD_RATE",
    "DPD_7PLUS_RATE",
    "DPD_30PLUS_RATE",
    "ACTIVE_RATE",
    "COMPLETED_RATE",
    "DEMAND_RATE",
]
_POS = [
    (I, "count(*)", "POS_COUNT_LOANS_TOTAL"),
    (I, "sum(IS_PROBLEM_LOAN)", "POS_COUNT_PROBLEM_LOANS"),
    (I, "sum(EVER_DEMAND)", "POS_COUNT_LOANS_DEMAND"),
    (D, "avg(MAX_DPD)", "POS_MEAN_MAX_DPD"),
    (I, "max(MAX_DPD)", "POS_MAX_MAX_DPD"),
    (I, "min(MAX_DPD)", "POS_MIN_MAX_DPD"),
    (D, "avg(MEAN_DPD)", "POS_MEAN_MEAN_DPD"),
    (D, "avg(DPD_RATE)", "POS_MEAN_DPD_RATE"),
    (D, "max(DPD_RATE)", "POS_MAX_DPD_RATE"),
    (D, "avg(DPD_7PLUS_RATE)", "POS_MEAN_DPD_7PLUS_RATE"),
    (D, "max(DPD_7PLUS_RATE)", "POS_MAX_DPD_7PLUS_RATE"),
    (D, "avg(DPD_30PLUS_RATE)", "POS_MEAN_DPD_30PLUS_RATE"),
    (D, "max(DPD_30PLUS_RATE)", "POS_MAX_DPD_30PLUS_RATE"),
    (D, "avg(REPAYMENT_PROGRESS_RATIO)", "POS_MEAN_REPAYMENT_PROGRESS"),
    (D, "max(REPAYMENT_PROGRESS_RATIO)", "POS_MAX_REPAYMENT_PROGRESS"),
    (D, "min(REPAYMENT_PROGRESS_RATIO)", "POS_MIN_REPAYMENT_PROGRESS"),
    (D, "avg(MAX_CNT_INSTALMENT)", "POS_MEAN_CONTRACT_LENGTH"),
    (D, "max(MAX_CNT_INSTALMENT)", "POS_MAX_CONTRACT_LENGTH"),
    (D, "min(MAX_CNT_INSTALMENT)", "POS_MIN_CONTRACT_LENGTH"),
    (D, "avg(COMPLETED_RATE)", "POS_MEAN_COMPLETED_RATE"),
    (D, "avg(ACTIVE_RATE)", "POS_MEAN_ACTIVE_RATE"),
    (D, "avg(DEMAND_RATE)", "POS_MEAN_DEMAND_RATE"),
    (I, "max(EVER_DEMAND)", "POS_FLAG_ANY_DEMAND"),
    (I, "max(SEVERE_DPD_FLAG)", "POS_FLAG_ANY_SEVERE_DPD"),
    (I, "sum(TOTAL_MONTHS_OBSERVED)", "POS_TOTAL_MONTHS_OBSERVED"),
    (I, "min(EARLIEST_MONTH)", "POS_EARLIEST_MONTH"),
    (I, "max(LATEST_MONTH)", "POS_LATEST_MONTH"),
    (D, "sum(IS_PROBLEM_LOAN) / count(*)", "POS_RATIO_PROBLEM_LOANS"),
    (D, "sum(EVER_DEMAND) / count(*)", "POS_RATIO_LOANS_DEMAND"),
    (I, "max(LATEST_MONTH) - min(EARLIEST_MONTH)", "POS_OBSERVATION_SPAN_MONTHS"),
    (
        S,
        "CASE WHEN max(MAX_DPD) > 90 THEN 'HIGH_RISK' WHEN max(EVER_DEMAND) = 1 OR max(MAX_DPD) > 30 THEN 'MEDIUM_RISK' "
        "WHEN avg(DPD_RATE) > 0.05 THEN 'LOW_MEDIUM_RISK' ELSE 'LOW_RISK' END",
        "POS_RISK_SEGMENT",
    ),
]

# --- previous applications ----------------------------------------------------


def _is(column: str, value: str) -> str:
    return f"{column} = '{value}'"


def _spread(prefix: str, expression: str, kinds: str) -> list[tuple[str, str, str]]:
    functions = {"TOTAL": "sum", "MEAN": "avg", "MAX": "max", "MIN": "min", "STD": "stddev_samp"}
    return [(D, f"{functions[k]}({expression})", f"{prefix}_{k}") for k in kinds.split()]


_ST, _KIND, _PF = "NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "NAME_PORTFOLIO"
_PREVIOUS = [
    (I, "count(*)", "PREV_APP_COUNT"),
    (I, "count(DISTINCT SK_ID_PREV)", "PREV_UNIQUE_APP_COUNT"),
    (I, n(_is(_ST, "Approved")), "PREV_APPROVED_COUNT"),
    (I, n(_is(_ST, "Refused")), "PREV_REFUSED_COUNT"),
    (I, n(_is(_ST, "Canceled")), "PREV_CANCELED_COUNT"),
    (D, pct(_is(_ST, "Approved")), "PREV_APPROVAL_RATE"),
    (D, pct(_is(_ST, "Refused")), "PREV_REFUSAL_RATE"),
    (D, pct(_is(_ST, "Canceled")), "PREV_CANCEL_RATE"),
    *_spread("PREV_AMT_APPLICATION", "AMT_APPLICATION", "TOTAL MEAN MAX STD"),
    *_spread("PREV_AMT_CREDIT", "AMT_CREDIT", "TOTAL MEAN MAX STD"),
    *_spread("PREV_CREDIT_TO_APP_RATIO", "AMT_CREDIT / nullif(AMT_APPLICATION, 0)", "MEAN MIN MAX STD"),
    (I, n("AMT_CREDIT > AMT_APPLICATION"), "PREV_OVER_APPROVED_COUNT"),
    (I, n("AMT_CREDIT < AMT_APPLICATION"), "PREV_UNDER_APPROVED_COUNT"),
    (D, pct("AMT_CREDIT > AMT_APPLICATION"), "PREV_OVER_APPROVAL_RATIO"),
    *_spread("PREV_ANNUITY", "AMT_ANNUITY", "MEAN MAX STD"),
    (D, "avg(AMT_ANNUITY / nullif(AMT_CREDIT, 0))", "PREV_ANNUITY_TO_CREDIT_RATIO"),
    *_spread("PREV_DOWN_PAYMENT", "AMT_DOWN_PAYMENT", "TOTAL MEAN MAX"),
    (I, n("AMT_DOWN_PAYMENT > 0"), "PREV_WITH_DOWN_PAYMENT_COUNT"),
    (D, pct("AMT_DOWN_PAYMENT > 0"), "PREV_DOWN_PAYMENT_RATIO"),
    (D, "avg(RATE_DOWN_PAYMENT)", "PREV_DOWN_PAYMENT_RATE_MEAN"),
    *_spread("PREV_INTEREST_RATE", "RATE_INTEREST_PRIMARY", "MEAN MAX MIN STD"),
    *_spread("PREV_DAYS_DECISION", "DAYS_DECISION", "MEAN MIN MAX STD"),
    *[(I, n(f"DAYS_DECISION > {d}"), f"PREV_APPS_LAST_{w}") for w, d in (("30D", -30), ("90D", -90), ("1Y", -365), ("2Y", -730))],
    *[
        (I, n(f"DAYS_DECISION > {d} AND {_is(_ST, 'Approved')}"), f"PREV_RECENT_APPROVED_{w}")
        for w, d in (("1Y", -365), ("90D", -90))
    ],
    (I, n(_is(_KIND, "Cash loans")), "PREV_CASH_LOAN_COUNT"),
    (I, n(_is(_KIND, "Consumer loans")), "PREV_CONSUMER_LOAN_COUNT"),
    (I, n(_is(_KIND, "Revolving loans")), "PREV_REVOLVING_LOAN_COUNT"),
    (D, pct(_is(_KIND, "Cash loans")), "PREV_CASH_LOAN_RATIO"),
    (I, f"count(DISTINCT {_PF})", "PREV_PORTFOLIO_DIVERSITY"),
    (I, n(_is(_PF, "Cash")), "PREV_CASH_PORTFOLIO_COUNT"),
    (I, n(_is(_PF, "POS")), "PREV_POS_PORTFOLIO_COUNT"),
    (I, n(_is(_PF, "Cards")), "PREV_CARDS_PORTFOLIO_COUNT"),
    (D, pct(_is(_PF, "Cash")), "PREV_CASH_PORTFOLIO_RATIO"),
    (I, n(_is("NAME_CLIENT_TYPE", "Repeater")), "PREV_REPEATER_APP_COUNT"),
    (I, n(_is("NAME_CLIENT_TYPE", "New")), "PREV_NEW_CLIENT_APP_COUNT"),
    (D, pct(_is("NAME_CLIENT_TYPE", "Repeater")), "PREV_REPEATER_RATIO"),
    (I, "count(DISTINCT CHANNEL_TYPE)", "PREV_CHANNEL_DIVERSITY"),
    (I, "count(DISTINCT NAME_PAYMENT_TYPE)", "PREV_PAYMENT_TYPE_DIVERSITY"),
    (I, n(_is("NAME_PAYMENT_TYPE", "Cash through the bank")), "PREV_BANK_PAYMENT_COUNT"),
    (I, "count(DISTINCT NAME_GOODS_CATEGORY)", "PREV_GOODS_DIVERSITY"),
    (I, "count(DISTINCT NAME_CASH_LOAN_PURPOSE)", "PREV_PURPOSE_DIVERSITY"),
    (I, n("NFLAG_LAST_APPL_IN_DAY = 0"), "PREV_MULTIPLE_SAME_DAY_COUNT"),
    (D, "avg(NFLAG_INSURED_ON_APPROVAL)", "PREV_INSURANCE_RATIO"),
    (I, n(_is("NAME_YIELD_GROUP", "high")), "PREV_HIGH_YIELD_COUNT"),
    (I, n(_is("NAME_YIELD_GROUP", "low_action")), "PREV_LOW_ACTION_COUNT"),
    (I, n(_is("NAME_YIELD_GROUP", "middle")), "PREV_MIDDLE_YIELD_COUNT"),
    *[(I, n(_is("CODE_REJECT_REASON", r)), f"PREV_{r}_REJECT_COUNT") for r in ("HC", "LIMIT", "SCO", "CLIENT")],
    *_spread("PREV_PAYMENT_TERMS", "CNT_PAYMENT", "MEAN MAX MIN STD"),
    *_spread("PREV_GOODS_PRICE", "AMT_GOODS_PRICE", "MEAN MAX"),
    (D, "avg(AMT_GOODS_PRICE / nullif(AMT_CREDIT, 0))", "PREV_GOODS_TO_CREDIT_RATIO"),
]

_PV = ["previous_application"]
_LINKAGE = [
    (I, "count(*)", "PREV_APP_COUNT"),
    (I, n(_is(_ST, "Approved")), "PREV_APPROVED_COUNT"),
    (D, pct(_is(_ST, "Approved")), "PREV_APPROVAL_RATE"),
    *[(I, n(f"{_is(_ST, 'Approved')} AND {_is(_PF, p)}"), f"PREV_APPROVED_{p.upper()}_COUNT") for p in ("POS", "Cash", "Cards")],
    (I, n(f"{_is(_ST, 'Approved')} AND DAYS_DECISION > -365"), "PREV_RECENT_APPROVED_COUNT"),
    (D, f"max(AMT_CREDIT) FILTER (WHERE {_is(_ST, 'Approved')})", "PREV_LAST_APPROVED_AMOUNT"),
    (D, f"min(DAYS_DECISION) FILTER (WHERE {_is(_ST, 'Approved')})", "PREV_LAST_APPROVED_DAYS"),
]
_HIGH_IMPACT = [
    (I, "count(*)", "PREV_APP_COUNT"),
    (D, pct(_is(_ST, "Approved")), "PREV_APPROVAL_RATE"),
    (D, pct(_is(_ST, "Refused")), "PREV_REFUSAL_RATE"),
    (D, "avg(AMT_CREDIT / nullif(AMT_APPLICATION, 0))", "PREV_APPROVAL_RATIO_MEAN"),
    (D, "sum(AMT_CREDIT)", "PREV_TOTAL_CREDIT_HISTORY"),
    (D, "sum(AMT_APPLICATION)", "PREV_TOTAL_REQUESTED_HISTORY"),
    (I, n(_is("CODE_REJECT_REASON", "HC")), "PREV_HIGH_RISK_REJECTS"),
    (I, n("RATE_INTEREST_PRIMARY > 0.2::DOUBLE"), "PREV_HIGH_INTEREST_COUNT"),
    (I, n("coalesce(AMT_DOWN_PAYMENT, 0) = 0"), "PREV_NO_DOWN_PAYMENT_COUNT"),
    (I, n(_is("NAME_CLIENT_TYPE", "Repeater")), "PREV_REPEAT_CUSTOMER_APPS"),
    (I, f"count(DISTINCT coalesce({_PF}, '(none)'))", "PREV_PRODUCT_DIVERSITY"),
    (D, "min(DAYS_DECISION)", "PREV_MOST_RECENT_APP_DAYS"),
    (I, n("DAYS_DECISION > -90"), "PREV_APPS_LAST_90_DAYS"),
    (I, n("DAYS_DECISION > -365"), "PREV_APPS_LAST_YEAR"),
]


def pos_sql(loan_level: bool) -> str:
    head = with_views(["pos_cash_balance"], "").rstrip() + ", " + _LOAN_CTES
    if loan_level:
        return f"{head}\nSELECT {passthrough(_LOAN_DOUBLES, _LOAN_INTS)} FROM loan"
    return f"{head}\nSELECT {columns((I, 'SK_ID_CURR', 'SK_ID_CURR'), *_POS)} FROM loan GROUP BY SK_ID_CURR"


_KEYED = ["SK_ID_CURR"]
MARTS = {
    "bureau_risk": _simple(["bureau"], _KEYED, _RISK, "f_bureau"),
    "bureau_advanced": _simple(["bureau"], _KEYED, _ADVANCED, "f_bureau"),
    "bureau_balance_agg": _simple(["bureau_balance"], ["SK_ID_BUREAU"], _PER_RECORD, "f_bureau_balance"),
    "bureau_balance_client": with_views(["bureau", "bureau_balance"], "").rstrip()
    + f", {_RECORD_RAW}\nSELECT {columns((I, 'SK_ID_CURR', 'SK_ID_CURR'), *_HISTORY)} "
    "FROM f_bureau LEFT JOIN record USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR",
    "mart_bureau_features": mart_bureau_sql(),
    "mart_credit_card_balance": _simple(["credit_card_balance"], _KEYED, _CARDS, "f_credit_card_balance"),
    "pos_loan_level": pos_sql(loan_level=True),
    "mart_pos_cash_balance": pos_sql(loan_level=False),
    "mart_previous_application": _simple(_PV, _KEYED, _PREVIOUS, "f_previous_application"),
    "prev_linkage": _simple(_PV, _KEYED, _LINKAGE, "f_previous_application"),
    "prev_approved_loans": with_views(_PV, "SELECT SK_ID_CURR, SK_ID_PREV FROM f_previous_application WHERE NAME_CONTRACT_STATUS = 'Approved'"),
    "prev_high_impact": _simple(_PV, _KEYED, _HIGH_IMPACT, "f_previous_application"),
}

# Column lists by kind, for texts that only pass mart columns through.
MART_COLUMNS = {"bureau": _RISK + _ADVANCED + _HISTORY, "cards": _CARDS, "pos": _POS, "previous": _PREVIOUS}

_STAGING = """SELECT SK_ID_CURR AS application_id, TARGET AS is_default, AMT_CREDIT AS loan_amount,
  round(AMT_ANNUITY, 6) AS annuity_amount, AMT_GOODS_PRICE AS goods_price, round(AMT_INCOME_TOTAL, 6) AS total_income,
  EXT_SOURCE_1 AS external_score_1, EXT_SOURCE_2 AS external_score_2, EXT_SOURCE_3 AS external_score_3,
  DAYS_BIRTH AS days_birth, DAYS_EMPLOYED AS days_employed, DAYS_ID_PUBLISH AS days_id_published,
  CNT_CHILDREN AS children_count, CODE_GENDER AS gender, NAME_EDUCATION_TYPE AS education_type,
  NAME_FAMILY_STATUS AS family_status, NAME_INCOME_TYPE AS income_type, ORGANIZATION_TYPE AS organization_type,
  REGION_POPULATION_RELATIVE AS region_population_relative,
  round(-DAYS_BIRTH / 365.25::DOUBLE, 1) AS age_years,
  CASE WHEN AMT_INCOME_TOTAL > 0 THEN round(AMT_CREDIT / AMT_INCOME_TOTAL, 2) END AS credit_income_ratio,
  CAST(EXT_SOURCE_1 IS NULL AND EXT_SOURCE_2 IS NULL AND EXT_SOURCE_3 IS NULL AS BIGINT) AS missing_all_external_scores
FROM f_application_train WHERE AMT_CREDIT > 0"""
_APP_DOUBLES = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"]
# Columns by type.
APP_INTS = [
    "SK_ID_CURR",
    "CNT_CHILDREN",
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
] + [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
APP_TEXTS = [
    "NAME_CONTRACT_TYPE",
    "NAME_INCOME_TYPE",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
    "NAME_HOUSING_TYPE",
    "OCCUPATION_TYPE",
    "ORGANIZATION_TYPE",
]
_AT = ["application_train"]
# Numeric columns of the card table.
_CARD_NUMBERS = [
    "SK_ID_PREV",
    "MONTHS_BALANCE",
    "AMT_BALANCE",
    "AMT_CREDIT_LIMIT_ACTUAL",
    "AMT_PAYMENT_CURRENT",
    "AMT_INST_MIN_REGULARITY",
    "SK_DPD",
    "AMT_DRAWINGS_CURRENT",
    "AMT_DRAWINGS_ATM_CURRENT",
    "AMT_DRAWINGS_POS_CURRENT",
    "AMT_DRAWINGS_OTHER_CURRENT",
    "CNT_DRAWINGS_CURRENT",
    "CNT_DRAWINGS_ATM_CURRENT",
    "CNT_DRAWINGS_POS_CURRENT",
]
CARD_AVERAGES = [(D, f"avg({c})", f"cc_avg_{c}") for c in _CARD_NUMBERS]
MARTS |= {
    "mart_application": with_views(
        _AT, f"SELECT {passthrough(_APP_DOUBLES, APP_INTS, APP_TEXTS)} FROM f_application_train"
    ),
    "mart_application_train": with_views(_AT, "SELECT SK_ID_CURR, TARGET FROM f_application_train"),
    "stg_application": with_views(_AT, _STAGING),
    "select_not_null": with_views(
        _AT, "SELECT coalesce(SK_ID_CURR, 0) AS SK_ID_CURR, AMT_ANNUITY, NAME_EDUCATION_TYPE FROM f_application_train"
    ),
    "cc_dynamic_avg": _simple(["credit_card_balance"], _KEYED, CARD_AVERAGES, "f_credit_card_balance"),
}
