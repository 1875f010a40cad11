"""DuckDB texts for data quality, preparation and evaluation."""

from __future__ import annotations

from riskloom.operators.prepare import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from riskloom.plans.oracle_marts import (
    APP_INTS,
    APP_TEXTS,
    CARD_AVERAGES,
    D,
    I,
    MART_COLUMNS,
    MARTS,
    S,
    _APP_DOUBLES,
    _CARDS,
    _LOAN_CTES,
    _RECORD_RAW,
    columns,
    passthrough,
)
from riskloom.sources.domain import with_views

_AT = ["application_train"]


def _app(body: str) -> str:
    return with_views(_AT, body)


def _r(expression: str, name: str) -> str:
    return columns((D, expression, name))


# --- assembled data -------------------------------------------------------------

_ALL = ["application_train", "bureau", "bureau_balance", "credit_card_balance", "pos_cash_balance", "previous_application"]
_MART_CTES = f""", {_RECORD_RAW}, {_LOAN_CTES},
mb AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["bureau"])} FROM f_bureau LEFT JOIN record USING (SK_ID_BUREAU)
  GROUP BY SK_ID_CURR),
mc AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["cards"])} FROM f_credit_card_balance GROUP BY SK_ID_CURR),
mp AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["pos"])} FROM loan GROUP BY SK_ID_CURR),
mv AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["previous"])} FROM f_previous_application GROUP BY SK_ID_CURR),
a AS (SELECT {passthrough([*_APP_DOUBLES, "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"], [*APP_INTS, "TARGET"], [*APP_TEXTS, "CODE_GENDER"])}
  FROM f_application_train),
whole AS (SELECT * FROM a LEFT JOIN mp USING (SK_ID_CURR) LEFT JOIN mb USING (SK_ID_CURR) LEFT JOIN mc USING (SK_ID_CURR)
  LEFT JOIN mv USING (SK_ID_CURR))
"""


def _whole(body: str) -> str:
    return with_views(_ALL, _MART_CTES + body)


_ZERO = ["PREV_ANNUITY_MEAN"]

_IMPUTED = ", ".join(
    [_r(f"coalesce({c}, 0)" if c in _ZERO else f"coalesce({c}, (SELECT median({c}) FROM whole))", c) for c in NUMERIC_FEATURES]
    + [
        f"coalesce({c}, (SELECT {c} FROM whole WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS {c}"
        for c in CATEGORICAL_FEATURES
    ]
)

# --- data quality ------------------------------------------------------------------

_STAGE = MARTS["stg_application"]


def _tests(kind: str, tests: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{kind}' AS test, '{c}' AS \"column\", count(*) FILTER (WHERE {bad}) AS failures FROM stage" for c, bad in tests]
    return f"WITH stage AS ({_STAGE}) " + " UNION ALL ".join(parts)


def _unique(source: str, table: str, key: str) -> str:
    return (
        f"SELECT 'unique' AS test, '{key}' AS \"column\", count(*) AS failures, '{source}' AS source "
        f"FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    )


# Columns of the training table.
_TRAIN_COLUMNS = [
    "SK_ID_CURR",
    "TARGET",
    "CODE_GENDER",
    "CNT_CHILDREN",
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_GOODS_PRICE",
    "NAME_CONTRACT_TYPE",
    "NAME_INCOME_TYPE",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
    "ORGANIZATION_TYPE",
    "DAYS_BIRTH",
    "DAYS_EMPLOYED",
    "EXT_SOURCE_1",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
    "NAME_HOUSING_TYPE",
    "OCCUPATION_TYPE",
    "FLAG_MOBIL",
    "FLAG_EMP_PHONE",
    "FLAG_WORK_PHONE",
    "FLAG_PHONE",
    "FLAG_EMAIL",
    "FLAG_OWN_CAR",
    "FLAG_OWN_REALTY",
    "OWN_CAR_AGE",
    "DAYS_ID_PUBLISH",
    "REGION_POPULATION_RELATIVE",
] + [f"FLAG_DOCUMENT_{n}" for n in range(2, 22)]
_TRAIN_TEXTS = [c for c in _TRAIN_COLUMNS if c.startswith("NAME_") or c in ("CODE_GENDER", "ORGANIZATION_TYPE", "OCCUPATION_TYPE")]
_TRAIN_NUMBERS = [c for c in _TRAIN_COLUMNS if c not in _TRAIN_TEXTS and c not in ("SK_ID_CURR", "TARGET")]

_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 4) AS missing_proportion FROM f_application_train"
    for c in _TRAIN_COLUMNS
)


def _correlation(names: list[str], table: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(TARGET, {c}) AS r, avg(({c} IS NULL)::INT) AS missing_rate FROM {table} "
        f"HAVING stddev_pop({c}) > 0"
        for c in names
    )
    return f"SELECT * FROM ({parts}) WHERE r IS NOT NULL AND NOT isnan(r)"


_DEVIATION = (
    ", v AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, TARGET FROM f_application_train" for c in _TRAIN_TEXTS)
    + """), g AS (SELECT feature, value, count(*) AS c, avg(TARGET) AS rate FROM v GROUP BY ALL)
SELECT feature, round(max(abs(rate - (SELECT avg(TARGET) FROM f_application_train))) FILTER (WHERE c > 100), 6) AS max_deviation,
  count(*) FILTER (WHERE c > 100) AS n_categories, round(coalesce(sum(c) FILTER (WHERE value IS NULL), 0) / sum(c), 6) AS missing_rate
FROM g GROUP BY feature HAVING count(*) FILTER (WHERE c > 100) > 1
  AND coalesce(sum(c) FILTER (WHERE value IS NULL), 0) / sum(c) < 0.8"""
)

_IMPORTANCE = f", i AS (SELECT feature, abs(r) * 10 AS importance FROM ({_correlation(_TRAIN_NUMBERS, 'f_application_train')}))"
_CORE = (
    "'AMT_INCOME_TOTAL', 'AMT_CREDIT', 'AMT_ANNUITY', 'AMT_GOODS_PRICE', 'DAYS_BIRTH', 'DAYS_EMPLOYED', 'CNT_CHILDREN', "
    "'CODE_GENDER', 'NAME_INCOME_TYPE', 'NAME_EDUCATION_TYPE'"
)
_CORE_FEATURES = (
    "'AMT_CREDIT', 'AMT_INCOME_TOTAL', 'AMT_ANNUITY', 'DAYS_BIRTH', 'DAYS_EMPLOYED', 'CODE_GENDER', 'CNT_CHILDREN', "
    "'NAME_EDUCATION_TYPE', 'NAME_FAMILY_STATUS', 'OCCUPATION_TYPE', 'ORGANIZATION_TYPE', 'EMPLOYMENT_START_DATE'"
)
_PSI = """, cut AS (SELECT i, (SELECT quantile_cont(EXT_SOURCE_2, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
    FROM f_application_train)[i] AS q FROM range(1, 10) t(i)),
u AS (SELECT EXT_SOURCE_2 AS v, 1 AS b, 0 AS c FROM f_application_train WHERE EXT_SOURCE_2 IS NOT NULL
  UNION ALL SELECT EXT_SOURCE_2, 0, 1 FROM f_application_test WHERE EXT_SOURCE_2 IS NOT NULL),
binned AS (SELECT (SELECT count(*) FROM cut WHERE q < v) AS bin, sum(b) AS b, sum(c) AS c FROM u GROUP BY 1),
shares AS (SELECT greatest(b / (SELECT sum(b) FROM binned), 0.0001) AS sb,
  greatest(c / (SELECT sum(c) FROM binned), 0.0001) AS sc FROM binned)
SELECT round(sum((sc - sb) * ln(sc / sb)), 6) AS psi, CAST(sum((sc - sb) * ln(sc / sb)) > 0.2 AS BIGINT) AS drifted FROM shares"""
_KS = """, u AS (SELECT EXT_SOURCE_2 AS v, 1 AS b, 0 AS c FROM f_application_train WHERE EXT_SOURCE_2 IS NOT NULL
  UNION ALL SELECT EXT_SOURCE_2, 0, 1 FROM f_application_test WHERE EXT_SOURCE_2 IS NOT NULL),
w AS (SELECT v, sum(sum(b)) OVER (ORDER BY v) / sum(sum(b)) OVER () AS fb, sum(sum(c)) OVER (ORDER BY v) / sum(sum(c)) OVER () AS fc
  FROM u GROUP BY v)
SELECT round(max(abs(fb - fc)), 6) AS ks FROM w"""

# --- evaluation ---------------------------------------------------------------------


def _curve(score: str = "P_A", name: str = "k") -> str:
    """Cumulative counts by descending score."""
    return f"""{name} AS (
  SELECT {score} AS s, sum(TARGET) AS pos, count(*) - sum(TARGET) AS neg,
    sum(sum(TARGET)) OVER (ORDER BY {score} DESC) AS tp, sum(count(*) - sum(TARGET)) OVER (ORDER BY {score} DESC) AS fp,
    sum(sum(TARGET)) OVER () AS p, sum(count(*) - sum(TARGET)) OVER () AS n FROM f_scores GROUP BY {score})"""


def _auc(score: str, source: str) -> str:
    """Mean over all (positive, negative) pairs, ties half, by average ranks."""
    return f"""(SELECT (sum(r) FILTER (WHERE TARGET = 1) - sum(TARGET) * (sum(TARGET) + 1) / 2) / (sum(TARGET) * (count(*) - sum(TARGET)))
  FROM (SELECT TARGET, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2 AS r FROM {source}))"""


def _best(score: str) -> str:
    """Threshold with the highest F1, the lowest on ties."""
    return f"""(SELECT s FROM (SELECT s, tp / (tp + fp) AS pr, tp / p AS rc FROM (SELECT {score} AS s,
    sum(sum(TARGET)) OVER (ORDER BY {score} DESC) AS tp, sum(count(*) - sum(TARGET)) OVER (ORDER BY {score} DESC) AS fp,
    sum(sum(TARGET)) OVER () AS p FROM f_scores GROUP BY {score})) ORDER BY 2 * (pr * rc) / (pr + rc + 1e-8) DESC, s LIMIT 1)"""


def _scores(body: str) -> str:
    return with_views(["scores"], body)


_VOTES = " + ".join(f"(P_{m} >= {_best('P_' + m)})::INT" for m in "ABC")
_RANKS = ", ".join(f"row_number() OVER (ORDER BY P_{m}, SK_ID_CURR) - 1 AS r{m}" for m in "ABC")
_MEAN = "(P_A + P_B + P_C) / 3"
_WEIGHTED_CTE = f""", w AS (SELECT {_auc('P_A', 'f_scores')} AS a, {_auc('P_B', 'f_scores')} AS b, {_auc('P_C', 'f_scores')} AS c)"""
_WEIGHTED = "P_A * (a / (a + b + c)) + P_B * (b / (a + b + c)) + P_C * (c / (a + b + c))"
_CLASSES = """, t AS (SELECT count(*) FILTER (WHERE TARGET = 1 AND P_A >= 0.3::DOUBLE) AS tp,
  count(*) FILTER (WHERE TARGET = 0 AND P_A >= 0.3::DOUBLE) AS fp, count(*) FILTER (WHERE TARGET = 1 AND P_A < 0.3::DOUBLE) AS fn,
  count(*) FILTER (WHERE TARGET = 0 AND P_A < 0.3::DOUBLE) AS tn FROM f_scores),
c AS (SELECT 'Repay' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, tn + fp AS n FROM t
  UNION ALL SELECT 'Default', tp / (tp + fp), tp / (tp + fn), tp + fn FROM t),
f AS (SELECT *, 2 * p * r / (p + r) AS f1 FROM c)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1_score, n AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(n)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * n) / sum(n), 6), round(sum(r * n) / sum(n), 6), round(sum(f1 * n) / sum(n), 6),
  sum(n)::BIGINT FROM f"""

_RISKY = ["CC_DPD_RATIO", "CC_SEVERE_DPD_RATIO", "CC_NO_PAYMENT_RATIO", "CC_HIGH_UTIL_RATIO"]


def _nearest(c: str, p: str) -> str:
    """Value at the nearest rank, half to even."""
    return (
        f"(SELECT {c} FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS i, count(*) OVER () AS n FROM mart "
        f"WHERE {c} IS NOT NULL) WHERE i = round_even({p}::DOUBLE * (n - 1), 0) LIMIT 1)"
    )


_DISTRIBUTION = (
    with_views(["credit_card_balance"], "")
    + ", mart AS (SELECT SK_ID_CURR, "
    + ", ".join(f"{e} AS {name}" for _, e, name in _CARDS if name in _RISKY)
    + " FROM f_credit_card_balance GROUP BY SK_ID_CURR)\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {columns((D, f'avg({c})', 'mean'), (D, f'stddev_samp({c})', 'std'), (D, _nearest(c, '0.5'), 'median'), (D, _nearest(c, '0.95'), 'p95'))} FROM mart"
        for c in _RISKY
    )
)


def _clip_bound(c: str, p: str) -> str:
    return _nearest(c, p).replace("FROM mart", "FROM whole")


def _clipped(c: str) -> str:
    low, high = _clip_bound(c, "0.001"), _clip_bound(c, "0.999")
    return f"CASE WHEN {c} IS NOT NULL THEN CAST(greatest({low}, least({high}, {c})) AS DOUBLE) END AS {c}"


_FILL_VIEWS = ["application_train", "pos_cash_balance"]
_FILLED = f""", {_LOAN_CTES},
j AS (SELECT a.SK_ID_CURR, a.TARGET, m.* EXCLUDE (SK_ID_CURR) FROM f_application_train a LEFT JOIN (
  SELECT SK_ID_CURR, count(*) AS c, avg(DPD_RATE) AS r, max(LATEST_MONTH) AS l,
    CASE WHEN max(MAX_DPD) > 90 THEN 'HIGH_RISK' WHEN max(EVER_DEMAND) = 1 OR max(MAX_DPD) > 30 THEN 'MEDIUM_RISK'
      WHEN avg(DPD_RATE) > 0.05 THEN 'LOW_MEDIUM_RISK' ELSE 'LOW_RISK' END AS s
  FROM loan GROUP BY 1) m USING (SK_ID_CURR))
SELECT SK_ID_CURR, TARGET, coalesce(c, 0) AS POS_COUNT_LOANS_TOTAL, {columns((D, "coalesce(r, (SELECT median(r) FROM j), 0)", "POS_MEAN_DPD_RATE"))},
  coalesce(l, 0) AS POS_LATEST_MONTH, coalesce(s, 'NEW_CUSTOMER') AS POS_RISK_SEGMENT FROM j"""


def _code(c: str, source: str, value: str | None = None) -> str:
    value = value or c
    return (
        f"coalesce((SELECT code FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {value} AS v "
        f"FROM {source}) WHERE v IS NOT NULL) d WHERE d.v = {'x.' + c if value == c else value.replace(c, 'x.' + c)}), -1) AS {c}"
    )


_EVERY_NUMBER = [*_APP_DOUBLES, "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", *APP_INTS] + [
    name for mart in ("pos", "bureau", "cards", "previous") for kind, _, name in MART_COLUMNS[mart] if kind in (I, D)
]

LEARNING = {
    "complete_dataset": _whole("SELECT * FROM whole"),
    "training_set_join": with_views(
        ["application_train", "credit_card_balance"],
        f""", cc AS (SELECT SK_ID_CURR, {columns(*CARD_AVERAGES)} FROM f_credit_card_balance GROUP BY 1)
SELECT {passthrough(_APP_DOUBLES, [*APP_INTS, "TARGET"], APP_TEXTS)}, cc.* EXCLUDE (SK_ID_CURR)
FROM f_application_train LEFT JOIN cc USING (SK_ID_CURR)""",
    ),
    "model_features": _whole(f"SELECT SK_ID_CURR, {', '.join(NUMERIC_FEATURES + CATEGORICAL_FEATURES)}, TARGET FROM whole"),
    "impute_features": _whole(f"SELECT SK_ID_CURR, TARGET, {_IMPUTED} FROM whole"),
    "feature_coverage": _whole(
        " UNION ALL ".join(f"SELECT '{c}' AS feature, {_r(f'count({c}) * 100 / count(*)', 'coverage')} FROM whole" for c in NUMERIC_FEATURES)
    ),
    "importance_by_family": _whole(
        f""", top AS (SELECT feature FROM ({_correlation(_EVERY_NUMBER, 'whole')}) ORDER BY round(abs(r) * 10, 9) DESC, feature LIMIT 20)
SELECT CASE WHEN feature LIKE 'BUREAU\\_%' ESCAPE '\\' THEN 'Bureau' WHEN contains(feature, 'POS_') OR contains(feature, 'PREV_')
  THEN 'POS' ELSE 'Application' END AS family, count(*) AS features, count(*) / (SELECT count(*) FROM top) AS share FROM top GROUP BY 1"""
    ),
    "dq_not_null": _tests(
        "not_null",
        [(c, f"{c} IS NULL") for c in ("application_id", "is_default", "loan_amount", "annuity_amount", "education_type")],
    ),
    "dq_accepted_values": _tests(
        "accepted_values",
        [
            ("is_default", "is_default NOT IN (0, 1)"),
            ("missing_all_external_scores", "missing_all_external_scores NOT IN (0, 1)"),
            ("income_type", "income_type NOT IN ('Working', 'Pensioner')"),
        ],
    ),
    "dq_expression": _tests(
        "expression_is_true",
        [
            ("loan_amount", "NOT loan_amount > 0"),
            ("age_years", "age_years < 18 OR age_years > 60"),
            ("credit_income_ratio", "credit_income_ratio > 10"),
        ],
    ),
    "dq_unique": with_views(
        ["application_train", "previous_application", "pos_cash_balance"],
        " UNION ALL ".join(
            [
                _unique("application", "f_application_train", "SK_ID_CURR"),
                _unique("previous", "f_previous_application", "SK_ID_PREV"),
                _unique("pos", "f_pos_cash_balance", "SK_ID_CURR"),
            ]
        ),
    ),
    "missing_summary": _app(_MISSING),
    "extreme_scan": _app(
        """, x AS (SELECT CASE WHEN EXT_SOURCE_1 = 0 THEN 'inf'::DOUBLE ELSE AMT_CREDIT / EXT_SOURCE_1 END AS a,
  AMT_CREDIT * 1e6 AS b FROM f_application_train),
y AS (SELECT 'CREDIT_TO_SCORE' AS feature, min(a) AS lo, max(a) AS hi, count(*) FILTER (WHERE isinf(a)) AS k FROM x
  UNION ALL SELECT 'CREDIT_MICROS', min(b), max(b), count(*) FILTER (WHERE isinf(b)) FROM x)
SELECT feature, round(lo, 6) AS "min", CASE WHEN isinf(hi) THEN hi ELSE round(hi, 6) END AS "max", k AS inf_count FROM y
WHERE k > 0 OR lo < -1e10 OR hi > 1e10"""
    ),
    "risk_distribution": _DISTRIBUTION,
    "feature_availability": _app(
        f"SELECT lower(f) AS name FROM (SELECT unnest({NUMERIC_FEATURES + CATEGORICAL_FEATURES}) AS f) "
        f"WHERE f NOT IN ({', '.join(repr(c) for c in [*_APP_DOUBLES, *APP_INTS, *APP_TEXTS])})"
    ),
    "target_correlation": _app(
        f"SELECT feature, {_r('abs(r)', 'correlation')}, {_r('r', 'raw_correlation')}, {_r('missing_rate', 'missing_rate')} "
        f"FROM ({_correlation(_TRAIN_NUMBERS, 'f_application_train')})"
    ),
    "categorical_deviation": _app(_DEVIATION),
    "grouped_missing": _app(
        """SELECT SK_ID_CURR, round(EXT_SOURCE_1, 6) AS SCORE_AVG, round(EXT_SOURCE_1 * 2, 6) AS SCORE_MODE,
  round(EXT_SOURCE_1 * 3, 6) AS SCORE_MEDI, OWN_CAR_AGE * 1.0::DOUBLE AS CAR_AVG, OWN_CAR_AGE * 2.0::DOUBLE AS CAR_MODE,
  OWN_CAR_AGE * 3.0::DOUBLE AS CAR_MEDI,
  round(coalesce(EXT_SOURCE_1, (SELECT median(EXT_SOURCE_1) FROM f_application_train)), 6) AS SCORE_CONSOLIDATED,
  CAST(OWN_CAR_AGE IS NOT NULL AS BIGINT) AS CAR_AVAILABLE FROM f_application_train"""
    ),
    "drift_psi": with_views(["application_train", "application_test"], _PSI),
    "drift_ks": with_views(["application_train", "application_test"], _KS),
    "clip_quantiles": _whole(f"SELECT SK_ID_CURR, {', '.join(_clipped(c) for c in NUMERIC_FEATURES)} FROM whole"),
    "smart_fill": with_views(_FILL_VIEWS, _FILLED),
    "ordinal_encode": _app(
        f""", placed AS (SELECT *, count(*) OVER (PARTITION BY TARGET) AS class_rows,
  row_number() OVER (PARTITION BY TARGET ORDER BY substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '|42'), 1, 8), SK_ID_CURR) AS place FROM f_application_train),
train AS (SELECT * FROM placed WHERE place > floor(0.2 * class_rows + 0.5))
SELECT SK_ID_CURR, {', '.join(_code(c, 'train') for c in CATEGORICAL_FEATURES)} FROM f_application_train x"""
    ),
    "label_encode": _app(
        "SELECT SK_ID_CURR, "
        + ", ".join(
            _code(c, "f_application_train", f"coalesce({c}, 'Unknown')") for c in ("NAME_EDUCATION_TYPE", "OCCUPATION_TYPE")
        )
        + " FROM f_application_train x"
    ),
    "stacking_folds": with_views(
        ["scores"],
        """SELECT (place - 1) % 5 AS fold, TARGET, count(*) AS rows, CAST(sum(SK_ID_CURR) AS BIGINT) AS key_sum FROM (SELECT TARGET, SK_ID_CURR,
  row_number() OVER (PARTITION BY TARGET ORDER BY substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '|42'), 1, 8), SK_ID_CURR) AS place FROM f_scores) GROUP BY 1, 2""",
    ),
    "stratified_split": _app(
        """SELECT CASE WHEN place <= floor(0.2 * class_rows + 0.5) THEN 'test' ELSE 'train' END AS split, TARGET, count(*) AS rows, CAST(sum(SK_ID_CURR) AS BIGINT) AS key_sum
FROM (SELECT TARGET, SK_ID_CURR, count(*) OVER (PARTITION BY TARGET) AS class_rows,
  row_number() OVER (PARTITION BY TARGET ORDER BY substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '|42'), 1, 8), SK_ID_CURR) AS place FROM f_application_train) GROUP BY 1, 2"""
    ),
    "class_weights": _app(
        """SELECT TARGET, round((SELECT count(*) FROM f_application_train) /
  ((SELECT count(DISTINCT TARGET) FROM f_application_train) * count(*)), 6) AS weight FROM f_application_train GROUP BY 1"""
    ),
    "class_balance": _app(
        """, c AS (SELECT TARGET, count(*) AS rows FROM f_application_train GROUP BY 1)
SELECT TARGET, rows, round(rows / (SELECT sum(rows) FROM c), 6) AS share,
  round((SELECT max(rows) / min(rows) FROM c), 6) AS imbalance_ratio FROM c"""
    ),
    "select_features": _app(
        f""", m AS ({_MISSING})
SELECT column_name AS feature, missing_proportion AS missing_rate,
  CASE WHEN column_name IN ({_CORE_FEATURES}) OR (column_name[:5] = 'FLAG_' AND missing_proportion < 0.1) THEN 'core'
    WHEN column_name IN ('EXT_SOURCE_1', 'EXT_SOURCE_2', 'EXT_SOURCE_3') THEN 'external' ELSE 'stable' END AS reason
FROM m WHERE column_name NOT IN ('SK_ID_CURR', 'TARGET') AND (column_name IN ({_CORE_FEATURES})
  OR (column_name[:5] = 'FLAG_' AND missing_proportion < 0.1)
  OR column_name[:10] = 'EXT_SOURCE' OR (missing_proportion < 0.05 AND NOT contains(column_name, 'DOCUMENT')))"""
    ),
    "importance_tiers": _app(
        f"""{_IMPORTANCE} SELECT feature, {_r('importance', 'importance')},
  CASE WHEN feature IN ({_CORE}) OR importance >= 1 THEN 'Tier 1 (Must-have)' WHEN importance >= 0.1 THEN 'Tier 2 (High-value)'
    WHEN importance >= 0.01 THEN 'Tier 3 (Medium-value)' WHEN importance >= 0.001 THEN 'Tier 4 (Low-value)'
    ELSE 'Tier 5 (Eliminate)' END AS tier FROM i"""
    ),
    "feature_set_choice": _scores(
        f""", x AS (SELECT TARGET, P_A / 1 AS m1, (P_A + P_B) / 2 AS m2, {_MEAN} AS m3 FROM f_scores),
z AS (SELECT 'first 1' AS feature_set, 1 AS features, {_auc('m1', 'x')} AS auc UNION ALL SELECT 'first 2', 2, {_auc('m2', 'x')}
  UNION ALL SELECT 'first 3', 3, {_auc('m3', 'x')})
SELECT feature_set, features::BIGINT AS features, round(auc, 6) AS auc FROM z WHERE auc >= 0.77 ORDER BY features LIMIT 1"""
    ),
    "metric_auc": _scores(f"SELECT round({_auc('P_A', 'f_scores')}, 6) AS auc"),
    "metric_roc_curve": _scores(
        f""", {_curve()}, e AS (SELECT *, lead(pos) OVER w AS np, lead(neg) OVER w AS nn, lag(pos) OVER w AS lp FROM k WINDOW w AS (ORDER BY s DESC))
SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT round(s, 6), round(fp / n, 6), round(tp / p, 6) FROM e WHERE np IS NULL OR lp IS NULL OR np <> pos OR nn <> neg"""
    ),
    "metric_pr_curve": _scores(
        f""", {_curve()} SELECT round(s, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM k
UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE"""
    ),
    "metric_average_precision": _scores(
        f", {_curve()} SELECT round(sum(pos / p * (tp / (tp + fp))), 6) AS average_precision FROM k"
    ),
    "optimal_threshold": _scores(
        f""", {_curve()}, q AS (SELECT s, tp / (tp + fp) AS pr, tp / p AS rc FROM k)
SELECT round(s, 6) AS threshold, round(2 * (pr * rc) / (pr + rc + 1e-8), 6) AS f1, round(pr, 6) AS precision, round(rc, 6) AS recall
FROM q ORDER BY 2 * (pr * rc) / (pr + rc + 1e-8) DESC, s LIMIT 1"""
    ),
    "metric_accuracy": _scores("SELECT round(avg(((P_A >= 0.3::DOUBLE)::INT = TARGET)::INT), 6) AS accuracy FROM f_scores"),
    "metric_confusion": _scores(
        "SELECT TARGET AS actual, CAST(P_A >= 0.3::DOUBLE AS BIGINT) AS predicted, count(*) AS rows FROM f_scores GROUP BY 1, 2"
    ),
    "metric_classification": _scores(_CLASSES),
    "metric_calibration": _scores(
        """SELECT (SELECT count(*) FROM range(1, 10) t(i) WHERE i * 0.1::DOUBLE < P_A) AS bin, round(avg(P_A), 6) AS mean_predicted,
  round(avg(TARGET), 6) AS fraction_positive, count(*) AS rows FROM f_scores GROUP BY 1"""
    ),
    "threshold_sweep": _scores(
        """, t AS (SELECT CASE WHEN i = 49 THEN 0.95::DOUBLE ELSE 0.05::DOUBLE + i * ((0.95::DOUBLE - 0.05::DOUBLE) / 49) END AS c
  FROM range(0, 50) r(i))
SELECT round(c, 6) AS threshold, round(count(*) FILTER (WHERE P_A < c) / count(*), 6) AS approval_rate,
  round(coalesce(avg(TARGET) FILTER (WHERE P_A < c), 0), 6) AS default_rate_approved FROM t, f_scores GROUP BY c"""
    ),
    "ensemble_mean": _scores(f"SELECT SK_ID_CURR, {_r(_MEAN, 'score')} FROM f_scores"),
    "ensemble_weighted": _scores(f"{_WEIGHTED_CTE} SELECT SK_ID_CURR, {_r(_WEIGHTED, 'score')} FROM f_scores, w"),
    "ensemble_vote": _scores(
        f"""SELECT SK_ID_CURR, TARGET, CAST(({_VOTES}) > 1.5 AS BIGINT) AS majority, {_r(f"({_VOTES}) / 3", "confidence")} FROM f_scores"""
    ),
    "ensemble_rank": _scores(
        f", r AS (SELECT SK_ID_CURR, TARGET, {_RANKS} FROM f_scores) SELECT SK_ID_CURR, TARGET, {_r('(rA + rB + rC) / 3', 'mean_rank')} FROM r"
    ),
    "ensemble_summary": _scores(
        f"""{_WEIGHTED_CTE}, r AS (SELECT SK_ID_CURR, TARGET, {_RANKS} FROM f_scores),
x AS (SELECT TARGET, {_MEAN} AS m FROM f_scores), y AS (SELECT TARGET, {_WEIGHTED} AS m FROM f_scores, w),
z AS (SELECT TARGET, ({_VOTES}) AS m FROM f_scores), q AS (SELECT TARGET, rA + rB + rC AS m FROM r)
SELECT 'mean' AS method, round({_auc('m', 'x')}, 6) AS auc UNION ALL SELECT 'weighted', round({_auc('m', 'y')}, 6)
UNION ALL SELECT 'vote', round({_auc('m', 'z')}, 6) UNION ALL SELECT 'rank', round({_auc('m', 'q')}, 6)"""
    ),
}
