"""DuckDB texts for sources, change capture, enrichment and feature store."""

from __future__ import annotations

from riskloom.functions.decisions import DOCUMENT_FOLDERS
from riskloom.operators.cdc import FEATURES
from riskloom.operators.enrich import SCORE_FIELDS
from riskloom.plans.oracle_marts import (
    APP_INTS,
    APP_TEXTS,
    D,
    I,
    MART_COLUMNS,
    S,
    STREAM_BUREAU_BASE,
    STREAM_BUREAU_COLUMNS,
    _APP_DOUBLES,
    _LOAN_CTES,
    _RECORD_RAW,
    columns,
    passthrough,
)
from riskloom.sources.domain import with_views

_AT = ["application_train"]
_ID = "CAST(SK_ID_CURR AS VARCHAR)"


def _app(body: str) -> str:
    return with_views(_AT, body)


_READABLE = "SK_ID_CURR % 101 <> 0"
_AMOUNTS = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"]


def _flat(name: str) -> str:
    """A change-stream feature straight from the application table."""
    if name in _AMOUNTS:
        return f"round(round({name.upper()} * 100) / 100, 6) + 0.0 AS {name}"
    if name == "days_employed":
        return "-DAYS_EMPLOYED AS days_employed"
    if name.startswith("name_") or name.endswith("_type"):
        return f"{name.upper()} AS {name}"
    return f"CAST({name.upper()} AS BIGINT) AS {name}"


_CDC_FLAT = _app(
    f"SELECT {_ID} AS sk_id_curr, {', '.join(_flat(f) for f in FEATURES)} FROM f_application_train "
    f"WHERE {_READABLE} AND SK_ID_CURR % 53 <> 0"
)

_MESSAGES = """, m AS (
  SELECT *, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS n FROM f_source_arrivals),
kinds AS (
  SELECT 'sk_id_curr' AS name, CASE WHEN n % 5 = 0 THEN 'Int64' ELSE 'String' END AS type FROM m
  UNION ALL SELECT 'source', 'String' FROM m WHERE n % 5 <> 0
  UNION ALL SELECT 'value', CASE WHEN n % 3 <> 0 THEN 'Float32' END FROM m WHERE n % 5 <> 0
  UNION ALL SELECT 'count', CASE WHEN n % 5 = 0 THEN 'String' WHEN n % 2 = 0 THEN 'Int64' END FROM m
  UNION ALL SELECT 'flag', 'Int64' FROM m WHERE n % 5 <> 0
  UNION ALL SELECT 'nothing', NULL FROM m WHERE n % 5 <> 0
  UNION ALL SELECT 'extra', 'Int64' FROM m WHERE n % 5 = 0)
"""

_CONTRACT = """, m AS (
  SELECT *, CAST(epoch(date_trunc('second', ts)) AS BIGINT) % 5 = 0 AS odd FROM f_source_arrivals)
SELECT 'error' AS severity, 'missing' AS problem, field, count(*) AS messages
FROM m, (VALUES ('source'), ('value'), ('flag')) AS t(field) WHERE odd GROUP BY field
UNION ALL SELECT 'error', 'wrong type', 'count', count(*) FROM m WHERE odd
UNION ALL SELECT 'warning', 'unexpected', 'extra', count(*) FROM m WHERE odd
UNION ALL SELECT 'warning', 'unexpected', 'nothing', count(*) FROM m WHERE NOT odd"""

_WAREHOUSE_VIEWS = ["credit_card_balance", "pos_cash_balance", "previous_application"]
_WAREHOUSE_CTES = f""", {_LOAN_CTES},
wc AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["cards"])} FROM f_credit_card_balance GROUP BY SK_ID_CURR),
wp AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["pos"])} FROM loan GROUP BY SK_ID_CURR),
wv AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["previous"])} FROM f_previous_application GROUP BY SK_ID_CURR)
"""


def _catalog() -> str:
    parts = []
    for cte, kind in (("wc", "cards"), ("wp", "pos"), ("wv", "previous")):
        for k, _, name in MART_COLUMNS[kind]:
            # a stored DOUBLE stays one even where the mart value happens to be whole
            type_name = {D: "Float32", I: "Int64", S: "String"}[k]
            parts.append(f"SELECT '{name.lower()}' AS name, '{type_name}' AS type, count({name}) AS rows FROM {cte}")
    return with_views(_WAREHOUSE_VIEWS, _WAREHOUSE_CTES + "\nUNION ALL ".join(parts))


_ALL_WAREHOUSE = [c for kind in ("cards", "pos", "previous") for _, _, c in MART_COLUMNS[kind]]

_NEWEST = """, newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sk_id_curr, source ORDER BY ts DESC, value DESC) AS rn
    FROM f_source_arrivals) WHERE rn = 1)
"""
_ONLINE = f"""{_NEWEST}, keys AS (SELECT DISTINCT {_ID} AS sk_id_curr FROM f_application_train),
live AS (SELECT * FROM newest WHERE ts > TIMESTAMP '2024-01-31 00:00:00' -
  CASE source WHEN 'application' THEN INTERVAL 1 DAY ELSE INTERVAL 7 DAY END),
online AS (SELECT k.sk_id_curr, a.value AS a, e.value AS e, d.value AS d FROM keys k
  LEFT JOIN live a ON a.sk_id_curr = k.sk_id_curr AND a.source = 'application'
  LEFT JOIN live e ON e.sk_id_curr = k.sk_id_curr AND e.source = 'external'
  LEFT JOIN live d ON d.sk_id_curr = k.sk_id_curr AND d.source = 'dwh')
"""
_ONLINE_VIEWS = ["source_arrivals", "application_train"]

# Sessions straight from the raw arrivals, without time slots.
_SESSIONS = """, g AS (
  SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY sk_id_curr ORDER BY ts) <= 86400000000
    THEN 0 ELSE 1 END AS fresh FROM f_source_arrivals),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY sk_id_curr ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g),
first_seen AS (SELECT sk_id_curr, session, source, min(epoch_us(ts)) AS seen FROM s GROUP BY ALL),
done AS (SELECT sk_id_curr, session, max(seen) AS seen, arg_max(source, seen) AS source FROM first_seen
  GROUP BY ALL HAVING count(*) = 3)
"""

_LATENCY = """, x AS (SELECT sk_id_curr, min(created_at) AS sent FROM f_status_log WHERE status = 'submitted' GROUP BY 1),
y AS (SELECT x.sk_id_curr, (epoch_us(min(l.created_at)) - epoch_us(any_value(x.sent))) / 1e6 AS s FROM x
  LEFT JOIN f_status_log l ON l.sk_id_curr = x.sk_id_curr AND l.status = 'approved' AND l.created_at >= x.sent GROUP BY 1)
SELECT count(*) AS submitted, count(s) AS decided, round(avg(s), 6) AS mean_s, round(quantile_cont(s, 0.5), 6) AS p50_s,
  round(quantile_cont(s, 0.95), 6) AS p95_s, round(quantile_cont(s, 0.99), 6) AS p99_s FROM y"""

_FOLDER = "CASE " + " ".join(f"WHEN c_custkey % 24 = {n} THEN '{folder}'" for n, folder in DOCUMENT_FOLDERS.items()) + " END"

_BUREAU_TEXTS = ["CREDIT_ACTIVE", "CREDIT_TYPE"]
_BUREAU_INTS = ["SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG", "DAYS_CREDIT"]
_BUREAU_DOUBLES = [
    "AMT_CREDIT_SUM_OVERDUE",
    "AMT_CREDIT_MAX_OVERDUE",
    "AMT_CREDIT_SUM_DEBT",
    "AMT_CREDIT_SUM_LIMIT",
    "AMT_CREDIT_SUM",
]

_EXTERNAL = ", ".join(f"a.{s.upper()} AS {s}" for s in SCORE_FIELDS)
_NESTED_BODY = f""", {_RECORD_RAW}, {STREAM_BUREAU_BASE},
f AS (SELECT SK_ID_CURR, {columns(*STREAM_BUREAU_COLUMNS)} FROM base LEFT JOIN record USING (SK_ID_BUREAU)
  GROUP BY SK_ID_CURR)
SELECT CAST(f.SK_ID_CURR AS VARCHAR) AS sk_id_curr, {_EXTERNAL}, f.* EXCLUDE (SK_ID_CURR)
FROM f JOIN f_application_train a USING (SK_ID_CURR)"""
_NESTED = with_views(["application_train", "bureau", "bureau_balance"], _NESTED_BODY)

STREAMS = {
    "src_csv_roundtrip": with_views(["bureau"], f"SELECT {passthrough(_BUREAU_DOUBLES, _BUREAU_INTS, _BUREAU_TEXTS)} FROM f_bureau"),
    "snapshot_export": _app(f"SELECT {passthrough(_APP_DOUBLES, [*APP_INTS, 'TARGET'], APP_TEXTS)} FROM f_application_train"),
    "infer_schema": with_views(
        ["source_arrivals"],
        _MESSAGES
        + """, votes AS (SELECT name, type, count(*) AS c FROM kinds GROUP BY ALL)
SELECT name, coalesce(arg_max(type, (c, -ascii(type))) FILTER (WHERE type IS NOT NULL), 'String') AS type
FROM votes GROUP BY name""",
    ),
    "contract_check": with_views(["source_arrivals"], _CONTRACT),
    "catalog_schema": _catalog(),
    "upsert_latest": with_views(
        ["source_arrivals"],
        """SELECT sk_id_curr AS key, arg_max(source, (ts, source)) AS source,
  round(arg_max(value, (ts, source)), 2) AS value FROM f_source_arrivals GROUP BY 1""",
    ),
    "cdc_flatten": _CDC_FLAT,
    "stream_cdc": _CDC_FLAT,
    "cdc_decimals": with_views(
        ["bureau"],
        """, x AS (SELECT SK_ID_BUREAU, CASE WHEN SK_ID_BUREAU % 2 = 0 THEN -AMT_CREDIT_SUM ELSE AMT_CREDIT_SUM END AS v
  FROM f_bureau)
SELECT SK_ID_BUREAU, round(v, 6) + 0.0 AS decoded, CASE WHEN SK_ID_BUREAU % 7 <> 0 THEN round(v, 6) + 0.0 END AS parsed,
  CASE WHEN SK_ID_BUREAU % 3 = 0 OR SK_ID_BUREAU % 7 <> 0 THEN round(v, 6) + 0.0 END AS combined FROM x""",
    ),
    "cdc_dates": _app(
        f"""SELECT {_ID} AS sk_id_curr, DAYS_BIRTH AS days_birth, -DAYS_EMPLOYED AS days_employed,
  DAYS_EMPLOYED AS days_employed_training FROM f_application_train WHERE {_READABLE}"""
    ),
    "cdc_key_extract": _app(
        f"SELECT SK_ID_CURR, CASE WHEN SK_ID_CURR % 5 < 4 THEN {_ID} END AS extracted FROM f_application_train"
    ),
    "document_flags": _app(
        f"SELECT {_ID} AS sk_id_curr, "
        + ", ".join(f"FLAG_DOCUMENT_{n} AS flag_document_{n}" for n in range(2, 22))
        + f" FROM f_application_train WHERE {_READABLE}"
    ),
    "document_flatten": _app(
        "SELECT SK_ID_CURR, "
        + ", ".join(
            (f"CASE WHEN FLAG_DOCUMENT_{n} = 1 THEN 'doc{n}-' || {_ID} END" if n in (3, 6, 9, 12) else "CAST(NULL AS VARCHAR)")
            + f" AS document_id_{n}"
            for n in range(2, 22)
        )
        + " FROM f_application_train"
    ),
    "cloudevent_unwrap": with_views(["source_arrivals"], 'SELECT epoch_us(ts) AS "at", sk_id_curr FROM f_source_arrivals'),
    "dead_letters": _app(
        f"""SELECT {_ID} AS key, 'unreadable' AS reason FROM f_application_train WHERE SK_ID_CURR % 101 = 0
UNION ALL SELECT {_ID} || '_x', 'no numeric key' FROM f_application_train WHERE SK_ID_CURR % 40 = 0"""
    ),
    "enrich_bureau": with_views(
        ["application_train", "bureau", "bureau_balance"],
        f""", r AS (SELECT SK_ID_CURR, count(*) AS c, sum(SK_ID_BUREAU) AS t FROM f_bureau GROUP BY 1),
h AS (SELECT SK_ID_CURR, count(*) AS c, sum(MONTHS_BALANCE) AS t FROM f_bureau_balance JOIN f_bureau USING (SK_ID_BUREAU)
  GROUP BY 1)
SELECT CAST(a.SK_ID_CURR AS VARCHAR) AS sk_id_curr, 1::BIGINT AS parts, coalesce(r.c, 0) AS records, coalesce(h.c, 0) AS months,
  coalesce(r.t, 0)::BIGINT AS record_ids, coalesce(h.t, 0)::BIGINT AS month_sum, {_EXTERNAL}
FROM f_application_train a LEFT JOIN r USING (SK_ID_CURR) LEFT JOIN h USING (SK_ID_CURR)""",
    ),
    "bureau_agg_nested": _NESTED,
    "stream_bureau_agg": _NESTED,
    "enrich_rejects": _app(
        f"""SELECT CASE WHEN SK_ID_CURR % 7 = 0 THEN {_ID} || '_1041' ELSE 'abc' END AS sk_id_curr
FROM f_application_train WHERE SK_ID_CURR % 7 = 0 OR SK_ID_CURR % 11 = 0"""
    ),
    "enrich_dwh": with_views(
        ["application_train", *_WAREHOUSE_VIEWS],
        _WAREHOUSE_CTES
        + f"SELECT CAST(a.SK_ID_CURR AS VARCHAR) AS sk_id_curr, {', '.join(f'{c} AS {c.lower()}' for c in _ALL_WAREHOUSE)} "
        "FROM f_application_train a LEFT JOIN wc USING (SK_ID_CURR) LEFT JOIN wp USING (SK_ID_CURR) "
        "LEFT JOIN wv USING (SK_ID_CURR)",
    ),
    "stream_enrich_dwh": with_views(
        ["application_train", *_WAREHOUSE_VIEWS],
        _WAREHOUSE_CTES
        + f"SELECT CAST(a.SK_ID_CURR AS VARCHAR) AS sk_id_curr, {', '.join(f'{c} AS {c.lower()}' for c in _ALL_WAREHOUSE)} "
        "FROM f_application_train a LEFT JOIN wc USING (SK_ID_CURR) LEFT JOIN wp USING (SK_ID_CURR) "
        f"LEFT JOIN wv USING (SK_ID_CURR) WHERE SK_ID_CURR % 53 <> 0 AND {_READABLE}",
    ),
    "dwh_flatten": with_views(
        ["pos_cash_balance"],
        f""", {_LOAN_CTES}, wp AS (SELECT SK_ID_CURR, {columns(*MART_COLUMNS["pos"])} FROM loan GROUP BY SK_ID_CURR)
SELECT SK_ID_CURR AS sk_id_curr, POS_COUNT_LOANS_TOTAL AS pos_count_loans_total, POS_RISK_SEGMENT AS pos_risk_segment,
  CAST(NULL AS VARCHAR) AS not_there FROM wp""",
    ),
    "online_store_latest": with_views(
        ["source_arrivals"],
        _NEWEST + """SELECT source || '_features' AS "view", sk_id_curr, round(value, 6) AS last_value FROM newest""",
    ),
    "online_features": with_views(
        _ONLINE_VIEWS,
        _ONLINE
        + """SELECT sk_id_curr, a AS application_features__last_value, e AS external_features__last_value,
  d AS dwh_features__last_value, CAST(coalesce(a, e, d) IS NOT NULL AS BIGINT) AS found FROM online""",
    ),
    "under_review": with_views(
        _ONLINE_VIEWS,
        _ONLINE
        + """SELECT sk_id_curr, CAST(NULL AS DOUBLE) AS probability, 'under-review' AS decision, 0.3::DOUBLE AS threshold,
  'feature_data_unavailable' AS reason FROM online WHERE coalesce(a, e, d) IS NULL""",
    ),
    "feature_mapping": with_views(
        _ONLINE_VIEWS,
        _ONLINE
        + """SELECT sk_id_curr, a AS APPLICATION_FEATURES_VALUE, e AS EXTERNAL_FEATURES_VALUE, d AS WAREHOUSE_VALUE
FROM online WHERE coalesce(a, e, d) IS NOT NULL""",
    ),
    "model_input_row": _app(
        "SELECT SK_ID_CURR, EXT_SOURCE_2, DAYS_BIRTH, CAST(NULL AS DOUBLE) AS NOT_THERE, CODE_GENDER, AMT_CREDIT "
        "FROM f_application_train"
    ),
    "current_status": with_views(
        ["status_log"],
        """SELECT DISTINCT ON (sk_id_curr) sk_id_curr, status AS current_status, epoch_us(created_at) AS updated_at,
  created_by AS last_updated_by, metadata FROM f_status_log ORDER BY sk_id_curr, created_at DESC, id DESC""",
    ),
    "status_history": with_views(
        ["status_log"],
        """SELECT id, status, epoch_us(created_at) AS "at", created_by FROM f_status_log
WHERE sk_id_curr = (SELECT sk_id_curr FROM f_status_log ORDER BY created_at DESC, id DESC LIMIT 1)""",
    ),
    "feature_ready": with_views(["source_arrivals"], _SESSIONS + 'SELECT sk_id_curr, source, seen AS "at" FROM done'),
    "feature_ready_every_write": with_views(
        ["source_arrivals"],
        _SESSIONS
        + """SELECT s.sk_id_curr, s.source, epoch_us(s.ts) AS "at" FROM s JOIN done USING (sk_id_curr, session)
WHERE epoch_us(s.ts) >= done.seen""",
    ),
    "stream_feature_ready": with_views(
        ["source_arrivals"],
        "SELECT sk_id_curr FROM f_source_arrivals GROUP BY 1 HAVING count(DISTINCT source) = 3",
    ),
    "decisions": with_views(
        ["scores"], "SELECT SK_ID_CURR, P_A, CASE WHEN P_A < 0.3::DOUBLE THEN 'approve' ELSE 'reject' END AS decision FROM f_scores"
    ),
    "decision_boundary": with_views(
        ["scores"],
        """SELECT SK_ID_CURR, CASE WHEN P_A < 0.5 THEN 'approve' ELSE 'reject' END AS service,
  CASE WHEN P_A <= 0.5 THEN 'approved' ELSE 'rejected' END AS domain FROM f_scores""",
    ),
    "debt_to_income": _app(
        """SELECT SK_ID_CURR, CASE WHEN SK_ID_CURR % 20 = 0 THEN 'inf'::DOUBLE
  ELSE round(AMT_CREDIT / AMT_INCOME_TOTAL, 6) END AS dti FROM f_application_train"""
    ),
    "clean_infinite": _app(
        """SELECT SK_ID_CURR, CASE WHEN SK_ID_CURR % 20 <> 0 THEN round(AMT_CREDIT / AMT_INCOME_TOTAL, 6) END AS dti
FROM f_application_train"""
    ),
    "trace_id": _app(
        f"""SELECT SK_ID_CURR, substr(sha256('loan_application:' || {_ID}), 1, 32) AS trace_id,
  substr(sha256('loan_application:' || {_ID}), 33, 16) AS span_id FROM f_application_train"""
    ),
    "document_paths": f"""SELECT c_custkey AS SK_ID_CURR, CASE WHEN c_custkey % 4 <> 2 THEN
  regexp_replace(c_name, '[^A-Za-z0-9_.:-]', '_', 'g') || '/' || {_FOLDER} || '/doc_' || c_custkey || '.' ||
  CASE c_custkey % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'png' ELSE 'jpg' END END AS path FROM customer""",
    "pipeline_latency": with_views(["status_log"], _LATENCY),
    "topic_throughput": with_views(
        ["status_log"],
        """SELECT CAST(epoch(date_trunc('hour', created_at)) AS BIGINT) AS window_start, status AS topic, count(*) AS messages,
  round(count(*) / 3600, 6) AS rate FROM f_status_log GROUP BY 1, 2""",
    ),
    "stream_throughput": with_views(
        ["status_log"],
        """, m AS (SELECT *, epoch_us(created_at) AS us FROM f_status_log),
ends AS (SELECT min(us) AS low, max(us) AS high FROM m)
SELECT CAST(epoch(date_trunc('hour', created_at)) AS BIGINT) AS window_start, status AS topic, count(*) AS messages
FROM m, ends WHERE NOT (id % 97 = 0 AND floor((us - low) * 10 / (high - low + 1)) < 6) GROUP BY 1, 2""",
    ),
    "stream_latency": with_views(
        ["status_log"],
        """, a AS (SELECT *, epoch_us(created_at) AS us FROM f_status_log WHERE status = 'approved'),
ends AS (SELECT min(us) AS low, max(us) AS high FROM a),
d AS (SELECT sk_id_curr, created_at FROM a, ends WHERE NOT (id % 97 = 0 AND floor((us - low) * 10 / (high - low + 1)) < 6)),
p AS (SELECT s.id AS submission, any_value(s.sk_id_curr) AS sk_id_curr, any_value(s.created_at) AS sent, min(d.created_at) AS done FROM f_status_log s
  LEFT JOIN d ON d.sk_id_curr = s.sk_id_curr AND d.created_at >= s.created_at AND d.created_at <= s.created_at + INTERVAL 2 DAYS WHERE s.status = 'submitted' GROUP BY s.id)
SELECT submission, sk_id_curr, round((epoch_us(done) - epoch_us(sent)) / 1e6, 6) AS seconds FROM p""",
    ),
    "stream_decisions": with_views(
        _ONLINE_VIEWS,
        _ONLINE
        + """, p AS (SELECT sk_id_curr, CASE WHEN coalesce(a, e, d) IS NOT NULL
  THEN 1 / (1 + exp(-(-0.5 - 0.02 * coalesce(a, 0) + 0.01 * coalesce(e, 0) + 0.005 * coalesce(d, 0)))) END AS p FROM online)
SELECT sk_id_curr, round(p, 6) AS probability, CASE WHEN p IS NULL THEN 'under-review' WHEN p >= 0.3::DOUBLE THEN 'reject' ELSE 'approve' END AS decision,
  0.3::DOUBLE AS threshold, 'scorecard' AS model, '1' AS version, CASE WHEN p IS NULL THEN 'feature_data_unavailable' END AS reason FROM p""",
    ),
    "stream_dead_letters": _app(
        f"SELECT {_ID} AS sk_id_curr, CASE WHEN SK_ID_CURR % 1000 = 50 THEN 'parked' ELSE 'stored' END AS outcome "
        f"FROM f_application_train WHERE SK_ID_CURR % 53 <> 0 AND {_READABLE}"
    ),
    "flow_check": with_views(
        ["status_log"],
        """SELECT topic, count(status) AS messages, CAST(count(status) >= 100 AS BIGINT) AS flowing
FROM (VALUES ('submitted'), ('ml_scoring'), ('approved'), ('rejected')) AS t(topic)
LEFT JOIN f_status_log ON status = topic GROUP BY 1""",
    ),
}
