"""Change-data-capture messages to typed application feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.cdc import days_birth, days_employed, document_flag, parse_amount

# Wire columns of the application table, by type.
AMOUNTS = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"]
TEXTS = [
    "name_contract_type",
    "name_income_type",
    "name_education_type",
    "name_family_status",
    "name_housing_type",
    "occupation_type",
    "organization_type",
]
FLAGS = [
    "flag_mobil",
    "flag_emp_phone",
    "flag_work_phone",
    "flag_phone",
    "flag_email",
    "flag_own_car",
    "flag_own_realty",
]
DOCUMENTS = list(range(2, 22))

_TEXT_FIELDS = (
    ["sk_id_curr", "code_gender", "birth_date", "employment_start_date", "created_at", "updated_at"]
    + AMOUNTS
    + TEXTS
    + [f"document_id_{n}" for n in DOCUMENTS]
)
_INT_FIELDS = ["cnt_children", "own_car_age", *FLAGS]
ROW = T.StructType(
    [T.StructField(n, T.StringType()) for n in _TEXT_FIELDS] + [T.StructField(n, T.IntegerType()) for n in _INT_FIELDS]
)
ENVELOPE = T.StructType(
    [
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("op", T.StringType()),
                    T.StructField("ts_ms", T.LongType()),
                    T.StructField("before", ROW),
                    T.StructField("after", ROW),
                ]
            ),
        ),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

FEATURES = (
    ["cnt_children", *AMOUNTS, *TEXTS, "days_birth", "days_employed", *FLAGS, "own_car_age"]
    + [f"flag_document_{n}" for n in DOCUMENTS]
)


def parse_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """``op`` and ``row`` (after, or before for a delete) of each message, parsed
    once; ``bad`` marks a message that is no envelope."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    # Through explode, so that filters on the result are not pushed below the parser,
    # where each of their terms would parse the text again.
    once = F.array(F.from_json(F.col(value).cast("string"), ENVELOPE, options))
    parsed = messages.select("*", F.explode(once).alias("_m"))
    payload = F.col("_m.payload")
    return parsed.select(
        *messages.columns,
        payload["op"].alias("op"),
        payload["ts_ms"].alias("ts_ms"),
        F.coalesce(payload["after"], payload["before"]).alias("row"),
        (F.col("_m._corrupt_record").isNotNull() | payload["after"].isNull() & payload["before"].isNull()).alias("bad"),
    )


def feature_columns(row: str = "row", training_sign: bool = False) -> list[Column]:
    """The 42 features of an application row."""

    def f(name: str) -> Column:
        return F.col(f"{row}.{name}")

    made = {c: parse_amount(f(c)) for c in AMOUNTS}
    made["days_birth"] = days_birth(f("birth_date"), f("created_at"))
    made["days_employed"] = days_employed(f("employment_start_date"), f("created_at"), training_sign)
    made |= {f"flag_document_{n}": document_flag(f(f"document_id_{n}")) for n in DOCUMENTS}
    return [(made[c] if c in made else f(c)).alias(c) for c in FEATURES]


def flatten(messages: DataFrame, value: str = "value", training_sign: bool = False, stamp: bool = True) -> DataFrame:
    """Key, 42 features and ``ts`` per readable message, with ``op`` and ``ts_ms`` so
    that the sink can order changes and remove deleted keys. Unreadable messages are skipped (see ``rejects``)."""
    rows = parse_envelopes(messages, value).where(~F.col("bad"))
    out = [F.coalesce(F.col("row.sk_id_curr"), F.lit("")).alias("sk_id_curr"), *feature_columns("row", training_sign)]
    if stamp:
        out.append(F.unix_timestamp().cast("double").alias("ts"))
    return rows.select(*out, "op", "ts_ms", *position(messages))


def position(messages: DataFrame) -> list[str]:
    """Columns that order changes of one millisecond, where the source has them."""
    return [c for c in ("partition", "offset") if c in messages.columns]


def rejects(messages: DataFrame, value: str = "value") -> DataFrame:
    return parse_envelopes(messages, value).where("bad").select(*messages.columns)


def flatten_documents(df: DataFrame, documents: str) -> DataFrame:
    """A ``document_ids`` map to one ``document_id_N`` column per type; types absent
    from the map are NULL."""
    return df.select(
        *[c for c in df.columns if c != documents],
        *[F.try_element_at(F.col(documents), F.lit(f"document_id_{n}")).alias(f"document_id_{n}") for n in DOCUMENTS],
    )
