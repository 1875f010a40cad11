"""Column functions on small tables of edge cases."""

import base64
import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import cdc, decisions
from riskloom.operators import cards, enrich
from riskloom.sources.files import table_name


def column(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]


def encoded(number, size=None):
    size = size or max(1, (number.bit_length() + 8) // 8)
    return base64.b64encode(number.to_bytes(size, "big", signed=True)).decode()


def test_decode_decimal(spark):
    numbers = [0, 1, -1, 127, 128, -128, -129, 250_000_00, -99_999_999_99, 2**62, -(2**62)]
    wide = [2**80, -(2**80)]
    texts = [encoded(n) for n in numbers + wide] + ["n/a", "", None, "???", "A"]
    got = column(spark, texts, lambda c: cdc.decode_decimal(c, 2))
    assert got[: len(numbers)] == [n / 100 for n in numbers]
    assert got[len(numbers) : len(numbers) + 2] == pytest.approx([n / 100 for n in wide])
    assert got[len(numbers) + 2 :] == [None] * 5


def test_parse_decimal(spark):
    good = {"12.5": 12.5, " -3 ": -3.0, "1e3": 1000.0, "1_000": 1000.0, ".5": 0.5, "7.": 7.0, "inf": math.inf}
    bad = ["5d", "5f", "abc", "", None, "1__0", "_1", "1,000", "0x10"]
    got = column(spark, list(good) + bad, cdc.parse_decimal)
    assert got == list(good.values()) + [None] * len(bad)


def test_amount_prefers_number_text(spark):
    assert column(spark, ["1234", encoded(50_00)], cdc.parse_amount) == [1234.0, 50.0]


def test_dates(spark):
    created = F.lit("2024-01-01T08:00:00")
    births = ["1990-01-01", "7305", "-1", "bad", "", None]
    got = column(spark, births, lambda c: cdc.days_birth(c, created))
    assert got == [-12418, -12418, -19724, None, None, None]
    assert column(spark, ["2023-12-31"], lambda c: cdc.days_employed(c, created)) == [1]
    assert column(spark, ["2023-12-31"], lambda c: cdc.days_employed(c, created, training_sign=True)) == [-1]


def test_document_flag(spark):
    assert column(spark, ["doc_1", "", "  ", "\t\n", None, " x "], cdc.document_flag) == [1, 0, 0, 0, 0, 1]


@pytest.mark.parametrize(
    "message, key",
    [
        ('{"sk_id_curr": "100001"}', "100001"),
        ('{"sk_id_curr": 12345}', "12345"),
        ('{"payload": {"after": {"sk_id_curr": "200002"}}}', "200002"),
        ('{"payload": {"before": {"sk_id_curr": "300003"}, "after": null}}', "300003"),
        ('{"value": {"sk_id_curr": "400004"}}', "400004"),
        ('{"after": {"sk_id_curr": "5"}}', "5"),
        ('{"payload": {"after": {"other": 1}, "before": {"sk_id_curr": "6"}}}', None),
        ("{}", None),
        ("not json", None),
    ],
)
def test_cdc_key(spark, message, key):
    assert column(spark, [message], cdc.cdc_key) == [key]


def test_decisions(spark):
    cases = [(0.3, 0.5, "approve", "approved"), (0.5, 0.5, "reject", "approved"), (0.0, 0.0, "reject", "approved"),
             (0.99, 1.0, "approve", "approved"), (0.6, 0.5, "reject", "rejected")]
    for p, t, service, domain in cases:
        row = spark.range(1).select(decisions.decide(F.lit(p), t), decisions.domain_decide(F.lit(p), t)).first()
        assert tuple(row) == (service, domain)
    ratios = spark.range(1).select(
        decisions.debt_to_income(F.lit(500000.0), F.lit(200000.0)),
        decisions.debt_to_income(F.lit(1.0), F.lit(0.0)),
        decisions.debt_to_income(F.lit(-100.0), F.lit(100.0)),
    ).first()
    assert tuple(ratios) == (2.5, math.inf, -1.0)


def test_document_path(spark):
    rows = spark.createDataFrame(
        [("a b/../c", 3, "d1", ".PDF"), ("7", 21, "d2", "jpeg"), ("7", 22, "d3", "pdf"), ("7", 2, "d4", "exe"), (" ", 2, "d5", "pdf")],
        "k string, t int, d string, e string",
    )
    got = [r[0] for r in rows.select(decisions.document_path("k", "t", "d", "e")).collect()]
    assert got == ["a_b_.._c/financial/income/d1.pdf", "7/other/d2.jpeg", None, None, None]


def test_numeric_key_guard(spark):
    keys = spark.createDataFrame([("abc",), ("12",), ("798498_1041",), (None,)], "sk_id_curr string")
    assert [r["key"] for r in enrich.numeric_keys(keys).collect()] == ["12"]
    assert enrich.rejected_keys(keys).count() == 3


def test_table_name():
    assert table_name("/data/POS_CASH balance.v2.csv") == "pos_cash_balance_v2"


def test_decimals_of_any_length(spark):
    cases = [(n, v) for n in (1, 8, 9, 16, 17, 40) for v in (5, -5, 100, -128)]
    texts = [base64.b64encode(v.to_bytes(n, "big", signed=True)).decode() for n, v in cases]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["d"] for r in df.select("i", cdc.decode_decimal("t", 2).alias("d")).collect()}
    assert [got[i] for i in range(len(cases))] == [v / 100 for _, v in cases]
    large = base64.b64encode((1 << 135).to_bytes(17, "big", signed=False)).decode()
    assert spark.createDataFrame([(large,)], "t string").select(cdc.decode_decimal("t", 0)).first()[0] == -float(1 << 135)


def test_every_numeric_column_is_averaged(spark):
    df = spark.range(4).select(F.lit(1).alias("k"), *[(F.col("id") + i).alias(f"c{i}") for i in range(60)])
    row = cards.numeric_averages(df, "k").first()
    assert [row[f"cc_avg_c{i}"] for i in range(60)] == [i + 1.5 for i in range(60)]
