"""Operators against brute force on small data, and their behaviour under skew."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import enrich, nested, prepare, previous, quality, ranking
from riskloom.operators.bureau import bureau_features
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.skew import with_parts
from riskloom.session import fresh_path
from riskloom.sources import files
from riskloom.sources.domain import view
from riskloom.streaming import jobs


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(7)
    # a third of all values are one hot value
    values = [(i, 5.0 if i % 3 == 0 else rng.gauss(0, 100), float(i % 4) if i % 5 else None) for i in range(2000)]
    return values, spark.createDataFrame(values, "id long, a double, b double").repartition(4)


@pytest.mark.parametrize("method", ["linear", "nearest"])
def test_exact_quantiles(numbers, method):
    values, df = numbers
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.95, 0.999, 1.0]
    got = {r["column"]: r for r in exact_quantiles(df, ["a", "b"], probabilities, method).collect()}
    for i, c in enumerate("ab", start=1):
        present = [v[i] for v in values if v[i] is not None]
        want = np.quantile(present, probabilities, method=method)
        assert got[c]["n"] == len(present)
        assert [got[c][f"q{k}"] for k in range(len(probabilities))] == pytest.approx(list(want))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_cross_buckets(spark, descending):
    rng = random.Random(3)
    rows = [(round(rng.random() * 1.4 - 0.2, 3), rng.randint(1, 9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, n long").groupBy("score").agg(F.sum("n").alias("n"))
    got = {r["score"]: (r["cum_n"], r["all_n"], r["next"]) for r in ranking.running_totals(df, ["n"], descending).collect()}
    totals = {r["score"]: r["n"] for r in df.collect()}
    order, running = sorted(totals, reverse=descending), 0
    for i, s in enumerate(order):
        running += totals[s]
        following = totals[order[i + 1]] if i + 1 < len(order) else None
        assert got[s][0] == running and got[s][1] == sum(totals.values())
        assert (got[s][2]["n"] if got[s][2] else None) == following


def test_ordinal_rank_with_hot_score(spark):
    rows = [(i, 0.5 if i % 3 else (i % 7) / 10) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, p double")
    got = {r["id"]: r["rank"] for r in ranking.ordinal_rank(df, "p", "id", "rank", block=10).collect()}
    want = {i: k for k, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == want


def test_parts_bound_hot_groups(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"), "id")
    parts = with_parts(df, "k", 50, ["id"])
    sizes = parts.groupBy("k", "PART").count().agg(F.max("count")).first()[0]
    assert parts.count() == 1000 and sizes < 120
    assert parts.where("k <> 1 AND PART <> 0").isEmpty()


def test_linkage_totals_count_the_linked_loans(spark, sf_dir):
    table = view(spark, sf_dir, "previous_application")
    totals, loans = previous.linkage_features(table), previous.approved_loans(table)
    assert totals.count() == totals.select("SK_ID_CURR").distinct().count()
    assert totals.agg(F.sum("PREV_APPROVED_COUNT")).first()[0] == loans.count()


def _messages(spark, sf_dir, max_rows):
    table = view(spark, sf_dir, "application_train")
    keys = table.select(F.col("SK_ID_CURR").cast("string").alias("sk_id_curr"))
    rows = enrich.enrich_bureau(keys, view(spark, sf_dir, "bureau"), view(spark, sf_dir, "bureau_balance"), table, max_rows)
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def _rounded(df):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.drop("ts", "error").collect()
    )


def test_split_messages_give_the_same_features(spark, sf_dir):
    one = nested.bureau_from_messages(_messages(spark, sf_dir, 50_000))
    several = nested.bureau_from_messages(_messages(spark, sf_dir, 20))
    assert _rounded(one) == _rounded(several)


def test_split_customers_over_micro_batches(spark, sf_dir):
    root = fresh_path(spark, "test-split")
    whole = _messages(spark, sf_dir, 50_000).cache()
    whole_rows = _rounded(nested.bureau_from_messages(whole))
    texts = _messages(spark, sf_dir, 20).union(spark.createDataFrame([("{cut",), ("no json",), ('{"part": 0}',)], "value string"))
    texts.repartition(3, F.xxhash64("value")).write.text(f"{root}/in")
    paths = [f"{root}/{n}" for n in ("features", "parts", "dead")]
    jobs.bureau_features_job(files.text_stream(spark, f"{root}/in"), *paths, f"{root}/check").awaitTermination()
    assert _rounded(jobs.read_bureau_features(spark, *paths[:2])) == whole_rows
    assert spark.read.parquet(paths[2]).count() == 3


def test_split_customer_waits_for_all_parts(spark):
    root = fresh_path(spark, "test-wait")
    paths = [f"{root}/{n}" for n in ("features", "parts", "dead")]

    def message(part, parts, ts, *loans):
        bureau = [{"sk_id_bureau": n, "credit_active": "Active"} for n in loans]
        return json.dumps({"sk_id_curr": "1", "part": part, "parts": parts, "bureau": bureau, "bureau_balance": [], "ts": ts})

    counts = []
    for text in [message(0, 2, 1.25, 1, 2), message(1, 2, 1.25, 3), message(1, 2, 1.5, 4), message(0, 2, 1.5, 5), message(0, 1, 1.75, 6)]:
        spark.createDataFrame([(text,)], "value string").write.mode("append").text(f"{root}/in")
        jobs.bureau_features_job(files.text_stream(spark, f"{root}/in"), *paths, f"{root}/check").awaitTermination()
        counts.append([r["BUREAU_TOTAL_COUNT"] for r in jobs.read_bureau_features(spark, *paths[:2]).collect()])
    assert counts == [[], [3], [3], [2], [1]]


def test_nested_edge_messages(spark):
    texts = [
        '{"sk_id_curr": "1", "bureau": [], "bureau_balance": [], "external_scores": {"ext_source_1": "0.5"}, "ts": 1.0}',
        '{"sk_id_curr": "2", "bureau": [{"sk_id_bureau": 9, "credit_active": "Active", "amt_credit_sum_debt": 90,'
        ' "amt_credit_sum_limit": 100}], "bureau_balance": [{"sk_id_bureau": 9, "status": "c"},'
        ' {"sk_id_bureau": 9, "status": "5"}, {"sk_id_bureau": 8, "status": "5"}]}',
        "{broken",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = {r["sk_id_curr"]: r for r in nested.nested_features(nested.parse_messages(df)).collect()}
    empty, one, bad = rows["1"], rows["2"], rows["unknown"]
    assert (empty["BUREAU_TOTAL_COUNT"], empty["BUREAU_AMT_OVERDUE_TOTAL"], empty["ext_source_1"]) == (0, 0.0, 0.5)
    assert empty["BUREAU_OVERDUE_RATIO"] is None and empty["CLIENT_HAS_ANY_DPD_HISTORY"] == 0
    assert (one["BUREAU_CREDIT_TYPES_COUNT"], one["BUREAU_HIGH_UTIL_COUNT"], one["BUREAU_MAXED_OUT_COUNT"]) == (1, 1, 0)
    assert (one["TOTAL_MONTHS_ALL_BUREAUS"], one["TOTAL_SEVERE_DPD_MONTHS"], one["WORST_DPD_RATIO"]) == (2, 1, 0.5)
    assert bad["error"] and bad["BUREAU_TOTAL_COUNT"] is None


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    bureau, balance = view(spark, sf_dir, "bureau"), view(spark, sf_dir, "bureau_balance")
    few = _rounded(bureau_features(bureau.coalesce(1), balance.coalesce(1)))
    many = _rounded(bureau_features(bureau.repartition(13), balance.repartition(7)))
    assert few == many


def test_codes_and_unknowns(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "ab"), (4, None), (5, "ä")], "SK_ID_CURR long, c string")
    got = {r[0]: r[1] for r in prepare.ordinal_encode(df, df.where("SK_ID_CURR < 4"), ["c"]).collect()}
    assert got == {1: 2, 2: 0, 3: 1, 4: -1, 5: -1}


def test_modes_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    filled = prepare.impute(df, df, [], ["c"])
    assert filled.where("c IS NULL").isEmpty() and filled.where("c = 'a'").count() == 3


def test_constant_column_has_no_correlation(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("TARGET"), F.lit(1.0).alias("flat"), (F.col("id") * 2.0).alias("x"))
    assert [r["feature"] for r in quality.target_correlation(df, "TARGET", "id").collect()] == ["x"]
