"""Rows dealt by key: how often they move and how many a task holds."""

from pyspark.sql import functions as F

from riskloom.operators import reports, skew


def test_rows_move_once_for_all_distinct_counts(spark):
    rows = [(None if k % 7 == 0 else k % 5, k % 3 if k % 4 else None, f"t{k % 2}", float(k)) for k in range(60)]
    df = spark.createDataFrame(rows, "k long, a long, b string, v double")
    out = skew.aggregate_with_distinct(df, "k", [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")], {"da": "a", "db": "b"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan
    want = {}
    for k, a, b, v in rows:
        g = want.setdefault(k, [0, 0.0, set(), set()])
        g[0], g[1] = g[0] + 1, g[1] + v
        g[2] |= {a} - {None}
        g[3].add(b)
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == {k: (n, t, len(a), len(b)) for k, (n, t, a, b) in want.items()}


def test_loan_terms_tasks_hold_few_rows(spark):
    pos = spark.createDataFrame([(k % 40, float(k % 3)) for k in range(1000)] + [(None, 1.0), (1, None)], "SK_ID_PREV long, CNT_INSTALMENT double")
    terms = reports.loan_terms(pos, per_task=100)
    assert terms.rdd.getNumPartitions() == 10
    assert sorted(map(tuple, terms.collect())) == sorted({(k % 40, float(k % 3)) for k in range(1000)})
