"""Bucketed tables are joined as they lie."""

import re

from riskloom.operators import enrich
from riskloom.sources import tables


def test_batch_moves_only_its_keys(spark):
    marts = [
        tables.save_bucketed(spark.createDataFrame([(k, k * n) for k in range(500)] + [(None, 0)], f"SK_ID_CURR long, v{n} long"), "mart", "SK_ID_CURR", 4)
        for n in (1, 2)
    ]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        keys = spark.createDataFrame([(str(k),) for k in range(480, 520)] + [("x",), (None,)], "sk_id_curr string")
        out = enrich.enrich_warehouse(keys, marts)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r["sk_id_curr"]: (r["v1"], r["v2"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {str(k): (k, 2 * k) if k < 500 else (None, None) for k in range(480, 520)}
    final = plan.split("Initial Plan")[-1]
    assert final.count("SortMergeJoin") == 2 and len(re.findall(r"Exchange hashpartitioning", final)) == 2  # the distinct keys, then by customer
    scans = [line for line in final.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)


def test_raw_tables_cut_to_the_keys(spark):
    raw = spark.createDataFrame([(k % 10, k) for k in range(100)] + [(None, 1)], "SK_ID_CURR long, n long")
    keys = spark.createDataFrame([("3",), ("3",), ("x",), ("77",)], "sk_id_curr string")
    assert sorted(r["n"] for r in enrich.cut_to(keys, raw).collect()) == list(range(3, 100, 10))


def test_views_and_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    tables.as_view(df, "named_rows")
    assert spark.sql("SELECT count(v) FROM named_rows").first()[0] == 1
    assert sorted(map(tuple, tables.save_table(df, "plain").collect()), key=repr) == [(1, "a"), (2, None)]
