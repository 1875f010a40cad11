"""Decisions on requests and rows at fault."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskloom.session import fresh_path
from riskloom.streaming import scoring, store

NOW = datetime(2024, 1, 31)


def test_requests_and_decisions(spark):
    texts = ['{"sk_id_curr":"1"}', '{"sk_id_curr":"1"}', '{"specversion":"1.0","data":{"sk_id_curr":2}}', "{cut", '{"other":1}', '{"sk_id_curr":"3"}', '{"sk_id_curr":"4"}']
    keys = scoring.requested(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r[0] for r in keys.collect()) == ["1", "2", "3", "4"]
    rows = [("1", 0.1, NOW), ("2", 0.9, NOW), ("3", 0.1, NOW - timedelta(days=9)), ("4", -1.0, NOW)]
    views = {"application_features": spark.createDataFrame(rows, "sk_id_curr string, last_value double, event_timestamp timestamp")}
    score = lambda df: df.withColumn("probability", F.when(F.col("application_features__last_value") >= 0, F.col("application_features__last_value")))
    out = scoring.decide_requests(keys, views, score, F.lit(NOW), "m", "7", threshold=0.5).drop("ts")
    got = {r["sk_id_curr"]: tuple(r)[1:] for r in out.collect()}
    review = (None, "under-review", 0.5, "m", "7", "feature_data_unavailable")
    assert got == {"1": (0.1, "approve", 0.5, "m", "7", None), "2": (0.9, "reject", 0.5, "m", "7", None), "3": review, "4": review}


def delivered(spark, bad, n=40, down=False):
    root, calls = fresh_path(spark, "test-rows"), []

    def sink(batch, batch_id):
        calls.append(batch_id)
        if down:
            raise RuntimeError("down")
        k = F.col("id")
        batch.select(F.when(k.isin(bad), F.raise_error(F.concat(F.lit("bad "), k))).otherwise(k).cast("long").alias("id")).write.mode("overwrite").parquet(f"{root}/out")

    store.deliver_rows(sink, f"{root}/dead", retries=1)(spark.range(0, n, 1, 3), 5)
    read = lambda path, schema: [tuple(r) for r in spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).collect()]
    return root, calls, read


def test_only_rows_at_fault_are_parked(spark):
    root, _, read = delivered(spark, [3, 4, 39])
    assert sorted(read(f"{root}/out", "id long")) == [(k,) for k in range(40) if k not in (3, 4, 39)]
    dead = read(f"{root}/dead", "id long, reason string")
    assert sorted(k for k, _ in dead) == [3, 4, 39] and all(f"bad {k}" in reason for k, reason in dead)


def test_sink_that_is_down(spark):
    root, calls, read = delivered(spark, [], n=5, down=True)
    assert len(calls) == 3 and sorted(read(f"{root}/dead", "id long, reason string")) == [(k, "RuntimeError: down") for k in range(5)]


def test_good_batch_is_written_once(spark):
    root, calls, read = delivered(spark, [])
    assert len(calls) == 1 and len(read(f"{root}/out", "id long")) == 40


def test_named_rows_are_parted_in_one_pass(spark):
    """However many rows are at fault, a sink that names them is called twice."""
    root, calls = fresh_path(spark, "test-named"), []
    reason = F.when(F.col("id") % 5 == 0, F.concat(F.lit("bad "), F.col("id")))

    def sink(batch, batch_id):
        calls.append(batch.where(reason.isNotNull()).count())
        if calls[-1]:
            raise store.RowsRefused(reason)
        batch.write.mode("overwrite").parquet(f"{root}/out")

    store.deliver_rows(sink, f"{root}/dead")(spark.range(0, 200, 1, 3), 5)
    assert calls == [40, 0]
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/out").collect()) == [k for k in range(200) if k % 5]
    dead = spark.read.schema("id long, reason string").option("recursiveFileLookup", "true").parquet(f"{root}/dead").collect()
    assert sorted(map(tuple, dead)) == [(k, f"bad {k}") for k in range(0, 200, 5)]


def test_named_and_unnamed_faults(spark):
    """Rows at fault that the sink does not name are still found, and parked with the named ones."""
    root = fresh_path(spark, "test-both")
    reason = F.when(F.col("id") == 7, F.lit("named"))

    def sink(batch, batch_id):
        if not batch.where(reason.isNotNull()).isEmpty():
            raise store.RowsRefused(reason)
        k = F.col("id")
        batch.select(F.when(k == 11, F.raise_error(F.lit("unnamed"))).otherwise(k).cast("long").alias("id")).write.mode("overwrite").parquet(f"{root}/out")

    store.deliver_rows(sink, f"{root}/dead", retries=0)(spark.range(0, 20, 1, 3), 5)
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/out").collect()) == [k for k in range(20) if k not in (7, 11)]
    dead = spark.read.schema("id long, reason string").option("recursiveFileLookup", "true").parquet(f"{root}/dead").collect()
    assert sorted(r["id"] for r in dead) == [7, 11]
