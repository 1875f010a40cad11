"""Streaming jobs: idempotent log, deletes, retries, batch equals stream."""

import hashlib
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import cdc, latest
from riskloom.session import fresh_path
from riskloom.sources import files, schemas
from riskloom.sources.domain import view
from riskloom.streaming import jobs, store


def _change(key, op, amount, ts):
    row = {"sk_id_curr": key, "amt_credit": amount, "created_at": "2024-01-01T00:00:00", "birth_date": "1990-01-01"}
    payload = {"op": op, "ts_ms": ts, "after": None if op == "d" else row, "before": row if op == "d" else None}
    return json.dumps({"payload": payload})


def test_cdc_job_updates_and_deletes(spark):
    root = fresh_path(spark, "test-cdc")
    first = [_change("1", "c", "10.00", 1), _change("2", "c", "20.00", 1), "{cut"]
    second = [_change("1", "u", "11.50", 2), _change("2", "d", "20.00", 2), _change("3", "c", "oA8=", 2)]
    for name, lines in (("a", first), ("b", second)):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    source = files.text_stream(spark, f"{root}/in")
    jobs.cdc_job(source, f"{root}/out", f"{root}/dead", f"{root}/check").awaitTermination()
    schema = cdc.flatten(spark.createDataFrame([("",)], "value string")).schema
    live = {r["sk_id_curr"]: r for r in store.read_latest(spark, f"{root}/out", schema, "sk_id_curr", ["ts_ms"]).collect()}
    assert sorted(live) == ["1", "3"]
    assert live["1"]["amt_credit"] == 11.5 and live["3"]["amt_credit"] == -245.61
    dead = spark.read.schema("value string").option("basePath", f"{root}/dead").parquet(f"{root}/dead")
    assert [r["value"] for r in dead.collect()] == ["{cut"]


def test_log_replay_and_compaction(spark):
    path = fresh_path(spark, "test-log")
    schema = T.StructType.fromDDL("k string, v int, at int")
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    store.write_batch(rows(("a", 1, 1), ("a", 2, 2), ("b", 1, 1)), 0, path, "k", ["at"])
    store.write_batch(rows(("a", 3, 3)), 1, path, "k", ["at"])
    store.write_batch(rows(("a", 3, 3)), 1, path, "k", ["at"])  # replay
    want = [("a", 3, 3), ("b", 1, 1)]
    read = lambda p: sorted(map(tuple, store.read_latest(spark, p, schema, "k", ["at"]).collect()))
    assert read(path) == want
    store.compact(spark, path, f"{path}-new", schema, "k", ["at"])
    assert read(f"{path}-new") == want


def test_delivery_retries_then_parks(spark):
    dead, calls = fresh_path(spark, "test-dead"), []

    def failing(batch, batch_id):
        calls.append(batch_id)
        raise RuntimeError("sink down")

    store.deliver(failing, dead, retries=3)(spark.range(2), 7)
    assert len(calls) == 4
    parked = spark.read.parquet(dead)
    assert parked.count() == 2 and "sink down" in parked.first()["reason"]


def test_readiness_sessions(spark):
    rows = [("k", s, t) for s, t in (("application", 0), ("external", 50), ("external", 120), ("dwh", 300), ("application", 350), ("external", 400))]
    rows += [("hot", "application", t) for t in range(0, 3000, 10)] + [("hot", "dwh", 5), ("hot", "external", 2995)]
    arrivals = spark.createDataFrame(rows, "sk_id_curr string, source string, t int").select(
        "sk_id_curr", "source", F.timestamp_seconds("t").alias("ts")
    )
    got = sorted((r[0], r[1], r[2].timestamp()) for r in latest.feature_ready(arrivals, 100).collect())
    # k: a pause of 180 s empties the set, so dwh, application and external complete it
    assert got == [("hot", "external", 2995.0), ("k", "external", 400.0)]


def test_current_status_matches_history(spark, sf_dir):
    log = view(spark, sf_dir, "status_log")
    one = latest.current_status(log).orderBy("sk_id_curr").first()
    newest = latest.status_history(log, one["sk_id_curr"], limit=1).first()
    assert (newest["status"], newest["created_at"]) == (one["current_status"], one["status_updated_at"])


def test_ledger_loads_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "My File.csv").write_text("a,b\n1,x\n2,\n")
    schema = T.StructType.fromDDL("a int, b string")
    row = files.file_ledger(spark, str(source)).first()
    assert (row["table_name"], row["bytes"]) == ("my_file", 11)
    assert row["md5"] == hashlib.md5(b"a,b\n1,x\n2,\n").hexdigest()
    args = (spark, str(source), str(tmp_path / "ledger"), schema, str(tmp_path / "target"))
    assert files.load_once(*args) == 1 and files.load_once(*args) == 0
    loaded = spark.read.parquet(str(tmp_path / "target")).select("a", "b").orderBy("a").collect()
    assert [tuple(r) for r in loaded] == [(1, "x"), (2, None)]


def test_load_if_empty(spark, tmp_path):
    target = str(tmp_path / "t")
    assert files.load_if_empty(spark.range(2), target) and not files.load_if_empty(spark.range(5), target)
    assert spark.read.parquet(target).count() == 2


def test_schema_file(tmp_path):
    path = tmp_path / "s.json"
    path.write_text('[{"name": "a", "type": "Int64"}, {"name": "b", "type": "Float32"}, {"name": "c", "type": "Odd"}]')
    assert schemas.load_schema(str(path)).simpleString() == "struct<a:bigint,b:double,c:string>"


def test_empty_input_has_no_contract_findings(spark):
    none = spark.createDataFrame([], "value string")
    assert schemas.contract_check(none, {"a": "Int64"}).isEmpty()
