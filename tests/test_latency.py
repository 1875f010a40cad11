"""A decision in time, one that comes too late, one out of the bound, and none."""

from datetime import datetime, timedelta

from riskloom.session import fresh_path
from riskloom.streaming import latency

T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


def test_outer_join_in_event_time(spark):
    root = fresh_path(spark, "test-latency")
    sent = [
        [(1, "a", at(0)), (2, "b", at(0)), (3, "c", at(1)), (4, "a", at(2)), (5, None, at(2))],
        [(6, "d", at(30))],
        [(7, "d", at(60))],
        [(8, "z", at(900))],
    ]
    done = [
        [("a", at(1)), ("a", at(3)), ("c", at(0))],
        [("b", at(13)), ("d", at(31))],
        [("d", at(61)), ("d", at(62))],
        [("c", at(2)), ("z", at(901))],  # c's decision comes when its time is long over
    ]
    for name, batches, schema in (("sent", sent, "id long, sk_id_curr string, created_at timestamp"), ("done", done, "sk_id_curr string, created_at timestamp")):
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
    streams = read("sent", "id long, sk_id_curr string, created_at timestamp"), read("done", "sk_id_curr string, created_at timestamp")
    latency.latency_job(*streams, f"{root}/out", f"{root}/check", "12 HOURS", "2 hours").awaitTermination()
    got = {r["submission"]: r["seconds"] for r in latency.read_latency(spark, f"{root}/out").collect()}
    assert got == {1: 3600.0, 2: None, 3: None, 4: 3600.0, 5: None, 6: 3600.0, 7: 3600.0, 8: 3600.0}
