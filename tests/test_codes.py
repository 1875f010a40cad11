"""Category dictionaries: dense codes over ranges, put back without a hot task."""

import random

from pyspark.sql import functions as F

from riskloom.operators import prepare


def test_codes_like_sorted_values(spark):
    rng = random.Random(1)
    values = [None, "", "a", "a\x00b", "é", "漢字", "Z", "z", "10", "9", "common" * 3]
    rows = [(k, "hot" if rng.random() < 0.5 else rng.choice(values), rng.choice(values), rng.choice([1, 2, 30, None])) for k in range(4000)]
    seen = rows[:3000]
    names = ["a", "b", "n"]
    df, fitted = (spark.createDataFrame(r, "k int, a string, b string, n int").repartition(5) for r in ([*rows, (-1, "new", "hot", 77)], seen))
    got = {r["k"]: tuple(r)[1:] for r in prepare.ordinal_encode(df, fitted, names).collect()}
    codes = [{v: i for i, v in enumerate(sorted({str(r[j]) for r in seen if r[j] is not None}, key=lambda v: v.encode()))} for j in (1, 2, 3)]
    assert got == {r[0]: tuple(codes[j - 1].get(None if r[j] is None else str(r[j]), -1) for j in (1, 2, 3)) for r in [*rows, (-1, "new", "hot", 77)]}
    found = {(r["column"], r["value"]): r["hot"] for r in prepare.category_codes(fitted, names).collect()}
    assert found["a", "hot"] and len(found) == sum(map(len, codes))


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, a string")
    assert sorted(map(tuple, prepare.ordinal_encode(df, df, ["a"]).collect())) == [(1, -1), (2, -1)]
    assert prepare.ordinal_encode(df.limit(0), df, ["a"]).count() == 0


def test_millions_with_one_start(spark):
    """Values that share a long start are spread evenly over the ranges."""
    n = 3_000_000
    df = spark.range(0, n, 1, 4).select(F.format_string("customer-%08d", F.col("id")).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        codes = prepare.category_codes(df, ["a"])
        wrong = codes.where(F.col("code") != F.substring("value", 10, 8).cast("long")).count()
        largest = codes.inputFiles()
        sizes = [r["count"] for r in codes.sparkSession.read.parquet(*largest).groupBy("range").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert wrong == 0 and codes.count() == n and len(sizes) == 4 and max(sizes) < 1.5 * n / 4
