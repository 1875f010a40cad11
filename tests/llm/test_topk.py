"""Ranks against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm.topk import top_k


def brute(rows, k=5):
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i % 50 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in good if j != i))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block_rows", [(10_000, 10_000), (90, 3)])
def test_like_brute_force(spark, shard_rows, block_rows):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(400)]
    hot = rows[7][1]
    rows += [(400 + i, hot) for i in range(150)]
    rows += [(550, None), (551, [None] * 8), (552, [float("nan")] * 8), (600, [float("inf")] * 8), (650, [1.0]), (651, []), (700, [0.0] * 8), (None, hot), (750, [3e9, -3e9, 1.0]), (751, [3e9] * 8)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, shard int")
    got = top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_rows=block_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_few_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (0, [5.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 50 == 0).collect())) == [(0, 1, 1, 256 * 512), (0, 1, 1, 5 * 256 * 512)]
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("shard_rows, block_rows", [(10_000, 10_000), (5, 2)])
@pytest.mark.parametrize("repeats", [1, 2, 3, 6, 20])
def test_repeated_query_among_copies(spark, repeats, shard_rows, block_rows):
    near, far = [1.0, 0.5], [0.25, 0.25]
    rows = [(50, near)] * repeats + [(j, near) for j in (51, 52, 53, 53, 54, 55)] + [(100, near)] * 2 + [(j, far) for j in range(10, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows)
