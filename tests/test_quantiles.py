"""Selected ranks against sorted columns, with many distinct values and hot ones."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import quantiles as Q

SHARES = [0.0, 0.001, 0.25, 0.5, 0.999, 1.0]


def want(values, p, method):
    v, n = np.sort(np.array(values)), len(values)
    at = p * (n - 1)
    if method == "nearest":
        return v[round(at)]
    if method == "discrete":
        return v[max(math.ceil(p * n), 1) - 1]
    low = math.floor(at)
    return v[low] + (at - low) * (v[min(low + 1, n - 1)] - v[low]) if at > low else v[low]


@pytest.mark.parametrize("method", ["linear", "nearest", "discrete"])
@pytest.mark.parametrize("left", [3, 1000])
def test_like_sorted_columns(spark, monkeypatch, method, left):
    monkeypatch.setattr(Q, "LEFT", left)
    rng = np.random.default_rng(3)
    n = 4000
    columns = {
        "even": rng.random(n),
        "skewed": np.exp2(-np.arange(n) / 4.0),
        "hot": np.where(rng.random(n) < 0.6, 7.0, rng.integers(0, 50, n)),
        "wide": np.concatenate([rng.normal(0, 1e300, n - 4), [np.inf, -np.inf, 1.7e308, -1.7e308]]),
        "one": np.full(n, 5.0),
    }
    rows = [tuple(float(x) for x in r) for r in zip(*columns.values(), strict=True)]
    df = spark.createDataFrame([(*r, None) for r in rows], ", ".join(f"{c} double" for c in [*columns, "none"]))
    got = {r["column"]: r for r in Q.exact_quantiles(df, [*columns, "none"], SHARES, method).collect()}
    assert set(got) == set(columns)
    for c, values in columns.items():
        inner = SHARES[1:-1] if c == "wide" else SHARES
        assert got[c]["n"] == n
        for p in inner:
            assert got[c][f"q{SHARES.index(p)}"] == pytest.approx(want(values, p, method), rel=1e-12), (c, p)


@pytest.mark.parametrize("n", [857, 900, 250])
def test_rank_beside_its_band(spark, n):
    values = [float(k) for k in range(n)]
    (row,) = Q.exact_quantiles(spark.createDataFrame([(v,) for v in values], "a double"), ["a"], [0.01, 0.5, 0.99], "nearest").collect()
    assert [row[f"q{i}"] for i in range(3)] == [want(values, p, "nearest") for p in (0.01, 0.5, 0.99)]


def test_millions_of_distinct_values(spark, monkeypatch):
    """No window holds more than the fixed number of values."""
    seen = []
    select = Q._select

    def watched(kept, ranks):
        seen.append(kept.groupBy("column").count().agg(F.max("count")).first()[0])
        return select(kept, ranks)

    monkeypatch.setattr(Q, "_select", watched)
    n = 5_000_000
    df = spark.range(0, n, 1, 4).select((F.col("id") * 7919 % n).cast("double").alias("a"))
    (row,) = Q.exact_quantiles(df, ["a"], [0.1, 0.5], "discrete").collect()
    assert (row["n"], row["q0"], row["q1"]) == (n, n * 0.1 - 1, n * 0.5 - 1) and seen[0] > 2 * Q.LEFT
