"""Trees on histograms against plain searches, folds and splits against their definitions."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from riskloom.operators import boosting as B
from riskloom.operators import prepare


def plain_split(bins, grad, hess):
    """The greatest gain over all features and cuts, by sums over rows."""
    best = (-np.inf, None, None)
    for f in range(bins.shape[1]):
        for cut in range(B.BINS - 1):
            left = bins[:, f] <= cut
            gl, hl, gr, hr = grad[left].sum(), hess[left].sum(), grad[~left].sum(), hess[~left].sum()
            if hl >= B.LEAST_WEIGHT and hr >= B.LEAST_WEIGHT:
                gain = gl**2 / (hl + B.SHRINK) + gr**2 / (hr + B.SHRINK) - (gl + gr) ** 2 / (hl + hr + B.SHRINK)
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut)
    return best


def plain_boost(bins, label, train, how):
    """Trees grown node by node over lists of rows, all rows and features drawn."""
    margin = np.zeros(len(label))
    for _ in range(how.rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - label, p * (1 - p)

        def grow(rows, depth):
            own = rows[train[rows]]
            gain, f, cut = plain_split(bins[own], grad[own], hess[own]) if depth else (0, None, None)
            if not depth or gain <= 0:
                margin[rows] -= how.step * grad[own].sum() / (hess[own].sum() + B.SHRINK)
                return
            left = bins[rows, f] <= cut
            grow(rows[left], depth - 1)
            grow(rows[~left], depth - 1)

        grow(np.arange(len(label)), how.depth)
    return margin


@pytest.mark.parametrize("depth", [1, 3])
def test_boost(depth):
    rng = np.random.default_rng(depth)
    bins = rng.integers(0, B.BINS, (300, 4))
    label = (bins[:, 0] + bins[:, 2] + rng.normal(0, 20, 300) > 60).astype(int)
    train = rng.random(300) < 0.7
    how = B.Candidate(6, depth, 0.3, 1.0, 1.0)
    assert B.boost(bins, label, train, how) == pytest.approx(plain_boost(bins, label, train, how), abs=1e-9)


def test_margins_do_not_see_held_rows():
    rng = np.random.default_rng(1)
    bins, label, train = rng.integers(0, B.BINS, (200, 3)), rng.integers(0, 2, 200), rng.random(200) < 0.5
    how = B.Candidate(10, 4, 0.1, 0.8, 0.6)
    assert (B.boost(bins, label, train, how) == B.boost(bins, np.where(train, label, 1 - label), train, how)).all()


def test_search(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(900):
        a, b, c = rng.random(), rng.random(), rng.choice(["x", "y", None])
        rows.append((k, float(rng.random() < (0.9 if a > 0.5 else 0.1)), None if k % 9 == 0 else a, b, c))
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET double, a double, b double, c string")
    points = B.candidates({"rounds": [5, 40], "depth": [2], "step": [0.1], "rows": [0.8, 1.0], "columns": [1.0]}, 3)
    bins = B.binned(df, ["a", "b"], ["c"])
    assert {len(r["bins"]) for r in bins.collect()} == {3}
    got = {r["candidate"]: r["mean_auc"] for r in B.search(bins, points).collect()}
    assert sorted(got) == [0, 1, 2] and all(0.75 < v < 0.95 for v in got.values())
    assert got == {r["candidate"]: r["mean_auc"] for r in B.search(bins.repartition(7), points).collect()}
    assert B.search(bins, points, max_rows=200).count() == 3


@pytest.mark.parametrize("share", [0.2, 0.5])
def test_split_is_exact_per_class(spark, share):
    rows = [(k, (0, 1, None)[0 if k % 10 else 1 + k % 20 // 10]) for k in range(3000)] + [(None, 0)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int").repartition(5)
    got = prepare.assign_split(df, "SK_ID_CURR", test_share=share).collect()
    assert Counter(tuple(r)[:2] for r in got) == Counter(rows)
    order = lambda k: (hashlib.md5(f"{'' if k is None else k}|42".encode()).hexdigest()[:8], k or 0)
    for label in (0, 1, None):
        keys = sorted((k for k, t in rows if t == label), key=order)
        test = {r["SK_ID_CURR"] for r in got if r["TARGET"] == label and r["split"] == "test"}
        assert test == set(keys[: int(share * len(keys) + 0.5)])
