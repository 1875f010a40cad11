"""Search over boosted trees on histograms: columns are binned once, every fit shares the bins.

Spark bins the columns (cut points are quantiles of the training rows), deals rows to folds
and sends the binned rows, a byte per feature, to the group of each pair of candidate and
fold; the fits run side by side, one task each. A fit adds up gradients by node, feature and
bin, so its cost is rows x features per level whatever the values. It scores the rows of the
fold it did not see, and Spark ranks these scores.

A fit holds at most ``max_rows`` labelled rows: beyond it the rows with the smallest hashes are
taken from each class in proportion. The bound is the only limit; rounds and candidates are whole.
"""

from __future__ import annotations

import itertools
import random
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numeric import col, ratio
from riskloom.operators.prepare import KEY, TARGET, category_codes, class_order, encode
from riskloom.operators.quantiles import attach
from riskloom.session import materialise

BINS = 64  # bin 0 holds what is missing
MAX_ROWS = 100_000
SHRINK = 1.0  # added to the sum of second derivatives
LEAST_WEIGHT = 1.0  # sum of second derivatives that a child needs


class Candidate(NamedTuple):
    rounds: int
    depth: int
    step: float
    rows: float  # share of the rows drawn for a tree
    columns: float  # share of the features drawn for a tree


def candidates(grid: dict[str, list], number: int, seed: int = 42) -> list[Candidate]:
    """As many distinct random points of ``grid`` (values per field of ``Candidate``)."""
    points = [Candidate(*p) for p in itertools.product(*(grid[f] for f in Candidate._fields))]
    return random.Random(seed).sample(points, min(number, len(points)))


def best_splits(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the feature and the last bin of the left child with the greatest gain, and that
    gain, from sums by (node, feature, bin)."""
    gl, hl = grad.cumsum(2), hess.cumsum(2)
    g, h = gl[:, :, -1:], hl[:, :, -1:]
    gl, hl = gl[:, :, :-1], hl[:, :, :-1]
    gain = gl**2 / (hl + SHRINK) + (g - gl) ** 2 / (h - hl + SHRINK) - g**2 / (h + SHRINK)
    gain[(hl < LEAST_WEIGHT) | (h - hl < LEAST_WEIGHT)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    return best // gain.shape[2], best % gain.shape[2], flat[np.arange(len(flat)), best]


def boost(bins: np.ndarray, label: np.ndarray, train: np.ndarray, how: Candidate, seed: int = 42) -> np.ndarray:
    """Margins of all rows after trees fitted on the ``train`` rows of ``bins`` (rows x features)."""
    rng = np.random.default_rng(seed)
    n, width = bins.shape
    drawn = max(1, round(width * how.columns))
    margin, pick = np.zeros(n), np.flatnonzero(train)
    for _ in range(how.rounds):
        own = pick if how.rows >= 1 else pick[rng.random(len(pick)) < how.rows]
        columns = np.sort(rng.choice(width, drawn, replace=False))
        chance = 1 / (1 + np.exp(-margin[own]))
        grad, hess = chance - label[own], chance * (1 - chance)
        at = np.arange(drawn) * BINS + bins[np.ix_(own, columns)]
        node = np.zeros(n, np.int64)
        for level in range(how.depth):
            place = (node[own, None] * (drawn * BINS) + at).ravel()
            sums = [np.bincount(place, np.repeat(w, drawn), (drawn * BINS) << level).reshape(-1, drawn, BINS) for w in (grad, hess)]
            feature, last, gain = best_splits(*sums)
            last[~(gain > 0)] = BINS  # all rows stay on the left
            node = 2 * node + (bins[np.arange(n), columns[feature[node]]] > last[node])
        g, h = (np.bincount(node[own], w, 1 << how.depth) for w in (grad, hess))
        margin -= how.step * (g / (h + SHRINK))[node]
    return margin


def binned(df: DataFrame, numeric: list[str], categorical: list[str], label: str = TARGET, key: str = KEY) -> DataFrame:
    """Rows (key, label, bins): a byte per feature. Numbers by quantile cuts, categories by
    their codes modulo the bins; 0 for what is missing."""
    rows = df.select(key, label, *[col(c).cast("double").alias(c) for c in numeric], *categorical)
    if categorical:
        rows = encode(rows, materialise(category_codes(rows, categorical), "codes"), categorical)
    shares = [k / (BINS - 1) for k in range(1, BINS - 1)]
    cuts = rows.agg(*[F.array_distinct(F.percentile_approx(c, shares, 10_000)).alias(c) for c in numeric]).select(F.struct("*")).scalar()
    rows = attach(rows, cuts, "_cuts")

    def place(c: str):
        return F.when(F.col(c).isNull(), 0).otherwise(1 + F.size(F.filter(F.col("_cuts")[c], lambda cut: cut < F.col(c))))

    codes = [place(c) for c in numeric] + [F.when(F.col(c) < 0, 0).otherwise(1 + F.col(c) % (BINS - 1)) for c in categorical]
    byte = [F.unhex(F.lpad(F.hex(c.cast("int")), 2, "0")) for c in codes]
    return rows.select(key, F.col(label).cast("int").alias("label"), F.concat(*byte).alias("bins"))


def _fit(points: list[Candidate], seed: int):
    def run(keys: tuple, table: pa.Table) -> pa.Table:
        candidate, fold = (k.as_py() for k in keys)
        # rows come in no order: sort, so that draws are the same on any cluster
        table = table.sort_by("key")
        bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(table.num_rows, -1).astype(np.int64)
        label, folds = np.asarray(table.column("label")), np.asarray(table.column("part"))
        margin = boost(bins, label, folds != fold, points[candidate], seed)
        held = pa.array(folds == fold)
        out = pa.table({"candidate": pa.array([candidate] * table.num_rows, pa.int32()), "fold": pa.array([fold] * table.num_rows, pa.int32()), "label": table.column("label"), "score": pa.array(1 / (1 + np.exp(-margin)))})
        return out.filter(held)

    return run


def _auc(scored: DataFrame) -> DataFrame:
    """AUC per candidate and fold; a fold holds at most ``max_rows`` rows."""
    one = F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    fold = Window.partitionBy("candidate", "fold")
    lower = F.sum("neg").over(fold.orderBy("score").rowsBetween(Window.unboundedPreceding, 0)) - F.col("neg") * 0.5
    ranked = scored.groupBy("candidate", "fold", "score").agg(*one).withColumn("lower", lower)
    return ranked.groupBy("candidate", "fold").agg(ratio(F.sum(F.col("pos") * F.col("lower")), F.sum("pos") * F.sum("neg").cast("double")).alias("auc"))


def search(rows: DataFrame, points: list[Candidate], folds: int = 3, key: str = KEY, max_rows: int = MAX_ROWS, seed: int = 42) -> DataFrame:
    """Per candidate the mean of its folds' AUC, for ``rows`` of ``binned``: candidate, mean_auc.
    Folds are even within each class."""
    ordered = materialise(class_order(rows.select(F.col(key).alias("key"), "label", "bins"), "key", "label", seed), "ordered")
    total = ordered.agg(F.count(F.lit(1)).cast("double")).scalar()
    taken = ordered.where(F.col("place") * total < F.lit(float(max_rows)) * F.col("class_rows"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("candidate"), F.lit(f).alias("fold")) for c in range(len(points)) for f in range(folds)]))
    sent = taken.select("key", "label", "bins", (F.col("place") % folds).cast("int").alias("part"), pairs.alias("p")).select("key", "label", "bins", "part", "p.*")
    fits = sent.repartition(4 * len(points) * folds, "candidate", "fold").groupBy("candidate", "fold")
    scored = materialise(fits.applyInArrow(_fit(points, seed), "candidate int, fold int, label int, score double"), "scored")
    return _auc(scored).groupBy("candidate").agg(F.avg("auc").alias("mean_auc"))
