"""Rank statistics over scores at scale.

Rows are first collapsed to one per distinct score (a hot score becomes one row).
Running totals over the remaining scores never use one global window: scores fall
into a fixed number of equal-width buckets, only the bucket totals (at most
``BUCKETS`` rows, whatever the data size) are accumulated in one place, and each
bucket accumulates its own scores in parallel on top of its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numeric import col, ratio

BUCKETS = 65_536


def score_totals(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: positives and negatives."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(col(label) == 1).alias("pos"), F.count_if(col(label) != 1).alias("neg")
    )


def running_totals(
    totals: DataFrame, measures: list[str], descending: bool = False, low: float = 0.0, high: float | Column = 1.0
) -> DataFrame:
    """Add ``cum_<measure>`` (inclusive) over ``score`` in the given order, plus
    ``next`` = the measures of the following score and ``all_<measure>``.

    ``low``/``high`` say where most scores lie; scores outside fall in the end
    buckets and stay exact.
    """
    position = F.floor((F.col("score") - low) / (F.lit(high) if isinstance(high, float) else high - low) * BUCKETS)
    bucketed = totals.withColumn("bucket", F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), position)))
    order = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    first_of = F.max_by if descending else F.min_by
    every = Window.partitionBy()
    before = Window.orderBy(order("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        bucketed.groupBy("bucket")
        .agg(*[F.sum(m).alias(m) for m in measures], first_of(F.struct(*measures), "score").alias("head"))
        .select(
            "bucket",
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"before_{m}") for m in measures],
            *[F.sum(m).over(every).alias(f"all_{m}") for m in measures],
            F.lead("head").over(Window.orderBy(order("bucket"))).alias("next_head"),
        )
    )
    inside = Window.partitionBy("bucket").orderBy(order("score"))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        bucketed.join(F.broadcast(edges), "bucket")  # at most BUCKETS rows
        .select(
            "score",
            *measures,
            *[f"all_{m}" for m in measures],
            *[(F.sum(m).over(upto) + F.col(f"before_{m}")).alias(f"cum_{m}") for m in measures],
            F.coalesce(F.lead(F.struct(*measures)).over(inside), F.col("next_head")).alias("next"),
        )
    )


def auc(totals: DataFrame, high: float | Column = 1.0) -> DataFrame:
    """Area under the ROC curve as the Mann-Whitney statistic; ties count half."""
    ranked = running_totals(totals, ["pos", "neg"], high=high)
    below = F.col("cum_neg") - F.col("neg") * 0.5
    return ranked.agg(ratio(F.sum(F.col("pos") * below), F.max("all_pos") * F.max("all_neg").cast("double")).alias("auc"))


def roc_curve(totals: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """``threshold``, ``fpr``, ``tpr`` from the highest score down, after the (0, 0)
    start at an infinite threshold. Points on a straight line may be left out."""
    ranked = running_totals(totals, ["pos", "neg"], descending=True)
    if drop_intermediate:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        last = F.col("next").isNull()
        bend = (F.col("next.pos") != F.col("pos")) | (F.col("next.neg") != F.col("neg"))
        ranked = ranked.where(first | last | bend)
    points = ranked.select(
        F.col("score").alias("threshold"),
        ratio("cum_neg", "all_neg").alias("fpr"),
        ratio("cum_pos", "all_pos").alias("tpr"),
    )
    start = totals.agg(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def pr_points(totals: DataFrame) -> DataFrame:
    """Precision and recall when everything at or above each score is positive."""
    ranked = running_totals(totals, ["pos", "neg"], descending=True)
    return ranked.select(
        F.col("score").alias("threshold"),
        ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        ratio("cum_pos", "all_pos").alias("recall"),
        ratio("pos", "all_pos").alias("gain"),
    )


def pr_curve(totals: DataFrame) -> DataFrame:
    """Precision-recall points plus the closing point (1, 0) without threshold."""
    closing = totals.agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return pr_points(totals).drop("gain").unionByName(closing)


def average_precision(totals: DataFrame) -> DataFrame:
    return pr_points(totals).agg(F.sum(F.col("gain") * F.col("precision")).alias("average_precision"))


def best_f1(totals: DataFrame) -> DataFrame:
    """The threshold with the highest F1 (the lowest such threshold on ties)."""
    p, r = F.col("precision"), F.col("recall")
    scored = pr_points(totals).withColumn("f1", 2 * (p * r) / (p + r + 1e-8))
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("m"), "precision", "recall")).alias("best")
    return scored.agg(best).select(
        (-F.col("best.m")).alias("threshold"), "best.f1", "best.precision", "best.recall"
    )


def ks_statistic(totals: DataFrame, a: str, b: str) -> DataFrame:
    """Largest distance between two cumulative distributions over ``score``."""
    ranked = running_totals(totals, [a, b])
    gap = F.abs(ratio(f"cum_{a}", f"all_{a}") - ratio(f"cum_{b}", f"all_{b}"))
    return ranked.agg(F.max(gap).alias("ks"))


def ordinal_rank(df: DataFrame, score: str, key: str, rank: str, block: int = 1_000_000) -> DataFrame:
    """``key`` and 0-based ``rank`` by (score, key), unique even among ties.

    Ties are ranked by key inside key blocks, so that a score shared by a third of
    all rows is spread over many tasks: rank = rows with a lower score + equal rows
    in lower blocks + position in the block (at most ``block`` rows, keys unique).
    """
    rows = df.select(key, F.col(score).alias("score"), F.floor(F.col(key) / block).alias("key_block"))
    blocks = rows.groupBy("score", "key_block").agg(F.count(F.lit(1)).alias("n"))
    lower = running_totals(blocks.groupBy("score").agg(F.sum("n").alias("n")), ["n"]).select(
        "score", (F.col("cum_n") - F.col("n")).alias("lower")
    )
    earlier = Window.partitionBy("score").orderBy("key_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(lower, "score")
        .select("score", "key_block", (F.col("lower") + F.col("earlier")).alias("start"))
    )
    position = F.row_number().over(Window.partitionBy("score", "key_block").orderBy(key)) - 1
    return rows.join(starts, ["score", "key_block"]).select(key, (F.col("start") + position).alias(rank))
