"""Model evaluation tables from scored rows (label 0/1 and a probability)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import col, ratio
from riskloom.operators import ranking


def accuracy(df: DataFrame, label: str, score: str, threshold: float = 0.3) -> DataFrame:
    hit = (col(score) >= threshold).cast("int") == col(label)
    return df.agg(F.avg(hit.cast("int")).alias("accuracy"))


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.3) -> DataFrame:
    return df.groupBy(col(label).alias("actual"), (col(score) >= threshold).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.3) -> DataFrame:
    """Precision, recall, F1 and support per class, and their macro and weighted
    averages. One pass; a class never predicted has precision 0."""
    actual, predicted = col(label) == 1, col(score) >= threshold
    counts = df.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )

    def part(n: Column, d: Column) -> Column:
        return F.coalesce(ratio(n, d), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    classes = {"Repay": (tn, fn, fp), "Default": (tp, fp, fn)}
    rows, scored = [], {}
    for name, (right, wrong, missed) in classes.items():
        p, r = part(right, right + wrong), part(right, right + missed)
        scored[name] = (p, r, part(2 * p * r, p + r), right + missed)
    total, per_class = tp + fp + fn + tn, list(scored.values())
    for name, how in (("macro avg", lambda s: F.lit(0.5)), ("weighted avg", lambda s: ratio(s, total))):
        parts = [[v[i] * how(v[3]) for v in per_class] for i in range(3)]
        scored[name] = (*[reduce(lambda a, b: a + b, p) for p in parts], total)
    for name, (p, r, f1, n) in scored.items():
        rows.append(
            F.struct(
                F.lit(name).alias("class"),
                p.alias("precision"),
                r.alias("recall"),
                f1.alias("f1_score"),
                n.cast("bigint").alias("support"),
            )
        )
    return counts.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and share of positives per equal-width bin (empty bins left out); a
    score on an inner edge belongs to the lower bin."""
    edges = F.array(*[F.lit(i * (1.0 / bins)) for i in range(1, bins)])
    bin_of = F.size(F.filter(edges, lambda e: e < col(score)))
    return df.groupBy(bin_of.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"),
        F.avg(label).alias("fraction_positive"),
        F.count(F.lit(1)).alias("rows"),
    )


def sweep_thresholds(low: float = 0.05, high: float = 0.95, steps: int = 50) -> list[float]:
    step = (high - low) / (steps - 1)
    return [low + i * step for i in range(steps - 1)] + [high]


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float] | None = None) -> DataFrame:
    """Approval rate and default rate among the approved for each threshold.

    Scores are counted per gap between thresholds in one aggregate (at most one row
    per threshold plus one), then accumulated: no row meets every threshold.
    """
    cuts = thresholds or sweep_thresholds()
    listed = F.array(*[F.lit(t) for t in cuts])
    gap = F.size(F.filter(listed, lambda t: t <= F.col("score")))
    gaps = (
        ranking.score_totals(df, score, label)
        .groupBy(gap.alias("gap"))
        .agg(F.sum(F.col("pos") + F.col("neg")).alias("rows"), F.sum("pos").alias("bad"))
    )
    table = gaps.agg(F.collect_list(F.struct("gap", "rows", "bad")).alias("gaps"))
    position = table.select("gaps", F.posexplode(listed).alias("i", "threshold"))

    def below(field: str) -> Column:
        kept = F.filter("gaps", lambda g: g["gap"] <= F.col("i"))
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda s, g: s + g[field])

    everyone = F.aggregate("gaps", F.lit(0).cast("bigint"), lambda s, g: s + g["rows"])
    return position.select(
        "threshold",
        ratio(below("rows"), everyone).alias("approval_rate"),
        F.coalesce(ratio(below("bad"), below("rows")), F.lit(0.0)).alias("default_rate_approved"),
    )


def mean_score(df: DataFrame, models: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [col(m) for m in models]) / len(models)


def model_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking.auc(ranking.score_totals(df, score, label))


def weighted_score(df: DataFrame, label: str, models: list[str]) -> Column:
    """Mean of the models weighted by their AUC (scalar subqueries)."""
    aucs = {m: model_auc(df, label, m).scalar() for m in models}
    total = reduce(lambda a, b: a + b, aucs.values())
    return reduce(lambda a, b: a + b, [col(m) * (aucs[m] / total) for m in models])


def votes(df: DataFrame, label: str, models: list[str]) -> list[Column]:
    """0/1 vote of each model at its own best-F1 threshold."""
    cuts = {m: ranking.best_f1(ranking.score_totals(df, m, label)).select("threshold").scalar() for m in models}
    return [(col(m) >= cuts[m]).cast("int") for m in models]


def majority_vote(df: DataFrame, key: str, label: str, models: list[str]) -> DataFrame:
    """Hard majority and the share of models voting for it."""
    cast = reduce(lambda a, b: a + b, votes(df, label, models))
    return df.select(
        key,
        label,
        (cast > len(models) / 2).cast("int").alias("majority"),
        ratio(cast, F.lit(len(models))).alias("confidence"),
    )


def mean_rank(df: DataFrame, key: str, label: str, models: list[str]) -> DataFrame:
    """Mean over the models of each row's ordinal rank by score."""
    out = df.select(key, label)
    for m in models:
        out = out.join(ranking.ordinal_rank(df, m, key, f"rank_{m}"), key)
    return out.select(key, label, mean_score(out, [f"rank_{m}" for m in models]).alias("mean_rank"))
