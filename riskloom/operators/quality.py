"""Data-quality tests, profiles of missing and extreme values, drift."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.numeric import col, ratio
from riskloom.operators.quantiles import as_row, attach, exact_quantiles
from riskloom.operators.ranking import ks_statistic


@dataclass(frozen=True)
class Check:
    """A row-level test: ``failing`` marks the offending rows of ``column``."""

    test: str
    column: str
    failing: Column


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c, col(c).isNull()) for c in columns]


def accepted_values(column: str, values: list) -> Check:
    """NULL passes, as in SQL."""
    return Check("accepted_values", column, ~col(column).isin(values))


def expression_is_true(column: str, condition: Column, where: Column | None = None) -> Check:
    failing = ~F.coalesce(condition, F.lit(False))
    return Check("expression_is_true", column, failing if where is None else where & failing)


def _long(row: DataFrame, name: str, entries: list[tuple[str, list[Column]]]) -> DataFrame:
    """Turn a one-row result into one row per entry."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias(name), *cs) for k, cs in entries])).alias("e")).select("e.*")


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``test``, ``column``, ``failures`` for all row-level tests in one pass."""
    counts = df.agg(*[F.count_if(c.failing).alias(f"f{i}") for i, c in enumerate(checks)])
    found = F.array(
        *[
            F.struct(F.lit(c.test).alias("test"), F.lit(c.column).alias("column"), F.col(f"f{i}").alias("failures"))
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.explode(found).alias("e")).select("e.*")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that occur more than once (NULL aside)."""
    return df.where(col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def unique(df: DataFrame, key: str) -> DataFrame:
    return duplicate_keys(df, key).agg(
        F.lit("unique").alias("test"), F.lit(key).alias("column"), F.count(F.lit(1)).alias("failures")
    )


def _entries(df: DataFrame, columns: list[str], value, keep: list[str] = ()) -> DataFrame:
    """Long form: one row per (row, column) with ``name`` and ``value(column)``. Many
    columns then share one small aggregate, combined before the shuffle, instead of
    one huge aggregate whose code no longer compiles."""
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), value(c).alias("value")) for c in columns]))
    return df.select(*keep, entry.alias("e")).select(*keep, "e.name", "e.value")


def missing_summary(df: DataFrame) -> DataFrame:
    """NULL count and share of every column, most missing first."""
    absent = _entries(df, df.columns, lambda c: col(c).isNull())
    return (
        absent.groupBy(F.col("name").alias("column_name"))
        .agg(
            F.count_if("value").alias("missing_count"),
            F.round(ratio(F.count_if("value"), F.count(F.lit(1))), 4).alias("missing_proportion"),
        )
        .orderBy(F.col("missing_proportion").desc(), "column_name")
    )


def double_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType) and f.name not in exclude]


def extreme_scan(df: DataFrame, exclude: list[str], limit: float = 1e10) -> DataFrame:
    """Fractional columns with infinite values or values beyond +-``limit``."""
    columns = double_columns(df, exclude)
    row = df.agg(
        *[
            F.struct(
                F.min(c).alias("min"),
                F.max(c).alias("max"),
                F.count_if(F.abs(col(c)) == float("inf")).alias("inf_count"),
            ).alias(c)
            for c in columns
        ]
    )
    scanned = _long(row, "feature", [(c, [F.col(f"{c}.{k}") for k in ("min", "max", "inf_count")]) for c in columns])
    return scanned.where((F.col("inf_count") > 0) | (F.col("min") < -limit) | (F.col("max") > limit))


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, std, median and 95th percentile (nearest rank) per column."""
    row = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns])
    moments = _long(row, "feature", [(c, [F.col(f"{c}.mean"), F.col(f"{c}.std")]) for c in columns])
    ranks = exact_quantiles(df, columns, [0.5, 0.95], "nearest").select(
        F.col("column").alias("feature"), F.col("q0").alias("median"), F.col("q1").alias("p95")
    )
    return moments.join(F.broadcast(ranks), "feature", "left")  # one row per column


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of rows with a value, per column."""
    present = _entries(df, columns, lambda c: col(c).isNotNull())
    return present.groupBy(F.col("name").alias("feature")).agg(
        (F.avg(F.col("value").cast("int")) * 100).alias("coverage")
    )


def target_correlation(df: DataFrame, target: str, key: str) -> DataFrame:
    """Correlation of every numeric column with the target, strongest first;
    columns without one (constant or empty) are left out."""
    columns = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in (key, target)
    ]
    y = F.col("_y")
    x = F.when(y.isNotNull(), F.col("value"))
    both = F.when(F.col("value").isNotNull(), y)
    raw = F.col("raw_correlation")
    long = _entries(df.withColumn("_y", col(target).cast("double")), columns, lambda c: col(c).cast("double"), ["_y"])
    return (
        long.groupBy(F.col("name").alias("feature"))
        .agg(
            # corr() raises for a constant column under ANSI rules; this gives NULL
            ratio(F.covar_pop(both, x), F.stddev_pop(x) * F.stddev_pop(both)).alias("raw_correlation"),
            F.avg(F.col("value").isNull().cast("int")).alias("missing_rate"),
        )
        .where(raw.isNotNull() & ~F.isnan(raw))
        .select("feature", F.abs(raw).alias("correlation"), raw, "missing_rate")
        .orderBy(F.col("correlation").desc(), "feature")
    )


def categorical_deviation(
    df: DataFrame, target: str, exclude: list[str] = (), more_than: int = 100, missing_below: float = 0.8
) -> DataFrame:
    """Largest distance of a category's default rate from the overall rate, for text
    columns with at least two categories of more than ``more_than`` rows. An absent
    value is a category of its own."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    overall = df.agg(F.avg(target)).scalar()
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), col(c).alias("value")) for c in columns]))
    per_value = (
        df.select(col(target).alias("target"), entry.alias("e"))
        .groupBy("e.feature", "e.value")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("target").alias("rate"))
    )
    large = F.col("count") > more_than
    return (
        per_value.groupBy("feature")
        .agg(
            F.max(F.when(large, F.abs(F.col("rate") - overall))).alias("max_deviation"),
            F.count_if(large).alias("n_categories"),
            ratio(F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)), F.sum("count")).alias(
                "missing_rate"
            ),
        )
        .where((F.col("n_categories") > 1) & (F.col("missing_rate") < missing_below))
        .orderBy(F.col("max_deviation").desc(), "feature")
    )


def feature_groups(columns: list[str]) -> dict[str, list[str]]:
    """Columns that belong together: same name but for _AVG, _MODE or _MEDI."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        if re.search("_AVG|_MODE|_MEDI", c):
            groups.setdefault(re.sub("_AVG|_MODE|_MEDI", "", c), []).append(c)
    return groups


def grouped_missing(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add one column per group of at least two: ``<base>_AVAILABLE`` (0/1) where the
    first column is mostly missing, else ``<base>_CONSOLIDATED``, the _AVG column
    with its median for absent values. Which one it is depends on the data, so the
    missing rates (one row) are read first."""
    groups = {base: cs for base, cs in feature_groups(df.columns).items() if len(cs) > 1}
    if not groups:
        return df
    rates = df.agg(*[F.avg(col(cs[0]).isNull().cast("int")).alias(base) for base, cs in groups.items()]).first()
    averages = {base: next((c for c in cs if "_AVG" in c), None) for base, cs in groups.items()}
    filled = [averages[b] for b in groups if averages[b] and not (rates[b] is not None and rates[b] >= threshold)]
    if filled:
        df = attach(df, as_row(exact_quantiles(df, filled, [0.5]), filled, ["q0"]), "_medians")
    added = {}
    for base, cs in groups.items():
        if rates[base] is not None and rates[base] >= threshold:
            added[f"{base}_AVAILABLE"] = col(cs[0]).isNotNull().cast("int")
        elif averages[base]:
            added[f"{base}_CONSOLIDATED"] = F.coalesce(col(averages[base]), F.col("_medians")[averages[base]]["q0"])
    return df.withColumns(added).drop("_medians")


def psi(baseline: DataFrame, current: DataFrame, column: str, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index over baseline quantile bins; ``drifted`` above 0.2.
    Shares are floored so that an empty bin stays finite."""
    cuts = exact_quantiles(baseline.select(column), [column], [i / bins for i in range(1, bins)])
    edges = cuts.select(F.array(*[F.col(f"q{i}") for i in range(bins - 1)])).scalar()
    both = baseline.select(col(column).alias("v"), F.lit(1).alias("b"), F.lit(0).alias("c")).unionAll(
        current.select(col(column).alias("v"), F.lit(0).alias("b"), F.lit(1).alias("c"))
    )
    binned = (
        attach(both.where("v IS NOT NULL"), edges, "edges")
        .groupBy(F.size(F.filter("edges", lambda e: e < F.col("v"))).alias("bin"))
        .agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    )
    totals = binned.agg(F.sum("b").alias("b"), F.sum("c").alias("c")).select(F.struct("b", "c")).scalar()
    share_b = F.greatest(ratio("b", totals["b"]), F.lit(floor))
    share_c = F.greatest(ratio("c", totals["c"]), F.lit(floor))
    return binned.agg(F.sum((share_c - share_b) * F.log(share_c / share_b)).alias("psi")).withColumn(
        "drifted", (F.col("psi") > 0.2).cast("int")
    )


def ks_drift(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Kolmogorov-Smirnov distance between two populations of a score."""
    both = baseline.select(col(column).alias("score"), F.lit(1).alias("b"), F.lit(0).alias("c")).unionAll(
        current.select(col(column).alias("score"), F.lit(0).alias("b"), F.lit(1).alias("c"))
    )
    totals = both.where("score IS NOT NULL").groupBy("score").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    return ks_statistic(totals, "b", "c")
