"""Exact quantiles by selection in narrowing ranges; no task holds a column's values.

A sketch first brackets each quantile in a narrow band; one pass then counts whole zones
between the bands and keeps values, each with its count, only inside them. The values kept
grow with the data, if slowly, so the wanted ranks are sought in ranges: a range is cut
into ``CUTS`` parts, the parts are counted, and the part that holds the rank is the next range,
until it has at most ``LEFT`` values. These alone are put in order. A rank wanted twice (a
value and its successor) is sought twice. The driver sees one row per column and rank, and
the result does not depend on the sketch's error: a rank outside its band raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialise

CUTS, LEFT = 256, 1_000
_ACCURACY = 10_000


def _rank(n: Column, p: float, method: str) -> tuple[Column, Column]:
    """1-based rank of the lower value and the weight of its successor."""
    position = F.lit(float(p)) * (n - 1)
    if method == "linear":
        return F.floor(position) + 1, position - F.floor(position)
    if method == "nearest":
        return F.rint(position).cast("bigint") + 1, F.lit(0.0)
    if method == "discrete":
        return F.greatest(F.ceil(F.lit(float(p)) * n), F.lit(1)), F.lit(0.0)
    raise ValueError(f"unknown quantile method {method!r}")


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], method: str = "linear"
) -> DataFrame:
    """One row per column: ``column``, ``n`` (non-NULL values), ``q0``, ``q1``, ...

    ``linear`` interpolates, ``nearest`` takes the nearest rank (half to even),
    ``discrete`` the first value whose cumulative share reaches the probability.
    """
    margin = 2.0 / _ACCURACY
    wanted = sorted(set(probabilities))
    edges = [min(max(p + d, 0.0), 1.0) for p in wanted for d in (-margin, margin)]
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sketch = numeric.agg(
        *[F.percentile_approx(c, edges, _ACCURACY).alias(f"b{i}") for i, c in enumerate(columns)]
    ).select(F.struct("*").alias("bands"))
    numeric = attach(numeric, sketch.scalar(), "_bands")

    def located(i: int, name: str) -> Column:
        """(column, zone, value): value only inside a band, else the zone between."""
        value, cut = F.col(name), F.col("_bands").getField(f"b{i}")
        zone = F.lit(len(wanted))
        inside = F.lit(None).cast("double")
        for k in reversed(range(len(wanted))):
            low, high = cut[2 * k], cut[2 * k + 1]
            inside = F.when(value < low, None).when(value <= high, value).otherwise(inside)
            zone = F.when(value < low, F.lit(k)).otherwise(zone)
        return F.struct(F.lit(name).alias("column"), zone.alias("zone"), inside.alias("inside"), value.alias("value"))

    entries = numeric.select(F.explode(F.array(*[located(i, c) for i, c in enumerate(columns)])).alias("e")).select(
        "e.column", F.when(F.col("e.inside").isNull(), F.col("e.zone")).alias("zone"), "e.inside", "e.value"
    )
    kept = materialise(
        entries.where("value IS NOT NULL")
        .groupBy("column", "zone", "inside")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
        .drop("zone", "inside"),
        "bands",
    )
    totals = kept.groupBy("column").agg(F.sum("rows").alias("n"))
    sought = [_rank(F.col("n"), p, method) for p in probabilities]
    after = lambda rank: F.least(rank + 1, F.col("n")) if method == "linear" else rank
    ranks = F.array(*[r for rank, _ in sought for r in (rank, after(rank))])
    wanted_ranks = totals.select("column", F.posexplode(ranks).alias("target", "rank"))
    found = _select(kept, wanted_ranks)
    values = [F.max(F.when(F.col("target") == t, F.col("value"))).alias(f"v{t}") for t in range(2 * len(sought))]
    wide = totals.join(found.groupBy("column").agg(*values), "column")
    results = []
    for i, (_, weight) in enumerate(sought):
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        results.append((low + weight * (high - low) if method == "linear" else low).alias(f"q{i}"))
    return wide.select("column", "n", *results)


def _select(kept: DataFrame, ranks: DataFrame) -> DataFrame:
    """``ranks`` (column, target, 1-based rank) with the value at each rank of ``kept`` (column,
    rows, low, high: a single value, or a zone between bands)."""
    spark, targets = kept.sparkSession, ["column", "target"]
    span = [F.sum("rows").alias("n"), F.count(F.lit(1)).alias("entries"), F.min("low").alias("first"), F.max("low").alias("last")]
    state = kept.groupBy("column").agg(*span).join(ranks, "column").drop("n")
    schema = "column string, target int, rank long, entries long, first double, last double"
    rows = state.select("column", "target", F.col("rank").cast("long"), "entries", "first", "last").collect()
    while any(r["entries"] > LEFT for r in rows):
        state = spark.createDataFrame(rows, schema)
        wide = F.col("last") / 2 - F.col("first") / 2
        part = F.least(F.floor((F.col("low") / 2 - F.col("first") / 2) / wide * CUTS), F.lit(CUTS - 1))
        part = F.when(F.abs(wide) < float("inf"), part).otherwise(1)  # between infinite ends
        part = F.when(F.col("low") == F.col("last"), CUTS - 1).when(F.col("low") == F.col("first"), 0).otherwise(part)
        inside = kept.join(F.broadcast(state), "column").where(F.col("low").between(F.col("first"), F.col("last")))  # a row per column and rank
        parts = inside.groupBy(*targets, "rank", part.alias("part")).agg(*span)
        before = F.sum("n").over(Window.partitionBy(*targets).orderBy("part")) - F.col("n")
        hit = parts.withColumn("before", before).where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
        rows = hit.select("column", "target", (F.col("rank") - F.col("before")).alias("rank"), "entries", "first", "last").collect()
    state = spark.createDataFrame(rows, schema)
    inside = kept.join(F.broadcast(state), "column").where(F.col("low").between(F.col("first"), F.col("last")))
    upto = F.sum("rows").over(Window.partitionBy(*targets).orderBy("low"))
    hit = inside.withColumn("upto", upto).where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("rows")))
    value = (
        F.when(F.col("rank") == F.col("upto") - F.col("rows") + 1, F.col("low"))
        .when(F.col("rank") == F.col("upto"), F.col("high"))
        .when(F.col("low") == F.col("high"), F.col("low"))
        .otherwise(F.raise_error(F.lit("quantile outside its sketch band")).cast("double"))
    )
    return hit.select(*targets, value.alias("value"))


def as_row(quantiles: DataFrame, columns: list[str], fields: list[str]) -> Column:
    """The per-column results as a scalar subquery: ``row[column][field]``. It holds
    one value per column and field, so its size is fixed by the schema."""
    picked = quantiles.agg(
        *[
            F.max(F.when(F.col("column") == c, F.struct(*[F.col(f) for f in fields]))).alias(c)
            for c in columns
        ]
    )
    return picked.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("fitted")).scalar()


def attach(df: DataFrame, fitted: Column, name: str = "_fitted") -> DataFrame:
    """Put a scalar subquery in a column. Used many times over, the subquery itself
    would be planned once per use."""
    return df.select("*", fitted.alias(name))
