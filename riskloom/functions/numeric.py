"""Arithmetic and aggregate shorthands. All return Columns and stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives NULL for a NULL or zero denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def share(condition: Column) -> Column:
    """Aggregate: fraction of the group's rows that satisfy ``condition``."""
    return ratio(F.count_if(condition), F.count(F.lit(1)))


def flag(condition: Column) -> Column:
    """0/1, NULL where the condition is NULL."""
    return condition.cast("int")


def sum_when(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, col(value)))


_STATS = {
    "TOTAL": F.sum,
    "MEAN": F.avg,
    "MAX": F.max,
    "MIN": F.min,
    "STD": F.stddev_samp,
}


def stats(prefix: str, value: Column | str, *kinds: str) -> list[Column]:
    """``prefix_KIND`` aggregates of one value, for the kinds asked for."""
    return [_STATS[k](col(value)).alias(f"{prefix}_{k}") for k in kinds]


def to_double(c: Column | str) -> Column:
    return col(c).try_cast("double")


def to_long(c: Column | str) -> Column:
    return col(c).try_cast("bigint")


def clean_infinite(c: Column | str) -> Column:
    """NULL for +-infinity, anything else unchanged."""
    value = col(c)
    return F.when(F.abs(value) == F.lit(float("inf")), None).otherwise(value)
