"""All registered queries and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans import learning, marts, oracle_learning, oracle_marts, oracle_reports, oracle_streams, reports, streams
from riskloom.plans.tidy import tidy

_MODULES = [marts, reports, streams, learning]
_ORACLES = [oracle_marts.MARTS, oracle_reports.REPORTS, oracle_streams.STREAMS, oracle_learning.LEARNING]

Query = Callable[[SparkSession, str], DataFrame]


def _tidied(query: Query) -> Query:
    return lambda spark, sf_dir: tidy(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _tidied(q) for module in _MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for texts in _ORACLES for name, text in texts.items()}
