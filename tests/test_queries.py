"""Registered queries against DuckDB at the smallest scale.

RISKLOOM_ALL=1 runs every query; by default one of each kind.
"""

import os

import pytest
from compare import compare, connect

from riskloom.plans import catalog

QUICK = [
    "mart_application",
    "mart_bureau_features",
    "mart_credit_card_balance",
    "mart_pos_cash_balance",
    "mart_previous_application",
    "cdc_flatten",
    "feature_ready",
    "online_features",
    "segment_default_rate",
    "metric_roc_curve",
    "threshold_sweep",
    "clip_quantiles",
    "infer_schema",
]
NAMES = list(catalog.queries()) if os.environ.get("RISKLOOM_ALL") else QUICK


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    verdict, rows, _ = compare(spark, con, name, catalog.queries()[name], catalog.oracle_sql().get(name), sf_dir)
    assert verdict in ("ok", "rows"), verdict
    assert rows > 0


def test_every_text_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
