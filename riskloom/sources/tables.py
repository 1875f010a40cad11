"""Named tables and views: what a warehouse would hold beside files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import fresh_path


def as_view(df: DataFrame, name: str) -> DataFrame:
    """``df`` under a name that SQL of the session can use; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_table(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` computed once into a table of its own in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.option("path", path or fresh_path(df.sparkSession, label)).saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(df: DataFrame, label: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """``df`` as a table hashed into ``buckets`` by ``key`` and sorted by it, one file per bucket:
    a join on the key reads it as it lies, and only the other side moves."""
    name = f"{label}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path or fresh_path(df.sparkSession, label)).saveAsTable(name)
    return df.sparkSession.table(name)
