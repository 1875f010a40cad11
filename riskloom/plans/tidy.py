"""Stable output types for registered queries: whole numbers as BIGINT, fractions
as DOUBLE rounded to six digits, so results compare across engines.

Sums of fractions differ in the last bits with the order of addition. A nudge far
below the sixth digit keeps a value that lies exactly between two roundings (73/128,
say) from flipping because of that."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tidy(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double") + F.lit(1e-10), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
