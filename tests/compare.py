"""Run registered queries on Spark and DuckDB and compare whole results.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    return repr(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, text, sf_dir) -> tuple[str, int, float]:
    began = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - began
    if text is None:
        return ("rows", len(got), took)
    cursor = con.execute(text)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        missing, extra = set(names) - set(df.columns), set(df.columns) - set(names)
        return (f"COLUMNS spark lacks {missing} has extra {extra}", len(got), took)
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
    odd = {c: (t, types[c]) for c, t in df.dtypes if t in kinds and types[c] not in (kinds[t], kinds[t].replace("VARCHAR", "STRING"), "NUMBER")}
    if odd:
        return (f"TYPES {odd}", len(got), took)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return ("ok", len(got), took)
    cols = sorted(names)
    diff = [
        (c, x, y) for r1, r2 in zip(a, b) for c, x, y in zip(cols, r1, r2) if x != y
    ]
    return (f"DIFF rows {len(a)} vs {len(b)}; first {diff[:4]} of {len(diff)}", len(got), took)


def main() -> int:
    from riskloom.plans import catalog
    from riskloom.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    queries, texts = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for name in args or queries:
        try:
            verdict, n, took = compare(spark, con, name, queries[name], texts.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            verdict, n, took = f"ERROR {type(e).__name__} {str(e)[:700]}", -1, 0.0
        bad += verdict not in ("ok", "rows")
        print(f"{name:28s} {n:7d} {took:6.2f}s {verdict}", flush=True)
    orphan = set(texts) - set(queries)
    print(f"{len(queries)} queries, {len(texts)} texts, {bad} bad, texts without query {orphan}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
