"""URL rules by a sort-merge range join on canonical keys.

A rule is a host and a path prefix, ``example.com/en/``; it fits its host and all
subdomains where the url's path starts with the rule's, and of all that fit the longest
rule string wins. The canonical key of a rule is its host with labels reversed, a divider
and the path, and a url has one key for its host and for each parent domain. So "fits" is
"is a prefix", and a rule is the interval of keys that begin with it; intervals nest or
are disjoint.

A url's key needs no more characters than the longest rule's, and parents only of as many
labels as some rule's host has; a long url costs no more than it holds.

Keys of urls (distinct hosts and paths) and rules are range-partitioned and sorted together.
A sweep over a partition keeps a stack of active rules: entries that the next key has left
are popped, rules are pushed, and a url's key takes the top, the longest. Rules that began in
an earlier partition are prefixes of the partition's first key, of the lengths that rules
have, and join it by equality.
The sort is by (key, host), so a key that a third of all urls share is split as well.

Defined cases: null urls, or without ``://``: empty host and path, no rule; of equal rules
with both verdicts block wins; null and empty rules and rules without a host are ignored;
repeated rows give repeated results; other columns are ignored; empty tables give no rows
or the default verdict.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower
from riskloom.session import materialise

DIVIDER = "\x01"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _keys(rules: DataFrame) -> DataFrame:
    """(key, rule, verdict) of rules (rule, verdict), one per key."""
    host = ascii_lower(F.regexp_extract("rule", r"(?s)^([^/]*)", 1))
    rows = rules.where("rule is not null and verdict is not null").select("rule", "verdict", host.alias("host")).where("host <> ''")
    key = F.concat(F.array_join(_reversed(F.col("host")), "."), F.lit("." + DIVIDER), F.substring("rule", F.length("host") + 1, F.length("rule")))
    n = F.size(F.split("host", r"\.", -1))
    return rows.groupBy(key.alias("key")).agg(F.max("verdict").alias("verdict"), F.max("rule").alias("rule"), F.max(n).alias("labels"))


def _sweep(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["key", "kind"], kind="stable")
    stack: list[tuple[str, str, str]] = []
    out = []
    for key, kind, host, path, rule, verdict in rows[["key", "kind", "host", "path", "rule", "verdict"]].itertuples(index=False):
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if kind == 0:
            stack.append((key, rule, verdict))
        elif stack:
            out.append((host, path, stack[-1][1], stack[-1][2]))
    return pd.DataFrame(out, columns=["host", "path", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, columns: list[str], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``columns`` of every page with host, path, rule (null without one) and verdict.
    ``rules``: rule ("host/path") and verdict ("allow" or "block")."""
    url = F.col(url_col)
    rows = pages.select(*columns, host_of(url).alias("_host"), path_of(url).alias("_path"))
    keys = materialise(_keys(rules), "rules")
    shape = keys.agg(F.collect_set("labels").alias("labels"), F.collect_set(F.length("key")).alias("lengths")).select(F.struct("*")).scalar()
    keys = keys.drop("labels")
    most = F.coalesce(F.array_max(F.col("shape.lengths")), F.lit(0))
    urls = rows.where("_host <> ''").select(F.col("_host").alias("host"), F.col("_path").alias("path")).distinct()
    labels = urls.select("*", _reversed(F.col("host")).alias("labels"), shape.alias("shape"))
    fits = F.filter("shape.labels", lambda n: n <= F.size("labels"))
    parents = F.transform(fits, lambda n: F.substring(F.concat(F.array_join(F.slice("labels", 1, n), "."), F.lit("." + DIVIDER), F.substring("path", F.lit(1), most)), F.lit(1), most))
    points = labels.select(F.explode(parents).alias("key"), F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    marks = keys.select("key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), "rule", "verdict")
    ranged = points.union(marks).repartitionByRange("key", "kind", "host", "path").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    firsts = ranged.groupBy("part").agg(F.min("key").alias("first"))
    cuts = F.filter("shape.lengths", lambda n: n <= F.length("first"))
    prefixes = firsts.select("*", shape.alias("shape")).select("part", F.explode(F.transform(cuts, lambda n: F.substring(F.col("first"), F.lit(1), n))).alias("key"))
    open_rules = prefixes.join(keys, "key").select("key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), "rule", "verdict", "part")
    met = ranged.unionByName(open_rules).groupBy("part").applyInPandas(_sweep, "host string, path string, rule string, verdict string")
    best = met.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    best = best.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("best.rule").alias("_rule"), F.col("best.verdict").alias("_verdict"))
    out = rows.join(best, ["_host", "_path"], "left")
    return out.select(*columns, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.coalesce("_verdict", F.lit(default)).alias("verdict"))
