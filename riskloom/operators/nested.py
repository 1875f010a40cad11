"""The 53 bureau features computed inside one nested message.

The message is parsed once; array expressions then do the rest without a shuffle or
a Python function, so the same projection serves batch and stream. Balance rows are
attributed to bureau records by sorting both together and walking the runs, which
stays n log n for a long history. Message size bounds the work per row; customers
split over several messages go through the relational form instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import ratio
from riskloom.operators.bureau import DPD_BANDS, KEY, ON_TIME, SEVERE, bureau_features
from riskloom.operators.enrich import BALANCE_FIELDS, BUREAU_FIELDS, SCORE_FIELDS

MESSAGE = (
    "sk_id_curr string, part int, parts int, "
    + "bureau array<struct<"
    + ", ".join(f"{f}: string" for f in BUREAU_FIELDS)
    + ">>, bureau_balance array<struct<"
    + ", ".join(f"{f}: string" for f in BALANCE_FIELDS)
    + ">>, external_scores struct<"
    + ", ".join(f"{f}: string" for f in SCORE_FIELDS)
    + ">, ts double, _corrupt_record string"
)



def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = messages.select(F.from_json(F.col(value).cast("string"), MESSAGE, options).alias("m")).select("m.*")
    amounts = ["amt_credit_sum_overdue", "amt_credit_sum_debt", "amt_credit_sum_limit", "amt_credit_sum"]

    def typed(r: Column) -> Column:
        return F.struct(
            r["sk_id_bureau"].alias("id"),
            r["credit_type"].alias("type"),
            r["credit_active"].alias("status"),
            r["credit_day_overdue"].try_cast("bigint").alias("days"),
            r["cnt_credit_prolong"].try_cast("bigint").alias("prolong"),
            r["amt_credit_max_overdue"].try_cast("double").alias("ever"),
            *[
                F.coalesce(r[a].try_cast("double"), F.lit(0.0)).alias(n)
                for a, n in zip(amounts, ("overdue", "debt", "limit", "credit"))
            ],
        )

    bureau = F.coalesce(F.col("bureau"), F.array().cast("array<struct<" + ",".join(f"{f}:string" for f in BUREAU_FIELDS) + ">>"))
    balance = F.coalesce(
        F.col("bureau_balance"), F.array().cast("array<struct<" + ",".join(f"{f}:string" for f in BALANCE_FIELDS) + ">>")
    )
    return parsed.withColumns({"records": F.transform(bureau, typed), "months": balance})


def _total(array: str, value: Callable[[Column], Column], kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    return F.aggregate(F.col(array), zero, lambda s, r: s + F.coalesce(value(r).cast(kind), zero))


def _count(array: str, condition: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(F.col(array), lambda r: F.coalesce(condition(r), F.lit(False)))).cast("bigint")


def _highest(array: str, value: Callable[[Column], Column]) -> Column:
    return F.array_max(F.transform(F.col(array), value))


def _per_record() -> Column:
    """[{months, on_time, past_due, severe}] for each bureau record with history.

    Markers (kind 0) for the message's own bureau ids and balance rows (kind 1) are
    sorted by id; a run of balance rows counts only if its marker came first.
    """
    status = lambda r: F.upper(F.coalesce(r["status"], F.lit("")))
    markers = F.transform(
        F.array_distinct(F.transform(F.filter("records", lambda r: r["id"].isNotNull()), lambda r: r["id"])),
        lambda i: F.struct(i.alias("id"), F.lit(0).alias("kind"), F.lit("").alias("status")),
    )
    rows = F.transform(
        F.filter("months", lambda r: r["sk_id_bureau"].isNotNull()),
        lambda r: F.struct(r["sk_id_bureau"].alias("id"), F.lit(1).alias("kind"), status(r).alias("status")),
    )
    run_type = "struct<id:string,months:bigint,on_time:bigint,past_due:bigint,severe:bigint>"
    start = F.struct(
        F.lit(None).cast(run_type).alias("run"), F.array().cast(f"array<{run_type}>").alias("done")
    )

    def opened(r: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.struct(
            r["id"].alias("id"), zero.alias("months"), zero.alias("on_time"), zero.alias("past_due"), zero.alias("severe")
        )

    def grown(run: Column, r: Column) -> Column:
        def add(name: str, condition: Column) -> Column:
            return (run[name] + condition.cast("bigint")).alias(name)

        return F.struct(
            run["id"].alias("id"),
            (run["months"] + 1).alias("months"),
            add("on_time", r["status"] == ON_TIME),
            add("past_due", r["status"].isin(*DPD_BANDS)),
            add("severe", r["status"] == SEVERE),
        )

    def closed(state: Column) -> Column:
        return F.when(state["run"]["months"] > 0, F.concat(state["done"], F.array(state["run"]))).otherwise(state["done"])

    def step(state: Column, r: Column) -> Column:
        is_marker = r["kind"] == 0
        same = state["run"]["id"] == r["id"]
        return F.struct(
            F.when(is_marker, opened(r)).when(same, grown(state["run"], r)).otherwise(state["run"]).alias("run"),
            F.when(is_marker, closed(state)).otherwise(state["done"]).alias("done"),
        )

    return F.aggregate(F.array_sort(F.concat(markers, rows)), start, step, closed)


def nested_features(parsed: DataFrame) -> DataFrame:
    """Features of single-part messages; an unreadable message becomes an error row."""
    ready = parsed.withColumn("history", _per_record())
    n = F.size("records").cast("bigint")
    active = lambda r: r["status"] == "Active"
    debt, limit = (lambda r: r["debt"]), (lambda r: r["limit"])

    def active_sum(name: str) -> Column:
        return F.aggregate(
            F.filter("records", active), F.lit(0.0), lambda s, r: s + r[name]
        )

    def status_is(value: str) -> Column:
        return _count("records", lambda r: r["status"] == value)

    days, prolong = (lambda r: r["days"]), (lambda r: r["prolong"])
    overdue_sum = _total("records", lambda r: r["overdue"], "double")
    debt_sum, credit_sum = _total("records", debt, "double"), _total("records", lambda r: r["credit"], "double")
    maxed = _count("records", lambda r: (limit(r) > 0) & (debt(r) >= limit(r)))
    high = _count("records", lambda r: (limit(r) > 0) & (debt(r) > limit(r) * 0.8))
    counted = {
        "BUREAU_TOTAL_COUNT": n,
        "BUREAU_CREDIT_TYPES_COUNT": F.size(F.array_distinct(F.transform("records", lambda r: r["type"]))),
        "BUREAU_ACTIVE_COUNT": status_is("Active"),
        "BUREAU_CLOSED_COUNT": status_is("Closed"),
        "BUREAU_BAD_DEBT_COUNT": status_is("Bad debt"),
        "BUREAU_SOLD_COUNT": status_is("Sold"),
        "BUREAU_BAD_DEBT_RATIO": ratio(status_is("Bad debt"), n),
        "BUREAU_SOLD_RATIO": ratio(status_is("Sold"), n),
        "BUREAU_HIGH_RISK_RATIO": ratio(status_is("Bad debt") + status_is("Sold"), n),
        "BUREAU_OVERDUE_DAYS_TOTAL": _total("records", days, "bigint"),
        "BUREAU_OVERDUE_DAYS_MEAN": ratio(_total("records", days, "bigint"), n),
        "BUREAU_OVERDUE_DAYS_MAX": _highest("records", days),
        "BUREAU_OVERDUE_COUNT": _count("records", lambda r: days(r) > 0),
        "BUREAU_OVERDUE_RATIO": ratio(_count("records", lambda r: days(r) > 0), n),
        "BUREAU_AMT_OVERDUE_TOTAL": overdue_sum,
        "BUREAU_AMT_OVERDUE_MEAN": ratio(overdue_sum, n),
        "BUREAU_AMT_OVERDUE_MAX": _highest("records", lambda r: r["overdue"]),
        "BUREAU_AMT_MAX_OVERDUE_EVER": _highest("records", lambda r: r["ever"]),
        "BUREAU_AMT_OVERDUE_COUNT": _count("records", lambda r: r["overdue"] > 0),
        "BUREAU_AMT_OVERDUE_RATIO": ratio(_count("records", lambda r: r["overdue"] > 0), n),
        "BUREAU_PROLONG_TOTAL": _total("records", prolong, "bigint"),
        "BUREAU_PROLONG_MEAN": ratio(_total("records", prolong, "bigint"), n),
        "BUREAU_PROLONG_MAX": _highest("records", prolong),
        "BUREAU_PROLONG_COUNT": _count("records", lambda r: prolong(r) > 0),
        "BUREAU_PROLONG_RATIO": ratio(_count("records", lambda r: prolong(r) > 0), n),
        "BUREAU_CREDIT_UTILIZATION_RATIO": ratio(debt_sum, _total("records", limit, "double")),
        "BUREAU_DEBT_TO_CREDIT_RATIO": ratio(debt_sum, credit_sum),
        "BUREAU_OVERDUE_TO_CREDIT_RATIO": ratio(overdue_sum, credit_sum),
        "BUREAU_ACTIVE_CREDIT_SUM": active_sum("credit"),
        "BUREAU_ACTIVE_DEBT_SUM": active_sum("debt"),
        "BUREAU_ACTIVE_OVERDUE_SUM": active_sum("overdue"),
        "BUREAU_ACTIVE_UTILIZATION_RATIO": ratio(active_sum("debt"), active_sum("limit")),
        "BUREAU_MAXED_OUT_COUNT": maxed,
        "BUREAU_MAXED_OUT_RATIO": ratio(maxed, n),
        "BUREAU_HIGH_UTIL_COUNT": high,
        "BUREAU_HIGH_UTIL_RATIO": ratio(high, n),
    }
    months, on_time = _total("history", lambda h: h["months"], "bigint"), _total("history", lambda h: h["on_time"], "bigint")
    past_due, severe = _total("history", lambda h: h["past_due"], "bigint"), _total("history", lambda h: h["severe"], "bigint")
    with_history = F.size("history").cast("bigint")

    def rates(name: str) -> Column:
        return F.transform("history", lambda h: ratio(h[name], h["months"]))

    def mean(name: str) -> Column:
        return ratio(F.aggregate(rates(name), F.lit(0.0), lambda s, x: s + x), with_history)

    has_severe, has_any = _count("history", lambda h: h["severe"] > 0), _count("history", lambda h: h["past_due"] > 0)
    rolled = {
        "BUREAU_WITH_BALANCE_COUNT": with_history,
        "TOTAL_MONTHS_ALL_BUREAUS": months,
        "TOTAL_MONTHS_ON_TIME": on_time,
        "TOTAL_DPD_ALL_BUREAUS": past_due,
        "TOTAL_SEVERE_DPD_MONTHS": severe,
        "WORST_DPD_RATIO": F.array_max(rates("past_due")),
        "WORST_SEVERE_DPD_RATIO": F.array_max(rates("severe")),
        "WORST_ON_TIME_RATIO": F.array_min(rates("on_time")),
        "AVG_DPD_RATIO": mean("past_due"),
        "AVG_ON_TIME_RATIO": mean("on_time"),
        "COUNT_BUREAUS_WITH_SEVERE_DPD": has_severe,
        "COUNT_BUREAUS_WITH_ANY_DPD": has_any,
        "OVERALL_ON_TIME_RATIO": ratio(on_time, months),
        "OVERALL_DPD_RATIO": ratio(past_due, months),
        "OVERALL_SEVERE_DPD_RATIO": ratio(severe, months),
        "CLIENT_HAS_SEVERE_DPD_HISTORY": (has_severe > 0).cast("int"),
        "CLIENT_HAS_ANY_DPD_HISTORY": (has_any > 0).cast("int"),
    }
    broken = F.col("_corrupt_record").isNotNull()
    features = counted | rolled
    return ready.select(
        F.when(broken, F.coalesce("sk_id_curr", F.lit("unknown"))).otherwise(F.col("sk_id_curr")).alias("sk_id_curr"),
        *[F.col(f"external_scores.{s}").try_cast("double").alias(s) for s in SCORE_FIELDS],
        *[F.when(~broken, c).alias(name) for name, c in features.items()],
        "ts",
        F.when(broken, F.lit("unreadable message")).alias("error"),
    )


def split_features(parsed: DataFrame) -> DataFrame:
    """The same output for customers whose history came in several messages: records
    are unnested and aggregated by customer, which also splits a hot one."""
    records = parsed.select(F.col("sk_id_curr").alias(KEY), F.explode("bureau").alias("r")).select(
        KEY, *[F.col(f"r.{f}").alias(f.upper()) for f in BUREAU_FIELDS]
    )
    months = parsed.select(F.explode("bureau_balance").alias("h")).select(
        *[F.col(f"h.{f}").alias(f.upper()) for f in BALANCE_FIELDS]
    )
    features = bureau_features(records, months, "stream").withColumnRenamed(KEY, "sk_id_curr")
    once = parsed.groupBy("sk_id_curr").agg(
        F.first("external_scores", ignorenulls=True).alias("external_scores"), F.max("ts").alias("ts")
    )
    return features.join(once, "sk_id_curr").select(
        "sk_id_curr",
        *[F.col(f"external_scores.{s}").try_cast("double").alias(s) for s in SCORE_FIELDS],
        *[c for c in features.columns if c != "sk_id_curr"],
        "ts",
        F.lit(None).cast("string").alias("error"),
    )


PART = ["sk_id_curr", "part", "parts", "bureau", "bureau_balance", "external_scores", "ts"]


def sorted_out(parsed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Whole messages, parts of split customers with their ``part_key``, and the texts of
    messages that cannot be read or name no customer."""
    bad = F.col("_corrupt_record").isNotNull() | F.col("sk_id_curr").isNull()
    several = F.coalesce(F.col("parts"), F.lit(1)) > 1
    text = F.coalesce("_corrupt_record", F.to_json(F.struct(*PART))).alias("value")
    key = F.concat_ws("|", "sk_id_curr", "part", "ts").alias("part_key")
    return parsed.where(~bad & ~several), parsed.where(~bad & several).select(key, *PART), parsed.where(bad).select(text)


def bureau_from_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """External features of every customer in ``messages``, single- or multi-part.
    (A stream that never splits customers can use ``nested_features`` alone.)"""
    parsed = parse_messages(messages, value)
    several = F.coalesce(F.col("parts"), F.lit(1)) > 1
    return nested_features(parsed.where(~several)).unionByName(split_features(parsed.where(several)))
