"""Training-set assembly, cleaning and encoding.

Fitted values (quantiles, medians, modes) are scalar subqueries with one value per
column, so transforms stay lazy and nothing is joined. Category dictionaries, whose
size depends on the data, are written to the shared folder: Spark then knows their
true size and broadcasts them only if they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.numeric import clean_infinite, col, ratio
from riskloom.operators.quantiles import as_row, attach, exact_quantiles
from riskloom.session import materialise

KEY = "SK_ID_CURR"
TARGET = "TARGET"

# The model's features; the last five are categorical.
NUMERIC_FEATURES = [
    "EXT_SOURCE_3",
    "EXT_SOURCE_2",
    "EXT_SOURCE_1",
    "DAYS_BIRTH",
    "AMT_GOODS_PRICE",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "DAYS_EMPLOYED",
    "BUREAU_DEBT_TO_CREDIT_RATIO",
    "BUREAU_ACTIVE_CREDIT_SUM",
    "POS_MEAN_CONTRACT_LENGTH",
    "PREV_ANNUITY_MEAN",
    "PREV_GOODS_TO_CREDIT_RATIO",
    "POS_LATEST_MONTH",
    "BUREAU_AMT_MAX_OVERDUE_EVER",
    "POS_TOTAL_MONTHS_OBSERVED",
    "AMT_INCOME_TOTAL",
    "PREV_REFUSAL_RATE",
    "CNT_CHILDREN",
]
CATEGORICAL_FEATURES = [
    "CODE_GENDER",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
    "ORGANIZATION_TYPE",
    "NAME_INCOME_TYPE",
]


def complete_dataset(application: DataFrame, *marts: DataFrame) -> DataFrame:
    """Applications left-joined with each mart. Every mart is already hash-partitioned
    by the key from its last aggregate, so only the applications move."""
    for mart in marts:
        application = application.join(mart, KEY, "left")
    return application


def training_set(features: DataFrame, labels: DataFrame, cards: DataFrame | None = None, sample: int | None = None) -> DataFrame:
    """Features with labels, plus optional per-key card aggregates."""
    joined = features.join(labels, KEY)
    if cards is not None:
        joined = joined.join(cards, KEY, "left")
    return joined if sample is None else joined.limit(sample)


def model_features(df: DataFrame) -> DataFrame:
    return df.select(KEY, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET)


def model_input(df: DataFrame, signature: list[str] | None = None, fill: float | None = None, keep: list[str] = ()) -> DataFrame:
    """Columns in signature order, absent ones NULL (or ``fill``), others dropped;
    sorted by name when there is no signature."""
    order = signature if signature else sorted(c for c in df.columns if c not in keep)
    missing = F.lit(None).cast("double") if fill is None else F.lit(fill)
    return df.select(*keep, *[(col(c) if c in df.columns else missing).alias(c) for c in order])


def map_features(df: DataFrame, refs: list[str], mapping: dict[str, str] | None = None, keep: list[str] = ()) -> DataFrame:
    """Online feature references ``view:name`` to upper-case model columns: text stays
    text, numbers become doubles."""
    mapping = mapping or {}

    def one(ref: str) -> Column:
        name = ref.split(":", 1)[-1]
        source = next(c for c in (ref, ref.replace(":", "__"), name) if c in df.columns)
        value = F.col(f"`{source}`")
        text = isinstance(df.schema[source].dataType, T.StringType)
        return (value if text else value.cast("double")).alias(mapping.get(name, name).upper())

    return df.select(*keep, *[one(r) for r in refs])


def clean_infinities(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    fractional = {
        f.name: clean_infinite(f.name)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exclude
    }
    return df.withColumns(fractional)


def clip_bounds(df: DataFrame, columns: list[str], low: float = 0.001, high: float = 0.999, method: str = "nearest") -> DataFrame:
    """Lower and upper clip value per column, fitted on ``df``."""
    return exact_quantiles(df, columns, [low, high], method).select(
        "column", F.col("q0").alias("lower"), F.col("q1").alias("upper")
    )


def clip(df: DataFrame, bounds: DataFrame, columns: list[str]) -> DataFrame:
    """Limit values to the fitted bounds; NULL stays NULL."""
    df, fitted = attach(df, as_row(bounds, columns, ["lower", "upper"])), F.col("_fitted")

    def limited(c: str) -> Column:
        value = col(c).cast("double")
        return F.when(value.isNull(), None).otherwise(
            F.greatest(fitted[c]["lower"], F.least(fitted[c]["upper"], value))
        )

    return df.withColumns({c: limited(c) for c in columns}).drop("_fitted")


def modes(df: DataFrame, columns: list[str]) -> Column:
    """Scalar subquery with the most frequent value per column (first by value on
    ties), counted with a map-side combine."""
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]))
    counted = (
        df.select(entry.alias("e")).select("e.*").where("value IS NOT NULL").groupBy("column", "value").count()
    )
    best = counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("count"), "value")).alias("mode"))
    return as_row(best, columns, ["mode"])


def impute(df: DataFrame, fitted_on: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Median for numeric columns, 0 for previous-application columns that are not
    rates or ratios, most frequent value for categorical ones."""
    zero = [c for c in numeric if c.startswith("PREV_") and "RATIO" not in c and "RATE" not in c]
    by_median = [c for c in numeric if c not in zero]
    filled = {c: F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in zero}
    if by_median:
        df = attach(df, as_row(exact_quantiles(fitted_on, by_median, [0.5]), by_median, ["q0"]), "_medians")
        filled |= {c: F.coalesce(col(c).cast("double"), F.col("_medians")[c]["q0"]) for c in by_median}
    if categorical:
        df = attach(df, modes(fitted_on, categorical), "_modes")
        filled |= {c: F.coalesce(col(c), F.col("_modes")[c]["mode"]) for c in categorical}
    return df.withColumns(filled).drop("_medians", "_modes")


def smart_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill columns joined from a mart by what their name says: 0 for counts, flags
    and totals, the median (0 if there is none) for rates, ratios and means,
    ``NEW_CUSTOMER`` for risk segments, 0 for the rest."""
    counts = [c for c in columns if any(w in c for w in ("COUNT", "FLAG", "TOTAL"))]
    rates = [c for c in columns if c not in counts and any(w in c for w in ("RATE", "RATIO", "MEAN"))]
    if rates:
        df = attach(df, as_row(exact_quantiles(df, rates, [0.5]), rates, ["q0"]), "_medians")
    filled = {}
    for c in columns:
        if c in rates:
            filled[c] = F.coalesce(col(c).cast("double"), F.col("_medians")[c]["q0"], F.lit(0.0))
        elif "RISK_SEGMENT" in c:
            filled[c] = F.coalesce(col(c), F.lit("NEW_CUSTOMER"))
        else:
            filled[c] = F.coalesce(col(c), F.lit(0).cast(df.schema[c].dataType))
    return df.withColumns(filled).drop("_medians")


def join_and_fill(base: DataFrame, features: DataFrame) -> DataFrame:
    columns = [c for c in features.columns if c != KEY]
    return smart_fill(base.join(features, KEY, "left"), columns)


HOT = 1_000  # a value with more than this part of its column's rows is hot


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column``, ``value``, ``code`` (0-based by sorted value) and ``hot``, whether the value
    has more than one row in ``HOT`` of its column.

    Values lie in sampled ranges of (column, value), each sorted in its task; a code is the
    place in the range on top of the column's values in the ranges before, of which there is
    one row per range and column. However values are spread, no task holds a column.
    """
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]))
    counted = df.select(entry.alias("e")).select("e.*").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    ranged = counted.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    # the id holds the range in its upper bits and the place in it below
    placed = materialise(ranged.withColumn("place", F.monotonically_increasing_id()).withColumn("range", F.shiftright("place", 33)), "ranges")
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("column")
    starts = placed.groupBy("column", "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("rows").alias("all")).select(
        "column", "range", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("all").over(every).alias("all")
    )
    joined = placed.join(F.broadcast(starts), ["column", "range"])  # one row per range and column
    return joined.select("column", "value", (F.col("offset") + F.col("place") - F.col("first")).alias("code"), (F.col("rows") * HOT > F.col("all")).alias("hot"))


def encode(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each value by its code, -1 when it has none.

    Hot values, fewer than ``HOT`` per column, are looked up in a broadcast table; their rows
    and those without a value join the rest of the dictionary under made-up keys that meet
    nothing and lie apart, so no task gets the rows of one value.
    """
    order = df.columns
    for c in columns:
        mine = codes.where(F.col("column") == c)
        often = mine.where("hot").select(F.col("value").alias("_hot"), F.col("code").alias("_often"))
        rest = mine.where("NOT hot").select(F.struct("value", F.lit(0).alias("salt")).alias("_key"), F.col("code").alias("_code"))
        text = col(c).cast("string")
        df = df.withColumn("_value", text).join(F.broadcast(often), F.col("_value") == F.col("_hot"), "left")
        alone = F.col("_often").isNotNull() | F.col("_value").isNull()
        salt = F.when(alone, 1 + F.pmod(F.xxhash64(*[F.col(f"`{x}`") for x in order]), F.lit(65_536))).otherwise(0).cast("int")
        key = F.struct(F.when(alone, "").otherwise(F.col("_value")).alias("value"), salt.alias("salt"))
        df = df.withColumn("_key", key).join(rest, "_key", "left")
        df = df.withColumn(c, F.coalesce("_often", "_code", F.lit(-1))).select(*order)
    return df


def ordinal_encode(df: DataFrame, fitted_on: DataFrame, columns: list[str]) -> DataFrame:
    return encode(df, materialise(category_codes(fitted_on, columns), "codes"), columns)


def label_encode(df: DataFrame, columns: list[str], absent: str = "Unknown") -> DataFrame:
    """Codes by sorted value with absent values as a category of their own."""
    filled = df.withColumns({c: F.coalesce(col(c).cast("string"), F.lit(absent)) for c in columns})
    return encode(filled, materialise(category_codes(filled, columns), "codes"), columns)


def class_order(df: DataFrame, key: str, label: str = TARGET, seed: int = 42) -> DataFrame:
    """Add ``place``, the 0-based place of a row in its class by a hash of the key, and
    ``class_rows``. Places are counted inside 65,536 ranges of the hash on top of the rows
    of the ranges before, so no task sees a class. A NULL label is a class; keys are unique."""
    digest = F.substring(F.md5(F.concat(F.coalesce(col(key).cast("string"), F.lit("")), F.lit(f"|{seed}"))), 1, 8)
    hashed = df.withColumn("_hash", F.conv(digest, 16, 10).cast("bigint")).withColumn("_range", F.shiftright("_hash", 16))
    of_class = Window.partitionBy(label)
    before = of_class.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = hashed.groupBy(label, "_range").agg(F.count(F.lit(1)).alias("n")).select(
        F.col(label).alias("_class"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
        F.sum("n").over(of_class).alias("class_rows"),
    )
    within = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_hash", key)) - 1
    same = F.col(label).eqNullSafe(F.col("_class")) & (F.col("_range") == F.col("_of"))
    placed = hashed.withColumn("_within", within).join(ranges, same)
    return placed.select(*df.columns, (F.col("_before") + F.col("_within")).alias("place"), "class_rows")


def assign_split(df: DataFrame, key: str, label: str = TARGET, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: the rows of each class with the smallest hashes of the key are the test
    part, its share of the class to the nearest row."""
    test = F.col("place") < F.floor(F.col("class_rows") * F.lit(test_share) + 0.5)
    return class_order(df, key, label, seed).withColumn("split", F.when(test, "test").otherwise("train")).drop("place", "class_rows")


def split_balance(df: DataFrame, key: str, label: str = TARGET) -> DataFrame:
    """Rows of each class in each part, and the sum of their keys, which tells which they are."""
    return df.groupBy("split", label).agg(F.count(F.lit(1)).alias("rows"), F.sum(col(key).cast("long")).alias("key_sum"))


def class_balance(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows and share per class with the majority-to-minority ratio."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.agg(F.sum("rows").alias("n"), F.max("rows").alias("most"), F.min("rows").alias("least")).select(
        F.struct("*")
    ).scalar()
    return counted.select(
        label, "rows", ratio("rows", totals["n"]).alias("share"), ratio(totals["most"], totals["least"]).alias("imbalance_ratio")
    )


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("k")).select(F.struct("*")).scalar()
    return counted.select(label, ratio(totals["n"], totals["k"] * F.col("rows")).alias("weight"))


# Columns taken without looking at their missing rate.
INTERPRETABLE = [
    "AMT_CREDIT",
    "AMT_INCOME_TOTAL",
    "AMT_ANNUITY",
    "DAYS_BIRTH",
    "DAYS_EMPLOYED",
    "CODE_GENDER",
    "CNT_CHILDREN",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
    "OCCUPATION_TYPE",
    "ORGANIZATION_TYPE",
    "EMPLOYMENT_START_DATE",
]
EXTERNAL_SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def select_features(missing: DataFrame, skip: list[str] = (KEY, TARGET)) -> DataFrame:
    """Columns worth starting with, from a missing-value summary: interpretable ones,
    flags under 10 % missing, external scores, and columns under 5 % missing that are
    not document flags. ``reason`` is the first rule that applies."""
    name, rate = F.col("column_name"), F.col("missing_proportion")
    reason = (
        F.when(name.isin(INTERPRETABLE) | ((rate < 0.1) & name.startswith("FLAG_")), "core")
        .when(name.isin(EXTERNAL_SCORES), "external")
        .when((rate < 0.05) & ~name.contains("DOCUMENT"), "stable")
    )
    return missing.where(~name.isin(list(skip))).select(name.alias("feature"), rate.alias("missing_rate"), reason.alias("reason")).where("reason IS NOT NULL")


# Features kept in the first tier whatever their importance.
CORE_INDICATORS = [
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_GOODS_PRICE",
    "DAYS_BIRTH",
    "DAYS_EMPLOYED",
    "CNT_CHILDREN",
    "CODE_GENDER",
    "NAME_INCOME_TYPE",
    "NAME_EDUCATION_TYPE",
]
TIERS = [
    ("Tier 1 (Must-have)", 1.0),
    ("Tier 2 (High-value)", 0.1),
    ("Tier 3 (Medium-value)", 0.01),
    ("Tier 4 (Low-value)", 0.001),
]
LAST_TIER = "Tier 5 (Eliminate)"


def importance_tiers(importance: DataFrame) -> DataFrame:
    """Tier of each feature from its importance; core indicators are tier 1."""
    value = F.col("importance")
    tier = F.when(F.col("feature").isin(CORE_INDICATORS), TIERS[0][0])
    for name, least in TIERS:
        tier = tier.when(value >= least, name)
    return importance.withColumn("tier", tier.otherwise(LAST_TIER))


def choose_feature_set(results: DataFrame, min_auc: float = 0.77) -> DataFrame:
    """The smallest feature set that reaches ``min_auc``; no row if none does."""
    best = results.where(F.col("auc") >= min_auc).agg(F.min(F.struct("features", "feature_set", "auc")).alias("b"))
    return best.where("b IS NOT NULL").select("b.feature_set", "b.features", "b.auc")


def importance_by_family(importance: DataFrame, k: int = 20) -> DataFrame:
    """Features per family among the ``k`` most important ones (a top-k report)."""
    name = F.col("feature")
    family = (
        F.when(name.startswith("BUREAU_"), "Bureau")
        .when(name.contains("POS_") | name.contains("PREV_"), "POS")
        .otherwise("Application")
    )
    top = importance.orderBy(F.round("importance", 9).desc(), "feature").limit(k)
    counted = top.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("features"))
    return counted.withColumn("share", ratio("features", F.sum("features").over(Window.partitionBy())))  # one row per family
