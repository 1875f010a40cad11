"""Registered queries: data quality, preparation, evaluation, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import decisions
from riskloom.functions.numeric import col
from riskloom.operators import application, boosting, bureau, cards, evaluation, models, pos, prepare, previous, quality, ranking, stages
from riskloom.operators.reports import KEY
from riskloom.plans.marts import over
from riskloom.session import fresh_path, materialise
from riskloom.sources import schemas
from riskloom.sources.domain import view

MODELS = ["P_A", "P_B", "P_C"]


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = view(spark, sf_dir, "application_train")
    base = table.select(*application.APPLICATION_COLUMNS, "CODE_GENDER", *prepare.EXTERNAL_SCORES, "TARGET")
    return prepare.complete_dataset(
        base,
        pos.pos_features(view(spark, sf_dir, "pos_cash_balance")),
        bureau.bureau_features(view(spark, sf_dir, "bureau"), view(spark, sf_dir, "bureau_balance")),
        cards.card_features(view(spark, sf_dir, "credit_card_balance")),
        previous.previous_features(view(spark, sf_dir, "previous_application")),
    )


def features24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.model_features(complete(spark, sf_dir))


def training_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = view(spark, sf_dir, "application_train")
    averages = cards.numeric_averages(view(spark, sf_dir, "credit_card_balance"), KEY)
    return prepare.training_set(application.mart_application(table), application.mart_application_train(table), averages)


# --- data quality ------------------------------------------------------------


def dq_row_tests(stage: DataFrame, kind: str) -> DataFrame:
    age, ratio = F.col("age_years"), F.col("credit_income_ratio")
    checks = [
        *quality.not_null("application_id", "is_default", "loan_amount", "annuity_amount", "education_type"),
        quality.accepted_values("is_default", [0, 1]),
        quality.accepted_values("missing_all_external_scores", [0, 1]),
        quality.accepted_values("income_type", ["Working", "Pensioner"]),
        quality.expression_is_true("loan_amount", F.col("loan_amount") > 0),
        quality.expression_is_true("age_years", age.between(18, 60), where=age.isNotNull()),
        quality.expression_is_true("credit_income_ratio", ratio <= 10, where=ratio.isNotNull()),
    ]
    return quality.run_checks(stage, [c for c in checks if c.test == kind])


def dq(kind: str):
    return over("application_train")(lambda a: dq_row_tests(application.stage_application(a), kind))


def dq_unique(application_train: DataFrame, previous_application: DataFrame, pos_cash: DataFrame) -> DataFrame:
    tests = [
        quality.unique(application_train, "SK_ID_CURR"),
        quality.unique(previous_application, "SK_ID_PREV"),
        quality.unique(pos_cash, "SK_ID_CURR"),
    ]
    named = [t.withColumn("source", F.lit(n)) for t, n in zip(tests, ("application", "previous", "pos"))]
    return named[0].unionByName(named[1]).unionByName(named[2])


def buildings(application_train: DataFrame) -> DataFrame:
    """Columns in _AVG/_MODE/_MEDI groups, one mostly filled and one mostly empty."""
    groups = {"SCORE": "EXT_SOURCE_1", "CAR": "OWN_CAR_AGE"}
    return application_train.select(
        KEY,
        *[(col(c) * f).alias(f"{g}_{s}") for g, c in groups.items() for s, f in (("AVG", 1.0), ("MODE", 2.0), ("MEDI", 3.0))],
    )


def extreme_scan(application_train: DataFrame) -> DataFrame:
    from riskloom.functions.decisions import debt_to_income

    wide = application_train.select(
        KEY,
        "AMT_CREDIT",
        debt_to_income("AMT_CREDIT", "EXT_SOURCE_1").alias("CREDIT_TO_SCORE"),
        (col("AMT_CREDIT") * 1e6).alias("CREDIT_MICROS"),
    )
    return quality.extreme_scan(wide, [KEY])


def feature_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model features that no warehouse or application column provides."""
    table = view(spark, sf_dir, "application_train")
    text = F.to_json(F.struct(*application.APPLICATION_COLUMNS), {"ignoreNullFields": "false"})
    names = F.explode(F.map_keys(F.from_json(text, "map<string,string>"))).alias("name")
    registry = table.select(names).distinct()
    wanted = F.array(*[F.lit(c) for c in [*prepare.NUMERIC_FEATURES, *prepare.CATEGORICAL_FEATURES]])
    required = table.agg(F.lit(1).alias("one")).select(F.explode(wanted).alias("name"))
    return schemas.missing_features(required, registry)


# --- preparation ---------------------------------------------------------------


def clip_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every numeric feature limited to its quantiles at 0.1 and 99.9 %."""
    rows = materialise(features24(spark, sf_dir).select(KEY, *prepare.NUMERIC_FEATURES), "features")  # read three times below
    return prepare.clip(rows, prepare.clip_bounds(rows, prepare.NUMERIC_FEATURES), prepare.NUMERIC_FEATURES)


def impute_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(features24(spark, sf_dir), "features")  # read three times below
    return prepare.impute(rows, rows, prepare.NUMERIC_FEATURES, prepare.CATEGORICAL_FEATURES)


def smart_fill(application_train: DataFrame, pos_cash: DataFrame) -> DataFrame:
    """Customers without loans have no row in the mart and are filled."""
    mart = pos.pos_features(pos_cash).select(
        KEY, "POS_COUNT_LOANS_TOTAL", "POS_MEAN_DPD_RATE", "POS_LATEST_MONTH", "POS_RISK_SEGMENT"
    )
    return prepare.join_and_fill(application_train.select(KEY, "TARGET"), mart)


def ordinal_encode(application_train: DataFrame) -> DataFrame:
    """Codes fitted on the training part and applied to all rows: what only the test part has
    is unknown."""
    rows = application_train.select(KEY, "TARGET", *prepare.CATEGORICAL_FEATURES)
    parts = prepare.assign_split(rows, KEY)
    coded = prepare.ordinal_encode(rows, parts.where("split = 'train'"), prepare.CATEGORICAL_FEATURES)
    return coded.drop("TARGET")


def label_encode(application_train: DataFrame) -> DataFrame:
    columns = ["NAME_EDUCATION_TYPE", "OCCUPATION_TYPE"]
    return prepare.label_encode(application_train.select(KEY, *columns), columns)


def correlations(application_train: DataFrame) -> DataFrame:
    return quality.target_correlation(application_train, "TARGET", KEY)


def importance(application_train: DataFrame) -> DataFrame:
    """A data-driven importance: percent of absolute correlation with the target."""
    return correlations(application_train).select("feature", (F.col("correlation") * 10).alias("importance"))


def importance_by_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families among the twenty strongest of all numeric columns of the assembled data."""
    return prepare.importance_by_family(importance(materialise(complete(spark, sf_dir), "complete")))


def feature_set_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature sets of growing size, scored by the AUC of their mean score."""
    scores = view(spark, sf_dir, "scores")
    out = None
    for size in range(1, len(MODELS) + 1):
        used = scores.withColumn("mean", evaluation.mean_score(scores, MODELS[:size]))
        row = evaluation.model_auc(used, "TARGET", "mean").select(
            F.lit(f"first {size}").alias("feature_set"), F.lit(size).alias("features"), "auc"
        )
        out = row if out is None else out.unionByName(row)
    return prepare.choose_feature_set(out, 0.77)


# --- evaluation -------------------------------------------------------------------


def totals(scores: DataFrame) -> DataFrame:
    return ranking.score_totals(scores, "P_A", "TARGET")


def ensemble_mean(scores: DataFrame) -> DataFrame:
    return scores.select(KEY, evaluation.mean_score(scores, MODELS).alias("score"))


def ensemble_weighted(scores: DataFrame) -> DataFrame:
    return scores.select(KEY, evaluation.weighted_score(scores, "TARGET", MODELS).alias("score"))


def ensemble_summary(scores: DataFrame) -> DataFrame:
    """AUC of the mean, weighted, voting and rank ensembles."""
    simple = scores.withColumns(
        {
            "mean": evaluation.mean_score(scores, MODELS),
            "weighted": evaluation.weighted_score(scores, "TARGET", MODELS),
        }
    )
    vote = evaluation.majority_vote(scores, KEY, "TARGET", MODELS)
    rows = scores.agg(F.count(F.lit(1)).cast("double")).scalar()
    rank = evaluation.mean_rank(scores, KEY, "TARGET", MODELS).withColumn("rank", F.col("mean_rank") / rows)
    named = [
        evaluation.model_auc(df, "TARGET", c).select(F.lit(n).alias("method"), "auc")
        for n, df, c in (
            ("mean", simple, "mean"),
            ("weighted", simple, "weighted"),
            ("vote", vote, "confidence"),
            ("rank", rank, "rank"),
        )
    ]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


def _stacked(scores: DataFrame) -> DataFrame:
    return models.out_of_fold(scores, lambda rows: models.fit_stacking(rows, MODELS), KEY, folds=5)


def ensemble_stacking(scores: DataFrame) -> DataFrame:
    """Each row scored by the stacking model that was fitted without it."""
    return _stacked(scores).select(KEY, "fold", F.col("p_default").alias("probability"), decisions.decide("p_default").alias("decision"))


def stacking_folds(scores: DataFrame) -> DataFrame:
    """Rows per fold and class among the scored rows, and the sum of their keys."""
    return _stacked(scores).groupBy("fold", "TARGET").agg(F.count("p_default").alias("rows"), F.sum(KEY).alias("key_sum"))


# --- models -------------------------------------------------------------------------


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the cleaned model features, computed once."""
    clean = models.as_doubles(features24(spark, sf_dir), prepare.NUMERIC_FEATURES)
    rows = materialise(prepare.assign_split(prepare.clean_infinities(clean), KEY), "training")
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def _pipeline(**options):
    return models.gbt_pipeline(prepare.NUMERIC_FEATURES, prepare.CATEGORICAL_FEATURES, **options)


def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees fitted on the training part; metrics on the test part."""
    train, test = _split(spark, sf_dir)
    model = _pipeline(weight="class_weight").fit(models.with_class_weight(train))
    scored = model.transform(test).select("TARGET", models.vector_to_array("probability")[1].alias("p"))
    auc = evaluation.model_auc(scored, "TARGET", "p").select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    hits = evaluation.accuracy(scored, "TARGET", "p").select(F.lit("accuracy@0.3").alias("metric"), F.col("accuracy").alias("value"))
    return auc.unionByName(hits)


# The search space. Rounds, depth, step, share of rows and of columns per tree.
SEARCH = {
    "rounds": [200, 300, 400],
    "depth": [3, 4, 5, 6],
    "step": [0.03, 0.05, 0.07, 0.1],
    "rows": [0.7, 0.8, 0.9, 1.0],
    "columns": [0.6, 0.8, 1.0],
}


def tune_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten random candidates of the search space, cross-validated in three folds; mean AUC
    per candidate."""
    train, _ = _split(spark, sf_dir)
    points = boosting.candidates(SEARCH, 10)
    bins = boosting.binned(train, prepare.NUMERIC_FEATURES, prepare.CATEGORICAL_FEATURES)
    schema = "candidate int, max_iter int, max_depth int, step double, subsample double, columns double"
    named = spark.createDataFrame([(k, *p) for k, p in enumerate(points)], schema)
    return named.join(boosting.search(bins, points), "candidate").drop("candidate")


def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer scored with the whole training chain (clip, fill, encode, trees), saved
    and loaded again."""
    train, test = _split(spark, sf_dir)
    path = fresh_path(spark, "model")
    fitted = stages.training_chain(prepare.NUMERIC_FEATURES, prepare.CATEGORICAL_FEATURES).fit(train)
    models.save_model(fitted, path, prepare.NUMERIC_FEATURES, prepare.CATEGORICAL_FEATURES)
    model, metadata = models.load_model(spark, path)
    rows = prepare.model_input(train.unionByName(test), metadata["model_signature"]["inputs"], keep=[KEY])
    return models.score(model, rows, [KEY])


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready events joined with their features and scored; an event without features
    goes under review."""
    from riskloom.operators import latest

    train, test = _split(spark, sf_dir)
    model = _pipeline().fit(train)
    events = latest.feature_ready(view(spark, sf_dir, "source_arrivals"), 86_400)
    requests = events.select("sk_id_curr").distinct().withColumnRenamed("sk_id_curr", "request")
    features = train.unionByName(test)
    known = requests.join(features, F.col("request") == F.col(KEY).cast("string"), "left")
    scored = models.score(model, known.where(F.col(KEY).isNotNull()), ["request"])
    waiting = known.where(F.col(KEY).isNull()).select(
        "request", F.lit(None).cast("double").alias("probability"), F.lit("under-review").alias("decision")
    )
    return scored.unionByName(waiting)


QUERIES = {
    "complete_dataset": complete,
    "training_set_join": training_set_join,
    "model_features": features24,
    "dq_not_null": dq("not_null"),
    "dq_accepted_values": dq("accepted_values"),
    "dq_expression": dq("expression_is_true"),
    "dq_unique": over("application_train", "previous_application", "pos_cash_balance")(dq_unique),
    "missing_summary": over("application_train")(quality.missing_summary),
    "extreme_scan": over("application_train")(extreme_scan),
    "risk_distribution": over("credit_card_balance")(
        lambda c: quality.distribution(
            cards.card_features(c), ["CC_DPD_RATIO", "CC_SEVERE_DPD_RATIO", "CC_NO_PAYMENT_RATIO", "CC_HIGH_UTIL_RATIO"]
        )
    ),
    "feature_coverage": lambda spark, sf_dir: quality.coverage(features24(spark, sf_dir), prepare.NUMERIC_FEATURES),
    "feature_availability": feature_availability,
    "target_correlation": over("application_train")(correlations),
    "categorical_deviation": over("application_train")(lambda a: quality.categorical_deviation(a, "TARGET")),
    "grouped_missing": over("application_train")(lambda a: quality.grouped_missing(buildings(a))),
    "drift_psi": over("application_train", "application_test")(lambda a, b: quality.psi(a, b, "EXT_SOURCE_2")),
    "drift_ks": over("application_train", "application_test")(lambda a, b: quality.ks_drift(a, b, "EXT_SOURCE_2")),
    "clip_quantiles": clip_quantiles,
    "impute_features": impute_features,
    "smart_fill": over("application_train", "pos_cash_balance")(smart_fill),
    "ordinal_encode": over("application_train")(ordinal_encode),
    "label_encode": over("application_train")(label_encode),
    "stratified_split": over("application_train")(
        lambda a: prepare.split_balance(prepare.assign_split(a.select(KEY, "TARGET"), KEY), KEY)
    ),
    "class_weights": over("application_train")(prepare.class_weights),
    "class_balance": over("application_train")(prepare.class_balance),
    "select_features": over("application_train")(lambda a: prepare.select_features(quality.missing_summary(a))),
    "importance_tiers": over("application_train")(lambda a: prepare.importance_tiers(importance(a))),
    "importance_by_family": importance_by_family,
    "feature_set_choice": feature_set_choice,
    "metric_auc": over("scores")(lambda s: ranking.auc(totals(s))),
    "metric_roc_curve": over("scores")(lambda s: ranking.roc_curve(totals(s))),
    "metric_pr_curve": over("scores")(lambda s: ranking.pr_curve(totals(s))),
    "metric_average_precision": over("scores")(lambda s: ranking.average_precision(totals(s))),
    "optimal_threshold": over("scores")(lambda s: ranking.best_f1(totals(s))),
    "metric_accuracy": over("scores")(lambda s: evaluation.accuracy(s, "TARGET", "P_A")),
    "metric_confusion": over("scores")(lambda s: evaluation.confusion(s, "TARGET", "P_A")),
    "metric_classification": over("scores")(lambda s: evaluation.classification_report(s, "TARGET", "P_A")),
    "metric_calibration": over("scores")(lambda s: evaluation.calibration(s, "TARGET", "P_A")),
    "threshold_sweep": over("scores")(lambda s: evaluation.threshold_sweep(s, "TARGET", "P_A")),
    "ensemble_mean": over("scores")(ensemble_mean),
    "ensemble_weighted": over("scores")(ensemble_weighted),
    "ensemble_vote": over("scores")(lambda s: evaluation.majority_vote(s, KEY, "TARGET", MODELS)),
    "ensemble_rank": over("scores")(lambda s: evaluation.mean_rank(s, KEY, "TARGET", MODELS)),
    "ensemble_summary": over("scores")(ensemble_summary),
    "ensemble_stacking": over("scores")(ensemble_stacking),
    "stacking_folds": over("scores")(stacking_folds),
    "train_gbt": train_gbt,
    "tune_gbt": tune_gbt,
    "batch_score": batch_score,
    "score_requests": score_requests,
}
