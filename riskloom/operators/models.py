"""Gradient-boosted trees with Spark ML: fit, evaluate, tune, score."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.decisions import SERVICE_THRESHOLD, decide
from riskloom.functions.numeric import col
from riskloom.operators.prepare import KEY, TARGET, class_order, class_weights
from riskloom.session import materialise


def discover(df: DataFrame, exclude: list[str] = (KEY, TARGET)) -> tuple[list[str], list[str]]:
    """Numeric (booleans too) and other columns by type."""
    numeric = [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    return numeric, [c for c in df.columns if c not in exclude and c not in numeric]


def as_doubles(df: DataFrame, numeric: list[str], label: str | None = TARGET) -> DataFrame:
    return df.withColumns({c: col(c).cast("double") for c in [*numeric, *([label] if label else [])]})


def gbt_pipeline(
    numeric: list[str], categorical: list[str], label: str = TARGET, max_depth: int = 5, max_iter: int = 150,
    weight: str | None = None, seed: int = 42, step: float = 0.1, subsample: float = 1.0,
) -> Pipeline:
    """Median imputer, string indexer, assembler and boosted trees."""
    imputed = [f"{c}__imputed" for c in numeric]
    indexed = [f"{c}__idx" for c in categorical]
    stages = []
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=imputed))
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=imputed + indexed, outputCol="features", handleInvalid="keep"))
    trees = GBTClassifier(
        labelCol=label, featuresCol="features", maxDepth=max_depth, maxIter=max_iter, seed=seed, stepSize=step,
        subsamplingRate=subsample, maxBins=64,
    )
    stages.append(trees.setWeightCol(weight) if weight else trees)
    return Pipeline(stages=stages)


def with_class_weight(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Add ``class_weight``, the balanced weight of the row's class."""
    weights = class_weights(df, label).agg(F.map_from_entries(F.collect_list(F.struct(label, "weight")))).scalar()
    return df.withColumn("class_weight", weights[col(label)])


def evaluate_auc(scored: DataFrame, label: str = TARGET) -> float:
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
    ).evaluate(scored)


def score(model: PipelineModel, df: DataFrame, keep: list[str], threshold: float = SERVICE_THRESHOLD) -> DataFrame:
    """Probability of default and decision for every row."""
    p = vector_to_array("probability")[1]
    scored = model.transform(df).withColumn("p_default", p)
    return scored.select(*keep, F.col("p_default").alias("probability"), decide("p_default", threshold).alias("decision"))


def importances(model: PipelineModel, names: list[str]) -> list[tuple[str, float]]:
    """(feature, importance) of the fitted trees, strongest first."""
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, (float(v) for v in values)), key=lambda e: (-e[1], e[0]))


def fit_stacking(df: DataFrame, models: list[str], label: str = TARGET) -> PipelineModel:
    """Logistic regression over the models' scores."""
    stages = [
        VectorAssembler(inputCols=models, outputCol="features"),
        LogisticRegression(labelCol=label, featuresCol="features", maxIter=1000),
    ]
    return Pipeline(stages=stages).fit(df.withColumn(label, col(label).cast("double")))


def out_of_fold(df: DataFrame, fit: Callable[[DataFrame], PipelineModel], key: str = KEY, label: str = TARGET, folds: int = 5) -> DataFrame:
    """Rows with ``fold`` and ``p_default``, the probability by the model that ``fit`` made of the
    other folds: no row is scored by a model that saw it. Folds are even within each class."""
    rows = materialise(class_order(df, key, label).withColumn("fold", (F.col("place") % folds).cast("int")).drop("place", "class_rows"), "folds")
    out = None
    for k in range(folds):
        model = fit(rows.where(F.col("fold") != k).drop("fold"))
        scored = model.transform(rows.where(F.col("fold") == k)).withColumn("p_default", vector_to_array("probability")[1])
        part = scored.select(*rows.columns, "p_default")
        out = part if out is None else out.unionByName(part)
    return out


def save_model(model: PipelineModel, path: str, numeric: list[str], categorical: list[str], entity: str = KEY) -> None:
    """Model plus the metadata the scoring side needs, next to it."""
    model.write().overwrite().save(path)
    metadata = {
        "entity": entity,
        "selected_features": [*numeric, *categorical],
        "numeric_features": numeric,
        "categorical_features": categorical,
        "feature_count": len(numeric) + len(categorical),
        "model_signature": {"inputs": [c.upper() for c in [*numeric, *categorical]]},
    }
    session = SparkSession.getActiveSession()
    session.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}-metadata"
    )


def load_model(spark, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(path), json.loads(spark.read.text(f"{path}-metadata").first()[0])
