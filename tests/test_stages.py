"""Stages fitted on training rows, saved and loaded inside one model."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskloom.operators import models, stages
from riskloom.session import fresh_path

NUMERIC, TEXT = ["AMT", "PREV_COUNT", "PREV_RATE", "NONE"], ["KIND", "PLACE"]


def rows(n, seed, kinds):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        amount = None if k % 10 == 0 else float(rng.normal(0, 10))
        out.append((k, float(k % 3 == 0), amount, None if k % 4 else float(k), None if k % 7 == 0 else k / n, None, None if k % 5 == 0 else kinds[k % len(kinds)], "x" if k % 3 else "y"))
    return out


SCHEMA = "SK_ID_CURR long, TARGET double, AMT double, PREV_COUNT double, PREV_RATE double, NONE double, KIND string, PLACE string"


def test_fit_on_train_apply_to_test(spark):
    train = spark.createDataFrame(rows(1000, 1, ["a", "b", "b", "c"]), SCHEMA)
    test = spark.createDataFrame([*rows(50, 2, ["a", "new"]), (99, 0.0, 1e9, None, None, None, "c", None)], SCHEMA)
    chain = [stages.ClipQuantiles(inputCols=NUMERIC, low=0.01, high=0.99), stages.FillMissing(inputCols=NUMERIC, texts=TEXT), stages.CategoryCodes(inputCols=TEXT)]
    path = fresh_path(spark, "test-stages")
    Pipeline(stages=chain).fit(train).write().overwrite().save(path)
    model = PipelineModel.load(path)
    got = {r["SK_ID_CURR"]: r for r in model.transform(test).collect()}
    amounts = np.array([r[2] for r in rows(1000, 1, "a") if r[2] is not None])
    low, high = np.quantile(amounts, [0.01, 0.99], method="nearest")
    assert got[99]["AMT"] == high and got[99]["PREV_COUNT"] == 0.0 and got[99]["NONE"] is None
    assert got[0]["AMT"] == np.median(np.clip(amounts, low, high))
    rates = np.clip([k / 1000 for k in range(1000) if k % 7], *np.quantile([k / 1000 for k in range(1000) if k % 7], [0.01, 0.99], method="nearest"))
    assert abs(got[7]["PREV_RATE"] - np.median(rates)) < 1e-12
    codes = {"a": 0, "b": 1, "c": 2, "new": -1}
    for k in range(50):
        kind = "b" if k % 5 == 0 else ["a", "new"][k % 2]
        assert got[k]["KIND"] == codes[kind] and got[k]["PLACE"] == (0 if k % 3 else 1)
    assert got[99]["PLACE"] == 0  # the most frequent value


def test_chain_saved_and_loaded(spark):
    train = spark.createDataFrame(rows(300, 3, ["a", "b"]), SCHEMA).withColumn("TARGET", F.when(F.col("AMT") > 0, 1.0).otherwise(0.0))
    fitted = stages.training_chain(["AMT", "PREV_RATE"], TEXT, rounds=3).fit(train)
    path = fresh_path(spark, "test-chain")
    models.save_model(fitted, path, ["AMT", "PREV_RATE"], TEXT)
    model, metadata = models.load_model(spark, path)
    assert metadata["feature_count"] == 4
    one, two = ({r["SK_ID_CURR"]: r["probability"] for r in models.score(m, train, ["SK_ID_CURR"]).collect()} for m in (fitted, model))
    assert one == two and len(one) == 300 and len(set(one.values())) > 1
