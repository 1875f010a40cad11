"""What the registered model queries ask of the trees."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskloom.operators import boosting, models
from riskloom.plans import learning


class Asked(Exception):
    pass


def _stop(self, rows, *args):
    raise Asked(self)


@pytest.fixture
def asked(spark, monkeypatch):
    rows = spark.createDataFrame([(k, k % 2.0) for k in range(8)], "SK_ID_CURR long, TARGET double")
    monkeypatch.setattr(learning, "_split", lambda spark, sf_dir: (rows, rows))
    monkeypatch.setattr(Pipeline, "fit", _stop)

    def run(name):
        with pytest.raises(Asked) as stopped:
            learning.QUERIES[name](spark, "")
        return stopped.value.args[0]

    return run


@pytest.mark.parametrize(("name", "rounds", "depth"), [("train_gbt", 150, 5), ("batch_score", 300, 4), ("score_requests", 150, 5)])
def test_rounds_and_depth(asked, name, rounds, depth):
    trees = asked(name).getStages()[-1]
    assert (trees.getMaxIter(), trees.getMaxDepth()) == (rounds, depth)


def test_no_row_is_scored_by_a_model_that_saw_it(spark):
    """The fitted model tells which keys it saw."""
    seen = []

    class Model:
        def __init__(self, keys):
            self.keys = keys

        def transform(self, rows):
            assert not self.keys & {r["SK_ID_CURR"] for r in rows.collect()}
            return rows.withColumn("probability", F.expr("array(0D, 1D)"))

    def fit(rows):
        seen.append({r["SK_ID_CURR"] for r in rows.collect()})
        return Model(seen[-1])

    rows = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(101)], "SK_ID_CURR long, TARGET int")
    patched = models.vector_to_array
    models.vector_to_array = lambda c: F.col(c)
    try:
        got = models.out_of_fold(rows, fit, folds=3).collect()
    finally:
        models.vector_to_array = patched
    assert sorted(r["SK_ID_CURR"] for r in got) == list(range(101)) and len(seen) == 3
    sizes = {(f, t): sum(r["fold"] == f and r["TARGET"] == t for r in got) for f in range(3) for t in (0, 1)}
    assert {sizes[f, 1] for f in range(3)} == {8, 9} and {sizes[f, 0] for f in range(3)} == {25}


def test_candidates_and_folds(monkeypatch, spark):
    rows = spark.createDataFrame([(k, k % 2.0, "x") for k in range(8)], "SK_ID_CURR long, TARGET double, bins string")
    monkeypatch.setattr(learning, "_split", lambda spark, sf_dir: (rows, rows))
    monkeypatch.setattr(boosting, "binned", lambda df, *features: df)
    asked = {}
    monkeypatch.setattr(boosting, "search", lambda rows, points, folds=3: asked.update(points=points, folds=folds) or rows.select(rows["SK_ID_CURR"].cast("int").alias("candidate")))
    learning.tune_gbt(spark, "")
    points = asked["points"]
    assert asked["folds"] == 3 and len(set(points)) == 10 and all(p.rounds >= 200 for p in points)
    assert all(value in learning.SEARCH[name] for p in points for name, value in p._asdict().items())
