"""Fits that share their passes over the rows, against Spark's own estimators."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from staywise.operators import ml, passes, search

WIDTH = 4


@pytest.fixture(scope="module")
def ready(spark):
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, k, 1500) for k in (20, 9, 3, 2)], 1).astype(float)
    y = (x[:, 0] / 10 + (x[:, 1] > 4) * x[:, 2] - x[:, 3] + rng.logistic(size=1500) > 1).astype(float)
    rows = [(float(a), Vectors.dense(b), int(k)) for a, b, k in zip(y, x.tolist(), rng.integers(0, 3, 1500), strict=True)]
    return spark.createDataFrame(rows, ["label", "features", "fold"]).select("label", "features", F.col("fold").cast("int")).coalesce(1).cache()


@pytest.fixture(scope="module")
def fits(ready, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("blocks") / "b")
    passes.packed(ready, 40_000, 8).write.parquet(path)  # as if for more rows, so that there are several blocks
    rows = {r["fold"]: r["count"] for r in ready.groupBy("fold").count().collect()}
    return passes.Passes(ready, ready.sparkSession.read.schema(passes.BLOCKS).parquet(path), WIDTH, rows, 42)


def scores(model, rows):
    return [r[0] for r in ml.with_probability(model.transform(rows)).select("probability").collect()]


def area(model, rows):
    return BinaryClassificationEvaluator(numBins=0).evaluate(model.transform(rows))


def test_boosted_trees_are_those_of_spark_where_both_try_all_splits(ready, fits):
    estimator = GBTClassifier(maxIter=6, maxDepth=3, minInstancesPerNode=5, seed=42)
    assert fits.blocks.getNumPartitions() > 1
    theirs, ours = estimator.fit(ready), fits.model("gradient_boosting", estimator)
    assert scores(ours, ready) == pytest.approx(scores(theirs, ready), abs=1e-9)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    assert (ours.getNumTrees, ours.totalNumNodes) == (theirs.getNumTrees, theirs.totalNumNodes)
    told = lambda m: {p.name: v for p, v in m.extractParamMap().items()}
    assert told(ours) == told(theirs)


def test_cells_are_judged_on_their_own_fold_by_what_the_others_taught(ready, fits):
    estimators = [GBTClassifier(maxIter=n, maxDepth=d, seed=42) for n, d in ((4, 2), (2, 3))]
    judged = fits.judged("gradient_boosting", [e for e in estimators for _ in range(3)], [0, 1, 2] * 2)[0]
    for (auc, accuracy), (e, k) in zip(judged, [(e, k) for e in estimators for k in range(3)], strict=True):
        model, rows = e.fit(ready.filter(F.col("fold") != k)), ready.filter(F.col("fold") == k)
        assert auc == pytest.approx(area(model, rows), abs=1e-9)
        assert accuracy == pytest.approx(model.transform(rows).agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0])


def test_networks_descend_as_those_of_spark(ready, fits):
    estimator = MultilayerPerceptronClassifier(layers=[WIDTH, 5, 2], maxIter=40, stepSize=0.3, seed=42, solver="gd", blockSize=1500)
    theirs, ours = estimator.fit(ready), fits.model("neural_network", estimator)
    assert ours.weights.toArray() == pytest.approx(theirs.weights.toArray(), abs=1e-4)
    assert scores(ours, ready) == pytest.approx(scores(theirs, ready), abs=1e-4) and ours.getMaxIter() == 40


def test_forests_judge_about_as_those_of_spark_and_share_their_trees(ready, fits):
    small, large = (RandomForestClassifier(numTrees=n, maxDepth=6, minInstancesPerNode=2, seed=42) for n in (5, 30))
    theirs, ours = large.fit(ready), fits.model("random_forest", large)
    assert area(ours, ready) == pytest.approx(area(theirs, ready), abs=0.02)
    first = fits.model("random_forest", small)
    assert [t.toDebugString.split("\n", 1)[1] for t in first.trees] == [t.toDebugString.split("\n", 1)[1] for t in ours.trees[:5]]
    assert all(t.depth <= 6 for t in ours.trees) and ours.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_a_leaf_stays_a_leaf():
    tree, none = passes.Tree.empty(3), np.zeros((2, 2))
    tree.grown(0, (np.array([1]), np.array([3]), np.array([0.5]), np.array([True]), np.array([[4.0, 0.0]]), np.array([[4.0, 6.0]])))
    tree.grown(1, (np.zeros(2, int), np.zeros(2, int), np.zeros(2), np.array([False, False]), none, none))
    tree.grown(2, (np.ones(4, int), np.ones(4, int), np.ones(4), np.ones(4, bool), np.ones((4, 2)), np.ones((4, 2))))
    assert not tree.split[1:].any() and not tree.open_at(2)
    assert tree.values(1, slice(0, 2)).tolist() == [0.0, 0, 0, 0, 1.0, 0, 0, 0]


def test_all_cells_of_a_model_go_through_the_rows_together(spark, tmp_path, monkeypatch):
    rows = spark.range(400).select(
        F.col("id"), (F.col("id") * 7 % 23).cast("double").alias("x"), ((F.col("id") * 7 % 23 > 9) != (F.col("id") % 11 == 0)).cast("int").alias("y"),
        F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 == 7, "val").otherwise("test").alias("split"),
    )
    grow, calls = passes.grow_boosted, []
    monkeypatch.setattr(passes, "grow_boosted", lambda binned, cells, *a: (calls.append([c.fold for c in cells]), grow(binned, cells, *a))[1])
    preset = replace(ml.TINY, grids={"gradient_boosting": {"maxIter": [2, 3], "maxDepth": [2]}})
    result = search.train_and_compare(rows, "y", preset, str(tmp_path / "store"), ignore=["id"])
    assert calls == [[0, 1, 0, 1, passes.EVERYONE, passes.EVERYONE]]
    assert result.best_model == "gradient_boosting" and result.runs[0]["metrics"]["val_auc"] > 0.8
