"""Preparation, training, comparison, storage and scoring with Spark ML, on the tiny preset."""

import math
import random
import threading
from dataclasses import replace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staywise.functions import rules
from staywise.operators import ml, scoring, search

SCHEMA = (
    "customer_id string, recency_30d double, frequency_30d double, monetary_total_30d double, monetary_avg_30d double,"
    " engagement_score double, customer_tenure_months int, support_tickets_30d int, age int, value_tier string, churned int"
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(42)
    data = []
    for i in range(600):
        recency, often, score = rng.expovariate(1 / 30), rng.randrange(9), rng.betavariate(2, 2)
        p = recency / 100 * 0.3 + 0.3 / (often + 1) + (1 - score) * 0.4
        data.append(
            (
                f"C{i:05d}", recency if i % 20 else None, float(often), rng.lognormvariate(5, 1), 10.0, score,
                rng.randrange(1, 60), rng.randrange(4), rng.randrange(18, 80),
                rng.choice(["low_value", "high_value", None]), int(p + rng.gauss(0, 0.1) > 0.5),
            )
        )
    shares = (("train", 0.7), ("val", 0.1), ("test", 0.2))
    return spark.createDataFrame(data, SCHEMA).withColumn("split", rules.hash_split(F.col("customer_id"), 42, shares))


@pytest.fixture(scope="module")
def result(rows, tmp_path_factory):
    preset = replace(ml.TINY, grids={**ml.TINY.grids, "neural_network": {"hidden": [(0,)], "stepSize": [0.1]}})
    path = str(tmp_path_factory.mktemp("search") / "store")
    return search.train_and_compare(rows, "churned", preset, path, ignore=["customer_id"])


def test_one_failing_model_does_not_stop_the_others(result):
    errors = {r["model"]: r["error"] for r in result.runs}
    assert list(errors) == list(ml.MODEL_ORDER)
    assert errors["neural_network"] and not any(e for m, e in errors.items() if m != "neural_network")


def test_metrics_are_plausible_and_the_winner_has_the_best_accuracy(result):
    scores = {r["model"]: r["metrics"] for r in result.runs if not r["error"]}
    for m in scores.values():
        assert 0.5 < m["val_auc"] <= 1 and 0.5 < m["train_accuracy"] <= 1 and m["cv_std"] >= 0
    assert scores[result.best_model]["val_accuracy"] == max(m["val_accuracy"] for m in scores.values())


def test_report_importance_and_runs(spark, result):
    report = {r.metric: r.value for r in ml.final_report(result).collect()}
    assert report["n"] == report["true_positives"] + report["false_positives"] + report["true_negatives"] + report["false_negatives"]
    top = ml.importance_table(spark, result, ml.tree_model(result)).collect()
    assert sum(r.importance for r in top) == pytest.approx(1.0) and {r.feature for r in top} <= set(result.columns.all)
    assert ml.runs_table(spark, result).filter("error IS NOT NULL").count() == 1


def test_saved_model_scores_like_the_trained_one(spark, result, rows, tmp_path):
    path, registry = str(tmp_path / "model"), str(tmp_path / "registry")
    ml.save_model(result, path, registry, "2024-01-31")
    assert spark.read.parquet(registry).first().model_type == result.best_model
    inputs = rows.drop("churned", "split", "age")
    scored = scoring.score_with_model(ml.load_model(path), inputs, result.columns.all)
    again = scoring.score_with_model(result.pipeline(), inputs, result.columns.all)
    assert scored.columns == [
        "customer_id", "churn_probability", "churn_prediction", "risk_level", "confidence_score", "recommended_actions",
        "model_version",
    ]
    assert sorted(map(str, scored.collect())) == sorted(map(str, again.collect()))


def test_columns_by_type_and_cardinality(spark):
    df = spark.range(80).select(
        F.col("id").cast("string").alias("many"), (F.col("id") % 3).cast("string").alias("few"), F.col("id").alias("n"),
        F.current_date().alias("d"), (F.col("id") % 2).alias("y"),
    )
    columns = ml.choose_columns(df, "y")
    assert (columns.numeric, columns.categorical, columns.dropped) == (["n"], ["few"], ["many", "d"])
    with pytest.raises(ValueError):
        ml.choose_columns(df, "missing")


def test_unseen_category_gives_zeros_and_text_target_is_indexed(spark):
    train = spark.createDataFrame([("a", "yes"), ("b", "no"), (None, "no")], "c string, y string")
    model = ml.preparation(ml.FeatureColumns([], ["c"])).fit(train)
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    slots = [r[0] for r in model.transform(new).select(vector_to_array("features")).collect()]
    assert slots == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 1.0]]
    assert [r.label for r in ml.indexed_target(train, "y").collect()] == [1.0, 0.0, 0.0]


def test_numeric_fit_uses_interpolated_median_and_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    fit = ml.fit_numeric(df, ["x"])
    values = [1.0, 2.0, 4.0, 10.0, 3.0]
    mean = sum(values) / 5
    assert fit.median["x"] == 3.0 and fit.mean["x"] == pytest.approx(mean)
    assert fit.deviation["x"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / 5))


def test_training_prepares_numbers_as_the_checked_query_does(spark):
    rows = [(1.0, 5.0, None), (2.0, 5.0, None), (None, 5.0, None), (float("nan"), 5.0, None), (9.5e-7, None, None)]
    df = spark.createDataFrame(rows, "x double, same double, none double")
    names = ["x", "same", "none"]
    fit = ml.fit_numeric(df, names)
    assert fit.median["x"] == 1.0
    model = ml.preparation(ml.FeatureColumns(names, []), fit).fit(df)
    got = sorted(r[0] for r in model.transform(df).select(vector_to_array("features")).collect())
    assert got == sorted(list(r) for r in ml.apply_numeric(df, fit).select(*names).collect())


def test_draws_are_seeded_and_unique():
    grid = ml.FULL.grids["random_forest"]
    first, second = ml.drawn(grid, 20), ml.drawn(grid, 20)
    assert first == second and len({str(c) for c in first}) == 20
    assert len(ml.drawn(ml.SHORT.grids["random_forest"], None)) == 27


def _trees(parts, **changes):
    return replace(ml.TINY, grids={m: ml.TINY.grids[m] for m in parts}, **changes)


def test_a_search_in_pieces_trains_no_cell_twice(rows, tmp_path, monkeypatch):
    preset, path, trained = _trees(["random_forest", "logistic_regression"], parallelism=1), str(tmp_path / "store"), []
    put = search.SearchStore.put
    monkeypatch.setattr(search.SearchStore, "put", lambda self, *a: (trained.append(a[:3]), put(self, *a))[1])
    begin = lambda p=preset: search.Search(rows, "churned", p, path, ignore=["customer_id"])
    first = begin()
    assert first.advance(most=3) == 5
    with pytest.raises(ValueError, match="unfinished"):
        first.result()
    first.close()
    # A new start, as after a crash: what is stored stays, the rest is trained.
    assert begin().advance(seconds=0.0001) == 5 - (len(trained) - 3)
    second = begin()
    assert second.advance() == 0
    cells = [t for t in trained if t[0] == "cells"]
    assert len(cells) == len(set(cells)) == 8
    in_pieces = second.result()
    # Finished: nothing is fitted again, models and figures come from the store.
    monkeypatch.setattr(search.Search, "_fit", None)
    again = search.train_and_compare(rows, "churned", preset, path, ignore=["customer_id"])
    assert again.runs == in_pieces.runs and again.best_model == in_pieces.best_model
    key = ["customer_id"]
    assert sorted(map(str, again.scored_test().select(*key, "probability").collect())) == sorted(
        map(str, in_pieces.scored_test().select(*key, "probability").collect())
    )


def test_pieces_and_one_call_agree(rows, tmp_path):
    preset = _trees(["random_forest"])
    whole = search.train_and_compare(rows, "churned", preset, str(tmp_path / "a"), ignore=["customer_id"])
    pieces = search.Search(rows, "churned", preset, str(tmp_path / "b"), ignore=["customer_id"])
    while pieces.advance(most=1):
        pass
    drop = lambda r: {k: v for k, v in r["metrics"].items() if k != "training_time"}
    parts = pieces.result()
    assert [r["params"] for r in whole.runs] == [r["params"] for r in parts.runs]
    for a, b in zip(whole.runs, parts.runs, strict=True):
        assert drop(a) == pytest.approx(drop(b))


def test_equal_rows_are_in_one_fold_and_folds_do_not_depend_on_partitions(rows, tmp_path):
    preset = _trees(["logistic_regression"])
    twice = rows.union(rows)
    fold = lambda df, name: {
        str(r[:-1]): r[-1]
        for r in search.Search(df, "churned", preset, str(tmp_path / name), ignore=["customer_id"])
        .ready.select("split", "label", vector_to_array("features"), "fold").collect()
    }
    one, other = fold(twice, "one"), fold(twice.repartition(7), "other")
    assert len(one) <= 600 and sorted(one.values()) == sorted(other.values())


def test_larger_search_reuses_the_cells_of_a_smaller_one(rows, tmp_path):
    path, small = str(tmp_path / "store"), _trees(["logistic_regression"])
    search.train_and_compare(rows, "churned", small, path, ignore=["customer_id"])
    larger = replace(small, grids={"logistic_regression": {"C": [1, 10, 100], "mix": [0.0]}})
    assert len(search.Search(rows, "churned", larger, path, ignore=["customer_id"]).missing()) == 2


def test_a_final_fit_does_not_wait_for_the_cells_of_other_models(rows, tmp_path, monkeypatch):
    preset, finished = _trees(["random_forest", "logistic_regression"], parallelism=1), threading.Event()
    train, finish, early = search.Search._train_cell, search.Search._finished, []

    def cell(self, asked):
        if asked.model == "logistic_regression":
            early.append(finished.wait(60))
        train(self, asked)

    def final(self, name, scored):
        found = finish(self, name, scored)
        finished.set()
        return found

    monkeypatch.setattr(search.Search, "_train_cell", cell)
    monkeypatch.setattr(search.Search, "_finished", final)
    result = search.train_and_compare(rows, "churned", preset, str(tmp_path / "store"), ignore=["customer_id"])
    assert early and all(early) and [r["error"] for r in result.runs] == [None, None]


def test_fits_read_stored_rows_not_blocks_that_one_executor_holds(rows, tmp_path, monkeypatch):
    fit, given, path = search.Search._fit, [], str(tmp_path / "store")
    monkeypatch.setattr(search.Search, "_fit", lambda self, name, params, df, n: (given.append(df), fit(self, name, params, df, n))[1])
    search.train_and_compare(rows, "churned", _trees(["logistic_regression"]), path, ignore=["customer_id"])
    assert len(given) == 5
    for df in given:
        assert df.inputFiles() and all(f"{path}/ready-" in f for f in df.inputFiles())
        assert "InMemoryTableScan" not in df._jdf.queryExecution().executedPlan().toString()


def test_other_models_get_the_cores_that_the_first_one_leaves(rows, tmp_path, monkeypatch):
    preset = _trees(["random_forest", "logistic_regression"], folds=6, parallelism=30)
    started, all_started = [], threading.Event()

    def cell(self, asked):
        started.append(asked.model)
        if len(started) == 12:
            all_started.set()
        all_started.wait(10)

    monkeypatch.setattr(search.Search, "_train_cell", cell)
    monkeypatch.setattr(search.Search, "_try_finish", lambda self, name: None)
    monkeypatch.setattr(search.Search, "result", lambda self: None)
    assert rows.sparkSession.sparkContext.defaultParallelism < 12
    search.train_and_compare(rows, "churned", preset, str(tmp_path / "store"), ignore=["customer_id"])
    assert started == ["random_forest"] * 12 + ["logistic_regression"] * 12
