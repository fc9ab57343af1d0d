"""Metrics, drift, gates, registry and scoring invariants."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from staywise.functions import rules
from staywise.operators import drift, metrics, quality, registry, scoring


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        label = int(rng.random() < 0.3)
        p = round(min(max(rng.gauss(0.35 + 0.3 * label, 0.2), 0.0), 1.0), 2)
        rows.append((i, label, float(p > 0.5), p, "train" if i % 3 else "val"))
    return spark.createDataFrame(rows, "id int, label int, prediction double, probability double, split string").cache()


def test_auc_equals_exact_evaluator(predictions):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
    assert metrics.roc_auc(predictions).first()["auc"] == pytest.approx(evaluator.evaluate(predictions), abs=1e-12)


def test_auc_without_one_class_is_null(predictions):
    assert metrics.roc_auc(predictions.filter("label = 1")).first()["auc"] is None


def test_counts_and_scores(predictions):
    c = metrics.confusion_counts(predictions).first()
    assert c.tp + c.fp + c.fn + c.tn == 900
    s = metrics.classification_scores(predictions).first()
    assert s.accuracy == pytest.approx((c.tp + c.tn) / 900) and s.recall_weighted == pytest.approx(s.accuracy)
    report = {r["class"]: r for r in metrics.class_report(predictions).collect()}
    assert report[1].precision == s.precision_churn and report[0].support + report[1].support == 900


def test_scores_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(1, 0.0, 0.1), (0, 0.0, 0.2)], "label int, prediction double, probability double")
    s = metrics.classification_scores(df).first()
    assert (s.precision_churn, s.recall_churn, s.f1_churn, s.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_business_metrics(predictions):
    b = metrics.business_metrics(predictions).first()
    c = metrics.confusion_counts(predictions).first()
    costs = c.fn * 1000 + c.fp * 100
    assert b.roi == pytest.approx((c.tp * 900 - costs) / max(costs, 1))


def test_folds(predictions):
    rows = predictions.withColumn("fold", rules.hash_fold(F.col("id"), 42, 10))
    r = metrics.fold_stability(rows, "fold").first()
    assert r.folds == 10 and r.cv_min_accuracy <= r.cv_mean_accuracy <= r.cv_max_accuracy


def test_leaderboard_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.8)], "model string, val_accuracy double")
    best = metrics.leaderboard(df, ["c", "a", "b"]).filter("is_best").collect()
    assert [r.model for r in best] == ["a"]


def test_drift_of_equal_and_shifted_data(spark):
    base = spark.range(2000).select((F.col("id") % 100).cast("double").alias("x"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("y"))
    moved = base.withColumn("x", F.col("x") + 200).withColumn("y", F.col("y") * 1.0)
    same = drift.stacked_features({"baseline": base, "current": base}, ["x", "y"])
    assert {r.psi for r in drift.psi(same).collect()} == {0.0}
    assert {r.ks for r in drift.ks(same).collect()} == {0.0}
    shifted = drift.stacked_features({"baseline": base, "current": moved}, ["x", "y"])
    gaps = {r.feature: r.ks for r in drift.ks(shifted).collect()}
    assert gaps == {"x": 1.0, "y": 0.0}
    stability = drift.psi(shifted)
    alert = drift.drift_alerts(stability, "psi").first()
    assert alert.feature == "x" and alert.alert and alert.features_over_threshold == 1


def test_retrain_decision(spark):
    df = spark.createDataFrame(
        [("ok", 0.90, 0.902, 0.01), ("slow", 0.86, 0.95, 0.0), ("moved", 0.9, 0.9, 0.06), ("weak", 0.84, 0.85, 0.0), ("new", None, None, None)],
        "segment string, current_accuracy double, baseline_accuracy double, drift_score double",
    )
    rows = {r.segment: r for r in drift.retrain_decision(df).collect()}
    assert {k: r.requires_retraining for k, r in rows.items()} == {
        "ok": False, "slow": True, "moved": True, "weak": True, "new": True,
    }
    assert rows["new"].baseline_accuracy == 0.0 and not rows["new"].data_drift_detected


def test_candidate_gates_and_registry(spark):
    df = spark.createDataFrame(
        [("good", 0.91, 0.93, 0.9, 0.9, 100), ("low", 0.80, 0.80, 0.9, 0.7, 100), ("worse", 0.86, 0.9, 0.7, 0.9, 100)],
        "model string, accuracy double, auc double, precision double, recall double, n long",
    ).withColumn("baseline_accuracy", F.lit(0.902))
    rows = {r.model: r for r in drift.candidate_validation(df).collect()}
    assert rows["good"].validation_passed and rows["good"].estimated_customer_saves == 80
    assert len(rows["low"].rejection_reasons) == 3 and rows["worse"].rejection_reasons == ["accuracy drop above 0.02"]
    strict = {r.model: r for r in drift.candidate_validation(df, check_precision_recall=True).collect()}
    assert len(strict["worse"].rejection_reasons) == 2
    table = registry.with_current(registry.registry_rows(drift.candidate_validation(df), "2024-01-31"))
    assert [r.model_type for r in table.filter("is_current").collect()] == ["good"]


def test_ab_equal_arms(spark):
    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("arm"), (F.col("id") % 8 < 2).alias("hit"))
    r = drift.ab_compare(df, "arm", "hit").first()
    assert (r.n_a, r.n_b, r.lift, r.z) == (200, 200, 0.0, 0.0)


def test_validation_keeps_bad_rows(spark):
    names = "customer_id string, recency_30d double, frequency_30d double, monetary_total_30d double, monetary_avg_30d double, engagement_score double, customer_tenure_months int, support_tickets_30d int, age int, value_tier string"
    df = spark.createDataFrame(
        [
            ("a", 1.0, 1.0, 1.0, 1.0, 0.5, 1, 0, None, "premium"),
            ("b", -1.0, 1.0, None, 1.0, 1.1, 1, 0, 17, "gold"),
            (None, 1.0, 1.0, 1.0, 1.0, 1.0, 0, 0, 100, None),
        ],
        names,
    )
    checked = scoring.checked_inputs(df)
    good, bad = scoring.split_valid(checked)
    assert good.count() == 1 and bad.count() == 2
    rows = {r.customer_id: r for r in checked.collect()}
    assert rows["a"].age == 35 and rows["b"].value_tier == "medium_value"
    assert rows["b"].errors == [
        "recency_30d: below 0", "monetary_total_30d: missing", "engagement_score: above 1", "age: below 18",
    ]


def test_score_once_scores_each_record_once(spark):
    requests = spark.createDataFrame(
        [(1, "x", 5, 1.0), (2, "x", 3, 1.0), (3, "x", 3, 2.0), (4, "y", 9, 1.0)], "request_id long, customer_id string, ts int, v double"
    )
    out = scoring.score_once(requests, ["customer_id", "v"], lambda d: d.select("fingerprint", "first_request", (F.col("v") / 10).alias("p")))
    assert sorted((r.request_id, r.cache_hit, r.p) for r in out.collect()) == [
        (1, True, 0.1), (2, False, 0.1), (3, False, 0.2), (4, False, 0.1),
    ]


def test_serving_metrics_of_an_empty_log(spark):
    log = spark.createDataFrame([], "request_id long, ts timestamp, response_ms double, cache_hit boolean, error boolean")
    r = scoring.serving_metrics(log).first()
    assert (r.total_predictions, r.avg_response_time_ms, r.cache_hit_rate, r.error_rate) == (0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("rows", (1, 7, 40, 1001, 5000))
def test_newest_requests_at_any_buffer(spark, rows):
    start = datetime(2024, 1, 1)
    log = [(k, start + timedelta(hours=k * 7 % 900)) for k in range(2000)] + [(9001, None), (9002, None)]
    df = spark.createDataFrame(log, "request_id long, ts timestamp_ntz").repartition(8)
    newest = scoring.newest_requests(df, rows)
    assert "TakeOrderedAndProject" in newest._jdf.queryExecution().executedPlan().toString()
    want = sorted(log, key=lambda r: (r[1] is not None, r[1] or start, r[0]), reverse=True)[:rows]
    assert sorted(r.request_id for r in newest.collect()) == sorted(k for k, _ in want)


def test_quality_of_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, None), ("b", 5)], "id string, v int")
    r = quality.quality_summary(df, "id", {"v": (0, None)}).first()
    assert (r.records_extracted, r.duplicate_keys, r.rows_with_violation, r.data_quality_score) == (4, 1, 1, 0.75)
    assert r.missing_values_pct == 25.0
    kept = {c.column_name: c for c in quality.cardinality(df, ["id", "v"], 2).collect()}
    assert kept["id"].kept and not kept["v"].kept
