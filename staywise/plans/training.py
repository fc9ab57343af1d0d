"""Registered queries that train models or run streams."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.functions import rules
from staywise.operators import ml, scoring, search
from staywise.plans import frames
from staywise.plans.queries import AS_OF, query
from staywise.schemas import RAW_EVENTS
from staywise.session import fresh_path, work_folder, written
from staywise.sources.readers import input_state
from staywise.streaming import daily, jobs, rolling

TRAINING_FIELDS = (
    "recency_30d",
    "frequency_30d",
    "monetary_total_30d",
    "engagement_score",
    "customer_tenure_months",
    "support_tickets_30d",
    "age",
    "value_tier",
)

def training_frame(spark: SparkSession, folder: str) -> DataFrame:
    return frames.labelled(spark, folder).select(
        "customer_id", "split", *TRAINING_FIELDS, F.col("label").alias("churned")
    )


def trained(spark: SparkSession, folder: str, preset: ml.Preset = ml.BRIEF) -> ml.TrainingResult:
    """Models of the labelled frame. The search is stored in the work folder under a digest of the input files and the features:
    whoever asks again, also after a restart, gets what is finished from there."""
    state = input_state(spark, [f"{folder}/{t}.parquet" for t in ("customer", "orders", "lineitem", "events")])
    fields = hashlib.md5(",".join(TRAINING_FIELDS).encode()).hexdigest()[:8]
    path = f"{work_folder(spark).rstrip('/')}/search-{state}-{fields}"
    return search.train_and_compare(training_frame(spark, folder), "churned", preset, path, ignore=["customer_id"])


@query
def preprocess_numeric(spark: SparkSession, folder: str) -> DataFrame:
    """Median-imputed, standardised features; fitted on the train rows, applied to all."""
    names = ["recency_30d", "frequency_30d", "monetary_total_30d", "age"]
    df = frames.windowed(spark, folder, frames.LABEL_DATE, windows=(30,)).select(
        "customer_id",
        rules.hash_split(F.col("customer_id"), 42, frames.SPLITS).alias("split"),
        *names,
    )
    df = written(df, "preprocess")
    fit = ml.fit_numeric(df.filter("split = 'train'"), names)
    return ml.apply_numeric(df, fit).select("customer_id", "split", *[F.round(c, 6).alias(c) for c in names])


@query
def preprocess_onehot(spark: SparkSession, folder: str) -> DataFrame:
    """One-hot slots of the categories seen in the train rows, as 0/1 text per column."""
    from pyspark.ml.functions import vector_to_array

    names = ["city_type", "subscription_tier", "value_tier"]
    df = written(frames.labelled(spark, folder).select("customer_id", "split", *names), "onehot")
    fitted = ml.preparation(ml.FeatureColumns([], names)).fit(df.filter("split = 'train'"))
    slots = fitted.transform(df)
    as_text = lambda c: F.array_join(
        F.transform(vector_to_array(f"slot_{c}"), lambda x: x.cast("int").cast("string")), ","
    )
    return slots.select("customer_id", *[as_text(c).alias(c) for c in names])


@query
def stratified_split_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Split with exact shares inside each label, by rank of a digest."""
    rows = written(frames.labelled(spark, folder).select("customer_id", "label"), "labels")
    return ml.exact_split(rows, "customer_id", "label", frames.SPLITS)


@query
def train_models(spark: SparkSession, folder: str) -> DataFrame:
    """Chosen parameters and headline metrics per model."""
    result = trained(spark, folder)
    wide = ml.runs_table(spark, result).groupBy("model", "params", "error").pivot(
        "metric", ["train_accuracy", "val_accuracy", "train_auc", "val_auc", "cv_mean", "cv_std"]
    )
    return wide.agg(F.first("value")).withColumn("is_best", F.col("model") == F.lit(result.best_model))


@query
def training_runs(spark: SparkSession, folder: str) -> DataFrame:
    """All logged metrics, one row per (run, model, metric), stored in the run table and read back."""
    rows = ml.runs_table(spark, trained(spark, folder)).withColumn("run", F.lit(AS_OF.isoformat()))
    return written(rows, "runs")


@query
def feature_importance_topk(spark: SparkSession, folder: str) -> DataFrame:
    result = trained(spark, folder)
    return ml.importance_table(spark, result, ml.tree_model(result))


@query
def final_report(spark: SparkSession, folder: str) -> DataFrame:
    return ml.final_report(trained(spark, folder))


@query
def score_with_trained_model(spark: SparkSession, folder: str) -> DataFrame:
    """The winner saved, loaded again and applied to today's customers."""
    result = trained(spark, folder)
    path = fresh_path(spark, "model")
    ml.save_model(result, path, fresh_path(spark, "models"), AS_OF.isoformat())
    inputs = frames.scoring_inputs(spark, folder)
    scored = scoring.score_with_model(ml.load_model(path), inputs, result.columns.all)
    return scored.withColumn("recommended_actions", F.array_join("recommended_actions", "; "))


# ---- streams ---------------------------------------------------------------------------------------------


ARRIVAL_START = date(2024, 1, 1)
ARRIVAL_DAYS = 8
ARRIVALS = 4


def _arrivals(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The event table in order of arrival: by time, but some events of every fifth day come in last, long after their day."""
    raw = spark.read.schema(RAW_EVENTS).parquet(f"{folder}/events.parquet")
    day = F.col("ts").cast("date")
    step = F.least(F.floor(F.datediff(day, F.lit(ARRIVAL_START)) / ARRIVAL_DAYS), F.lit(ARRIVALS - 1))
    late = (F.dayofmonth(day) % 5 == 0) & (F.col("event_id") % 11 == 0)
    placed = raw.withColumn("_step", F.when(late, F.lit(ARRIVALS)).otherwise(F.greatest(step, F.lit(0))))
    return [placed.filter(F.col("_step") == k).drop("_step") for k in range(ARRIVALS + 1)]


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily partials: the stream takes in each arrival, then the days that got late rows, and only those, are recomputed."""
    arrived, path = fresh_path(spark, "arrived"), fresh_path(spark, "daily")
    for rows in _arrivals(spark, folder):
        rows.write.mode("append").parquet(arrived)
        daily.run(jobs.event_stream(spark, arrived, files="*.parquet"), path)
    daily.backfill(jobs.event_batch(spark, folder), path)
    return daily.table(spark, path)


@query
def stream_engagement_daily(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _daily(spark, folder)
        .groupBy("customer_id", "day", "event_type")
        .agg(F.sum("events").alias("events"), F.sum("minutes").cast("double").alias("minutes"))
    )


@query
def stream_behavior_features(spark: SparkSession, folder: str) -> DataFrame:
    """Windowed engagement features kept up to date by the stream of daily partials."""
    rows = _daily(spark, folder).withColumn("day_start", jobs.instant(F.col("day").cast("timestamp_ntz")))
    return jobs.features_from_daily(rows, AS_OF)


@query
def stream_serving_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Serving figures from the state that the stream of requests carries along; the log is not read again."""
    arrived, path, state = fresh_path(spark, "arrived"), fresh_path(spark, "rolling"), None
    for rows in _arrivals(spark, folder):
        rows.write.mode("append").parquet(arrived)
        state = rolling.run(jobs.as_requests(jobs.event_stream(spark, arrived, files="*.parquet")), path)
    return rolling.figures(state).withColumn("last_prediction", F.date_format("last_prediction", "yyyy-MM-dd HH:mm:ss"))


@query
def stream_scores(spark: SparkSession, folder: str) -> DataFrame:
    inputs = written(frames.scoring_inputs(spark, folder).select(*scoring.INPUT_FIELDS), "inputs")
    return jobs.run_append(
        jobs.scored_stream(jobs.request_stream(spark, folder), inputs), fresh_path(spark, "scores")
    )


@query
def stream_score_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Records scored once per hour of requests, late ones included."""
    inputs = written(frames.scoring_inputs(spark, folder).select(*scoring.INPUT_FIELDS), "inputs")
    path = fresh_path(spark, "first")
    job = lambda requests: jobs.first_requests(requests, inputs, scoring.INPUT_FIELDS)
    jobs.run_upsert(job(jobs.request_stream(spark, folder)), path, jobs.REUSE_KEYS)
    stored = jobs.backfill(job(jobs.as_requests(jobs.event_batch(spark, folder))), path, jobs.REUSE_KEYS)
    return stored.select(
        F.substring(jobs.plain_time(F.col("reuse_start")).cast("string"), 1, 16).alias("reuse_start"),
        "customer_id",
        "request_id",
        "requests",
        F.round(scoring.formula_probability(), 4).alias("churn_probability"),
    )


@query
def stream_serving_metrics(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "minutes")
    jobs.run_upsert(jobs.minute_metrics(jobs.request_stream(spark, folder)), path, ["minute_start"])
    late = jobs.minute_metrics(jobs.as_requests(jobs.event_batch(spark, folder)))
    stored = jobs.backfill(late, path, ["minute_start"])
    n = F.col("requests").cast("double")
    return stored.select(
        F.substring(jobs.plain_time(F.col("minute_start")).cast("string"), 1, 16).alias("minute"),
        "requests",
        F.round(F.col("hits") / n, 4).alias("cache_hit_rate"),
        F.round(F.col("errors") / n, 4).alias("error_rate"),
        F.round(F.col("response_ms").cast("double") / n, 6).alias("avg_response_time_ms"),
    )
