"""A log of predictions by day, and their accuracy once the outcome is known.

A prediction says something about the days after it. It is judged only when those days have passed; predictions whose outcome window is still
open are left out, not counted as right or wrong.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "customer_id string, prediction int, probability double, model_version string, day string"


def append(predictions: DataFrame, path: str) -> None:
    """Add predictions (customer_id, prediction, probability, model_version, day as text) to the log."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    predictions.select(*names).write.mode("append").partitionBy("day").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def accuracy(log: DataFrame, outcomes: DataFrame, as_of: date, window: int, recent: int = 7) -> DataFrame:
    """(scope, day, model_version, predictions, accuracy): one row per closed day and model, and one per model over the newest ``recent`` closed days.

    ``outcomes``: (customer_id, label). A day is closed when ``window`` days after it have passed by ``as_of``; other days' folders are not read.
    """
    last = as_of - timedelta(days=window)
    closed = log.filter(F.col("day") <= F.lit(last.isoformat()))
    right = F.count_if(F.col("label") == F.col("prediction"))
    per_day = closed.join(outcomes.select("customer_id", "label"), "customer_id").groupBy("day", "model_version").agg(
        F.count("*").alias("predictions"), right.alias("right")
    )
    since = (last - timedelta(days=recent - 1)).isoformat()
    newest = per_day.filter(F.col("day") >= F.lit(since)).groupBy("model_version").agg(
        F.sum("predictions").alias("predictions"), F.sum("right").alias("right")
    )
    rows = per_day.withColumn("scope", F.lit("day")).unionByName(
        newest.select(F.lit(last.isoformat()).alias("day"), "model_version", "predictions", "right", F.lit(f"last {recent} days").alias("scope"))
    )
    return rows.select(
        "scope", "day", "model_version", "predictions", (F.col("right").cast("double") / F.col("predictions")).alias("accuracy")
    )
