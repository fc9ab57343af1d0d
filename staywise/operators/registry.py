"""Run metrics and model registry as append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def registry_rows(validated: DataFrame, deployed_on: str, samples: str = "n") -> DataFrame:
    """One registry record per candidate model."""
    return validated.select(
        F.concat(F.lit("v_"), F.col("model"), F.lit("_"), F.lit(deployed_on.replace("-", ""))).alias("model_version"),
        F.lit(deployed_on).alias("deployment_date"),
        F.col("accuracy").alias("baseline_accuracy"),
        F.col("model").alias("model_type"),
        F.col(samples).alias("training_samples"),
        F.col("validation_passed").alias("promoted"),
    )


_NEWEST = ("deployment_date", "baseline_accuracy", "model_version")


def current_version(registry: DataFrame) -> DataFrame:
    """The promoted version of the latest date; the higher accuracy, then the version name, decide ties."""
    return registry.filter("promoted").agg(F.max_by("model_version", F.struct(*_NEWEST)).alias("current_version"))


def with_current(registry: DataFrame) -> DataFrame:
    """Registry with a flag on the version in use."""
    current = current_version(registry).withColumn("is_current", F.lit(True))  # one row
    joined = registry.join(F.broadcast(current), registry["model_version"] == current["current_version"], "left")
    return joined.drop("current_version").withColumn("is_current", F.coalesce("is_current", F.lit(False)))


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
