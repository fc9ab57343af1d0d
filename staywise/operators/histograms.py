"""Stored value counts of features by day, from which drift is measured without building the features again.

A day's counts are exact, one row per feature and value (NULL included), so two days can be compared by any statistic of their distributions, and
counts of disjoint groups of customers add up. A day is one partition; storing it again replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.operators.drift import stacked_features, value_counts


@dataclass(frozen=True)
class HistogramStore:
    path: str

    SCHEMA = "feature string, value double, n bigint, day string"

    def _stored(self, spark: SparkSession) -> DataFrame:
        spark.createDataFrame([], self.SCHEMA).write.mode("ignore").partitionBy("day").parquet(self.path)
        return spark.read.schema(self.SCHEMA).parquet(self.path)

    def days(self, spark: SparkSession) -> set[str]:
        """Stored days; only folder names are looked at, and there are no more than days."""
        return {r["day"] for r in self._stored(spark).select("day").distinct().collect()}

    def put(self, features: DataFrame, names: Sequence[str], day: date) -> None:
        counts = value_counts(stacked_features({day.isoformat(): features}, names))
        self._stored(features.sparkSession)
        rows = counts.select("feature", "value", "n", F.col("side").alias("day"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path)

    def compared(self, spark: SparkSession, sides: dict[str, date]) -> DataFrame:
        """(side, feature, value, n) of some days, each under the name of its side."""
        names = F.create_map(*[F.lit(x) for side, day in sides.items() for x in (day.isoformat(), side)])
        rows = self._stored(spark).filter(F.col("day").isin([d.isoformat() for d in sides.values()]))
        return rows.select(names[F.col("day")].alias("side"), "feature", "value", "n")
