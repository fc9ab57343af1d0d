"""Serving totals and the newest requests as one small state, carried from batch to batch.

The state is one row: totals, and the newest N requests as an array of fixed size. States add up: the newest N of a union are among the newest N of
its parts. So the figures need no scan of the log, and how the log is cut into batches makes no difference. Each batch writes its own state
folder from the one before; a repeated batch writes the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise import config

STATE = (
    "requests bigint, hits bigint, errors bigint, last_at timestamp,"
    " newest array<struct<at: timestamp, request_id: bigint, response_ms: double>>, batch_id bigint"
)


def _totals(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("requests"), F.count_if("cache_hit").alias("hits"), F.count_if("error").alias("errors"), F.max("at").alias("last_at")
    )


def advanced(state: DataFrame, batch: DataFrame, buffer: int = config.LATENCY_BUFFER) -> DataFrame:
    """The state after one more batch of requests (request_id, at, response_ms, cache_hit, error); ``state`` has one row or none."""
    fields = ("at", "request_id", "response_ms")
    order = (F.desc("at"), F.desc("request_id"))
    # Each task keeps its newest rows only; the state's own rows are N at most.
    held = state.select(F.inline("newest"))
    newest = batch.select(*fields).orderBy(*order).limit(buffer).unionByName(held).orderBy(*order).limit(buffer)
    newest = newest.agg(F.collect_list(F.struct(*fields)).alias("newest"))
    sums = _totals(batch).unionByName(state.select("requests", "hits", "errors", "last_at")).agg(
        *[F.sum(c).alias(c) for c in ("requests", "hits", "errors")], F.max("last_at").alias("last_at")
    )
    both = sums.unionByName(newest, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("requests", "hits", "errors", "last_at")], F.max("newest").alias("newest"))


def _state(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    spark.createDataFrame([], STATE).write.mode("ignore").partitionBy("batch_id").parquet(path)
    rows = spark.read.schema(STATE).parquet(path)
    if below is not None:
        rows = rows.where(F.col("batch_id") < below)
    return rows.orderBy(F.desc("batch_id")).limit(1)


def run(log: DataFrame, path: str, buffer: int = config.LATENCY_BUFFER) -> DataFrame:
    """Take in everything that is there of a stream of requests; returns the state. Called again with the same path it goes on."""

    def store(batch: DataFrame, batch_id: int) -> None:
        after = advanced(_state(batch.sparkSession, f"{path}/states", batch_id), batch, buffer)
        after.coalesce(1).write.mode("overwrite").parquet(f"{path}/states/batch_id={batch_id}")

    query = log.writeStream.foreachBatch(store).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return _state(log.sparkSession, f"{path}/states")


def figures(state: DataFrame) -> DataFrame:
    """Totals, rates and the mean latency of the newest requests, one row."""
    known = state.agg(*[F.max(c).alias(c) for c in ("requests", "hits", "errors", "last_at", "newest")])
    n = F.coalesce("requests", F.lit(0))
    requests = F.greatest(n, F.lit(1)).cast("double")
    total = F.aggregate(F.coalesce("newest.response_ms", F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    counted = F.size(F.filter(F.coalesce("newest.response_ms", F.array().cast("array<double>")), lambda x: x.isNotNull()))
    return known.select(
        n.alias("total_predictions"),
        F.round(F.coalesce(F.try_divide(total, counted), F.lit(0.0)), 2).alias("avg_response_time_ms"),
        F.round(F.coalesce("hits", F.lit(0)) / requests, 4).alias("cache_hit_rate"),
        F.round(F.coalesce("errors", F.lit(0)) / requests, 4).alias("error_rate"),
        F.col("last_at").alias("last_prediction"),
    )
