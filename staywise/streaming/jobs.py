"""Structured Streaming jobs: daily engagement partials, request deduplication, scoring, serving counters.

State is kept per window and key and bounded by the watermark. Rows later than the watermark are dropped from the
stream; ``backfill`` with a batch run over the same table puts them in. Hot keys are combined on the map side before
they reach the state store; the size of a micro-batch is set with ``maxFilesPerTrigger`` on the source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise import config
from staywise.functions import rules
from staywise.operators import scoring
from staywise.operators.engagement import engagement_windows
from staywise.operators.feature_store import newest
from staywise.schemas import RAW_EVENTS
from staywise.session import written
from staywise.sources.adapters import engagement_columns, table
from staywise.sources.readers import stream_typed

LATENESS = "3 days"
REUSE = "1 hour"


def instant(column: Column) -> Column:
    """Time-zone free timestamp as an instant (read as UTC), whatever the session time zone is."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), column)
    return F.timestamp_micros(micros)


def plain_time(column: Column) -> Column:
    """The inverse of ``instant``."""
    return F.timestamp_add("SECOND", F.unix_seconds(column), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def event_stream(spark: SparkSession, folder: str, files: str = "events.parque[t]", **options: str) -> DataFrame:
    """Engagement events as a stream, with their instant as ``at``.

    The stream source takes no plain file; a pattern that matches the table's name reads one file and a folder of files alike.
    """
    raw = stream_typed(spark, f"{folder}/{files}", RAW_EVENTS, **options)
    return engagement_columns(raw).withColumn("at", instant(F.col("ts")))


def event_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as a batch."""
    return engagement_columns(table(spark, folder, "events")).withColumn("at", instant(F.col("ts")))


def request_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """Events seen as scoring requests, the streaming twin of the request log."""
    return as_requests(event_stream(spark, folder, **options))


def as_requests(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("request_id"),
        "customer_id",
        "ts",
        "at",
        F.col("value").alias("response_ms"),
        (F.coalesce(F.col("k"), F.lit(1)) % 3 == 0).alias("cache_hit"),
        F.col("event_type").isin("support_ticket", "support_resolution").alias("error"),
    )


DAILY_KEYS = ("customer_id", "day_start", "event_type", "feature_name", "content_id")


def daily_engagement(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Partials per customer, day, event type and member (feature or content item).

    The 7, 30 and 90-day features, distinct counts included, can be derived from these alone, so the stream needs no
    state older than the watermark.
    """
    keys = ("customer_id", F.window("at", "1 day").alias("span"), "event_type", "feature_name", "content_id")
    return (
        events.withWatermark("at", lateness)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("events"),
            F.sum(F.coalesce("duration_minutes", F.lit(0))).alias("minutes"),
        )
        .select("customer_id", F.col("span.start").alias("day_start"), *DAILY_KEYS[2:], "events", "minutes")
    )


def features_from_daily(
    daily: DataFrame, as_of: date, windows: Sequence[int] = config.ENGAGEMENT_WINDOWS
) -> DataFrame:
    """Windowed engagement features from the daily partials, equal to those from the raw events."""
    rows = daily.select(
        "customer_id",
        plain_time(F.col("day_start")).cast("date").alias("event_date"),
        *DAILY_KEYS[2:],
        F.col("minutes").alias("duration_minutes"),
        "events",
    )
    return engagement_windows(rows, as_of, windows, weight="events")


def minute_metrics(log: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Serving counters per minute."""
    return (
        log.withWatermark("at", lateness)
        .groupBy(F.window("at", "1 minute").alias("span"))
        .agg(
            F.count("*").alias("requests"),
            F.count_if("cache_hit").alias("hits"),
            F.count_if("error").alias("errors"),
            F.sum(F.col("response_ms").cast("decimal(18,6)")).alias("response_ms"),
        )
        .select(F.col("span.start").alias("minute_start"), "requests", "hits", "errors", "response_ms")
    )


def scored_stream(
    requests: DataFrame, inputs: DataFrame, score: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Requests joined with the stored scoring inputs and scored; ``score`` may apply a fitted model."""
    joined = requests.select("request_id", "customer_id", "at").join(inputs, "customer_id")
    if score is not None:
        return score(joined)
    p = F.col("probability")
    return joined.withColumn("probability", scoring.formula_probability()).select(
        "request_id", "customer_id", F.round(p, 4).alias("churn_probability"), rules.risk_level(p).alias("risk_level")
    )


REUSE_KEYS = ("reuse_start", "fingerprint")


def first_requests(
    requests: DataFrame, inputs: DataFrame, fields: Sequence[str], reuse: str = REUSE, lateness: str = LATENESS
) -> DataFrame:
    """The earliest request per distinct record and reuse period, with the number of requests it serves.

    Periods are fixed (whole hours by default) and a result is reused up to the end of its period only, so the outcome
    does not depend on micro-batches. Requests for a hot record are reduced in each map task.
    """
    return (
        requests.select("request_id", "customer_id", "at")
        .join(inputs, "customer_id")
        .withColumn("fingerprint", scoring.fingerprint(fields))
        .withWatermark("at", lateness)
        .groupBy(F.window("at", reuse).alias("span"), "fingerprint")
        .agg(
            F.min_by(F.struct("request_id", *fields), F.struct("at", "request_id")).alias("earliest"),
            F.count("*").alias("requests"),
        )
        .select(F.col("span.start").alias("reuse_start"), "fingerprint", "earliest.*", "requests")
    )


def run_append(stream: DataFrame, path: str) -> DataFrame:
    """Process everything available into a Parquet folder and return that folder as a table.

    Called again with the same path it continues where it stopped.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}-state")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_upsert(stream: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Process everything available in update mode and return the newest row per key; no input gives an empty table.

    Each micro-batch overwrites its own ``batch_id`` folder, so a repeated batch leaves no duplicates; readers take
    the row of the highest batch. Called again with the same path it continues where it stopped.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    stream.sparkSession.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{path}/batch_id=-1")
    query = (
        stream.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", f"{path}-state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _newest_stored(_stored(stream, path), keys)


def backfill(batch: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Put what a batch run of the same job found into the table that ``run_upsert`` keeps; return the newest row per key.

    Rows behind the watermark are in the batch only. Rows that differ from the stored ones are added to the newest
    ``batch_id`` and go before it. A later micro-batch goes before them in turn: it holds only periods that are still open,
    of which the stream dropped nothing. Run it while the stream is stopped.
    """
    stored = _stored(batch, path)
    current = _newest_stored(stored, keys)
    changed = written(batch.select(*current.columns).subtract(current), "backfill")
    last = stored.agg(F.max("batch_id")).first()[0]
    target = f"{path}/batch_id={-1 if last is None else last}"
    changed.withColumn("backfilled", F.lit(True)).write.mode("append").parquet(target)
    return _newest_stored(_stored(batch, path), keys)


def _stored(like: DataFrame, path: str) -> DataFrame:
    columns = ", ".join(f"{name} {kind}" for name, kind in like.dtypes)
    return like.sparkSession.read.schema(f"{columns}, backfilled BOOLEAN, batch_id BIGINT").parquet(path)


def _newest_stored(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of one batch a backfilled row goes first: NULL sorts last."""
    return newest(stored, keys, "batch_id", "backfilled").drop("batch_id", "backfilled")
