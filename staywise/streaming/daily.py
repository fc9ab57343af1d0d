"""Daily engagement partials kept by a stream, with late rows set aside and their days recomputed.

Layout below one folder, everything idempotent per micro-batch (a repeated batch overwrites its own files):

* ``partials/batch_id=N/day=D``: what batch N adds to day D, reduced in the map tasks. Several batches' partials of a day add up, so no state is held.
* ``late/day=D/batch_id=N``: rows whose day had closed before batch N began. A day closes when an event ``lateness`` after its end has been seen.
* ``progress/batch_id=N``: the newest event time up to batch N, how many rows were on time and late.
* ``days/day=D/upto=N``: a late day recomputed from the event table after batch N; it stands for the day's partials from then on.

``table`` reads a day from its newest recomputation, other days from their partials. ``backfill`` recomputes the days that have rows in ``late``
newer than their recomputation, and no others; each such day replaces its own partition.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATENESS = timedelta(days=3)
KEYS = ("customer_id", "event_type", "feature_name", "content_id")
PARTIALS = "customer_id string, event_type string, feature_name string, content_id int, events bigint, minutes decimal(38,2), batch_id bigint, day string"
LATE = "event_id bigint, customer_id string, at timestamp, day string, batch_id bigint"
PROGRESS = "newest timestamp, on_time bigint, late bigint, batch_id bigint"
DAYS = "customer_id string, event_type string, feature_name string, content_id int, events bigint, minutes decimal(38,2), day string, upto bigint"


def _read(spark: SparkSession, path: str, schema: str, *partitions: str) -> DataFrame:
    """A stored part; before the first batch it is empty."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partitions).parquet(path)
    return spark.read.schema(schema).parquet(path)


def _day():
    return F.date_format("at", "yyyy-MM-dd").alias("day")


def partials(events: DataFrame) -> DataFrame:
    """Counts and minutes per day, customer, event type and member, from events with their instant ``at``."""
    minutes = F.sum(F.coalesce("duration_minutes", F.lit(0))).cast("decimal(38,2)")
    return events.groupBy(_day(), *KEYS).agg(F.count("*").alias("events"), minutes.alias("minutes"))


def _store(path: str, lateness: timedelta):
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _read(spark, f"{path}/progress", PROGRESS, "batch_id").where(F.col("batch_id") < batch_id)
        newest = seen.agg(F.max("newest")).first()[0]  # one row a batch
        # The day of an event is closed once something that lies ``lateness`` after the day's end was seen in an earlier batch.
        closed = F.lit(False)
        if newest is not None:
            closed = F.date_trunc("day", "at") + F.expr("INTERVAL 1 DAY") <= F.lit(newest - lateness)
        rows = batch.where("at is not null").withColumn("_late", closed)
        fresh = partials(rows.where(~F.col("_late"))).withColumn("batch_id", F.lit(batch_id))
        _replace(fresh, f"{path}/partials", PARTIALS, "batch_id", "day")
        late = rows.where("_late").select("event_id", "customer_id", "at", _day(), F.lit(batch_id).alias("batch_id"))
        _replace(late, f"{path}/late", LATE, "day", "batch_id")
        counts = rows.agg(F.max("at").alias("newest"), F.count_if(~F.col("_late")).alias("on_time"), F.count_if("_late").alias("late"))
        _replace(counts.withColumn("batch_id", F.lit(batch_id)), f"{path}/progress", PROGRESS, "batch_id")

    return store


def _replace(rows: DataFrame, path: str, schema: str, *partitions: str) -> None:
    """Put rows into their partitions, replacing those they fall into (the same batch's, if it is repeated)."""
    names = [part.split()[0] for part in schema.split(", ")]
    placed = rows.select(*names).hint("rebalance", *partitions)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def run(events: DataFrame, path: str, lateness: timedelta = LATENESS) -> None:
    """Take in everything that is there of a stream of events (with ``at``). Called again with the same path it goes on where it stopped."""
    query = (
        events.writeStream.foreachBatch(_store(path, lateness))
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def late_days(spark: SparkSession, path: str) -> list[str]:
    """Days with late rows that no recomputation has seen yet; their number is bounded by the days of the table."""
    late = _read(spark, f"{path}/late", LATE, "day", "batch_id").groupBy("day").agg(F.max("batch_id").alias("newest"))
    done = _read(spark, f"{path}/days", DAYS, "day", "upto").groupBy("day").agg(F.max("upto").alias("upto"))
    open_days = late.join(done, "day", "left").where("upto is null or upto < newest")
    return sorted(r["day"] for r in open_days.select("day").collect())


def backfill(events: DataFrame, path: str) -> list[str]:
    """Recompute the late days, and only those, from the event table (with ``at``); returns them. Run it while the stream is stopped."""
    spark = events.sparkSession
    days = late_days(spark, path)
    if not days:
        return days
    upto = _read(spark, f"{path}/progress", PROGRESS, "batch_id").agg(F.max("batch_id")).first()[0]
    # A range on the stored time reaches the scan; the list of days then picks.
    first, last = F.lit(days[0]).cast("timestamp"), F.lit(days[-1]).cast("timestamp") + F.expr("INTERVAL 1 DAY")
    rows = events.where((F.col("at") >= first) & (F.col("at") < last)).where(_day().isin(days))
    again = partials(rows).withColumn("upto", F.lit(upto).cast("bigint"))
    _replace(again, f"{path}/days", DAYS, "day", "upto")
    return days


def table(spark: SparkSession, path: str) -> DataFrame:
    """(day, customer_id, event_type, feature_name, content_id, events, minutes): one row per key."""
    done = _read(spark, f"{path}/days", DAYS, "day", "upto")
    latest = done.groupBy("day").agg(F.max("upto").alias("upto"))  # one row a recomputed day
    recomputed = done.join(F.broadcast(latest), ["day", "upto"]).select("day", *KEYS, "events", "minutes")
    kept = _read(spark, f"{path}/partials", PARTIALS, "batch_id", "day").join(F.broadcast(latest.select("day")), "day", "left_anti")
    added = kept.groupBy("day", *KEYS).agg(F.sum("events").alias("events"), F.sum("minutes").cast("decimal(38,2)").alias("minutes"))
    return recomputed.unionByName(added)
