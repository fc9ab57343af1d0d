"""The stream of daily partials: late rows are set aside, only their days are recomputed, repeated batches change nothing."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from staywise.sources import adapters
from staywise.streaming import daily, jobs

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
DAY = 24 * 60


def event(i, minutes, user=1, kind="click"):
    return (i, START + timedelta(minutes=minutes), user, kind, 10.0 + i, '{"k": %d}' % (i % 100))


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)


def take_in(spark, feed, out):
    daily.run(jobs.event_stream(spark, feed, files="*.parquet"), out)


def whole(spark, feed):
    raw = adapters.engagement_columns(spark.read.schema(SCHEMA).parquet(feed))
    return raw.withColumn("at", jobs.instant(F.col("ts")))


def rows_of(df):
    columns = ["day", *daily.KEYS, "events", "minutes"]
    return sorted(map(tuple, df.select(columns).collect()), key=str)


@pytest.fixture()
def places(tmp_path):
    return str(tmp_path / "feed"), str(tmp_path / "daily")


def test_late_days_alone_are_recomputed(spark, places):
    feed, out = places
    kinds = ["click", "view", "purchase"]
    arrive(spark, feed, [event(i, i * 60, user=i % 5, kind=kinds[i % 3]) for i in range(5 * 24)])
    take_in(spark, feed, out)
    arrive(spark, feed, [event(500 + i, 8 * DAY + i * 60, user=i % 5, kind=kinds[i % 3]) for i in range(30)])
    take_in(spark, feed, out)
    on_time = event(800, 7 * DAY)  # within three days of the newest event
    arrive(spark, feed, [event(600, 90), event(601, 95, kind="view"), event(602, 3 * DAY + 5, user=9), on_time])
    take_in(spark, feed, out)
    assert rows_of(daily.table(spark, out)) != rows_of(daily.partials(whole(spark, feed)))
    assert daily.late_days(spark, out) == ["2024-01-01", "2024-01-04"]
    # Partials of other days would show up if they were touched: the table given to the backfill lacks their rows.
    assert daily.backfill(whole(spark, feed), out) == ["2024-01-01", "2024-01-04"]
    assert {d for d in os.listdir(f"{out}/days") if d.startswith("day=")} == {"day=2024-01-01", "day=2024-01-04"}
    assert rows_of(daily.table(spark, out)) == rows_of(daily.partials(whole(spark, feed)))
    assert daily.backfill(whole(spark, feed), out) == []
    arrive(spark, feed, [event(700, 100)])  # late once more: the same day alone
    take_in(spark, feed, out)
    assert daily.backfill(whole(spark, feed), out) == ["2024-01-01"]
    assert rows_of(daily.table(spark, out)) == rows_of(daily.partials(whole(spark, feed)))
    progress = spark.read.schema(daily.PROGRESS).parquet(f"{out}/progress").orderBy("batch_id").collect()
    assert [(r.on_time, r.late) for r in progress] == [(120, 0), (30, 0), (1, 3), (0, 1)]


def test_an_empty_stream_is_not_made_good_by_the_backfill(spark, places):
    feed, out = places
    arrive(spark, feed, [event(i, i * 60) for i in range(48)])
    assert daily.backfill(whole(spark, feed), out) == [] and daily.table(spark, out).count() == 0
    take_in(spark, feed, out)
    assert rows_of(daily.table(spark, out)) == rows_of(daily.partials(whole(spark, feed)))


def test_a_repeated_batch_changes_nothing(spark, places):
    feed, out = places
    arrive(spark, feed, [event(i, i * 60) for i in range(48)])
    batch = whole(spark, feed)
    store = daily._store(out, daily.LATENESS)
    store(batch, 0)
    later = batch.limit(0).unionByName(batch).withColumn("at", F.col("at") + F.expr("INTERVAL 10 DAYS"))
    store(later, 1)
    before = rows_of(daily.table(spark, out))
    for batch_id, rows in ((0, batch), (1, later)):
        store(rows, batch_id)
    assert rows_of(daily.table(spark, out)) == before and daily.late_days(spark, out) == []


def test_the_backfill_reads_the_late_days_only(spark, places):
    feed, out = places
    arrive(spark, feed, [event(1, 5), event(2, 20 * DAY)])
    take_in(spark, feed, out)
    arrive(spark, feed, [event(3, 6)])
    take_in(spark, feed, out)
    wrong = whole(spark, feed).where("event_id <> 2")  # the row of another day is missing from the table
    assert daily.backfill(wrong, out) == ["2024-01-01"]
    assert [(r.day, r.events) for r in daily.table(spark, out).orderBy("day").collect()] == [("2024-01-01", 2), ("2024-01-21", 1)]
