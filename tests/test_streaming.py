"""Streams over several micro-batches give what a batch over the same files gives."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from staywise.operators import scoring
from staywise.operators.engagement import engagement_windows
from staywise.sources import adapters
from staywise.streaming import jobs

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def write_files(spark, path, batches):
    """One file per batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def event(i, minutes, user=1, kind="click", value=10.0):
    return (i, START + timedelta(minutes=minutes), user, kind, value, '{"k": %d}' % (i % 100))


@pytest.fixture()
def out(tmp_path):
    return str(tmp_path / "out")


@pytest.fixture()
def folder_of(spark, tmp_path):
    def make(batches):
        path = str(tmp_path / "events")
        write_files(spark, path, batches)
        return path

    return make


def test_daily_engagement_over_many_batches_equals_batch(spark, folder_of, out):
    batches = [
        [event(b * 40 + i, b * 300 + i * 7, user=i % 4, kind=["click", "view", "error"][i % 3]) for i in range(40)]
        for b in range(5)
    ]
    path = folder_of(batches[:3])

    def run():
        stream = jobs.event_stream(spark, path, files="*.parquet", maxFilesPerTrigger="1")
        return jobs.run_upsert(jobs.daily_engagement(stream), out, jobs.DAILY_KEYS)

    run()
    write_files(spark, path, batches[3:])
    daily = run()  # continues with the new files only
    raw = adapters.engagement_columns(spark.read.schema(SCHEMA).parquet(path))
    keys = ["customer_id", "day", "event_type"]
    plain = (
        raw.groupBy("customer_id", F.col("ts").cast("date").alias("day"), "event_type")
        .agg(F.count("*").alias("events"), F.sum(F.coalesce("duration_minutes", F.lit(0))).alias("minutes"))
        .select(*keys, "events", "minutes")
    )
    ours = (
        daily.withColumn("day", jobs.plain_time(F.col("day_start")).cast("date"))
        .groupBy(*keys)
        .agg(F.sum("events").alias("events"), F.sum("minutes").alias("minutes"))
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
    day = (START + timedelta(days=9)).date()
    from_raw = engagement_windows(raw.withColumn("event_date", F.col("ts").cast("date")), day)
    from_daily = jobs.features_from_daily(daily, day)
    assert sorted(map(tuple, from_daily.collect())) == sorted(map(tuple, from_raw.collect()))


def test_rows_behind_the_watermark_are_dropped(spark, folder_of, out):
    day = 24 * 60
    path = folder_of([[event(1, 0)], [event(2, 10 * day)], [event(3, 10 * day + 1)], [event(4, 1)]])
    stream = jobs.event_stream(spark, path, files="*.parquet", maxFilesPerTrigger="1")
    got = jobs.run_upsert(jobs.daily_engagement(stream), out, jobs.DAILY_KEYS)
    assert sorted(r.events for r in got.collect()) == [1, 2]
    raw = adapters.engagement_columns(spark.read.schema(SCHEMA).parquet(path)).withColumn("at", jobs.instant(F.col("ts")))
    plain = jobs.daily_engagement(raw)
    for _ in range(2):
        filled = jobs.backfill(plain, out, jobs.DAILY_KEYS)
        assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, plain.collect()))
    write_files(spark, path, [[event(5, 10 * day + 2)]])  # the stream goes on from its own state
    got = jobs.run_upsert(jobs.daily_engagement(stream), out, jobs.DAILY_KEYS)
    assert sorted(r.events for r in got.collect()) == [2, 3]


def test_a_stream_without_rows_gives_an_empty_table(spark, folder_of, out):
    path = folder_of([[]])
    stream = jobs.event_stream(spark, path, files="*.parquet")
    assert jobs.run_upsert(jobs.daily_engagement(stream), out, jobs.DAILY_KEYS).count() == 0


@pytest.mark.parametrize("files", (1, 4))
def test_reuse_does_not_depend_on_batches(spark, folder_of, out, files):
    rows = [event(i, i * 37 % 400, user=1 + i % 2) for i in range(60)]
    path = folder_of([rows[f::files] for f in range(files)])
    requests = jobs.request_stream(spark, path, files="*.parquet", maxFilesPerTrigger="1")
    got = jobs.run_upsert(jobs.first_requests(requests, inputs(spark), scoring.INPUT_FIELDS), out, jobs.REUSE_KEYS)
    expected = {}
    for i, at, user, *_ in rows:
        key = (user, at.replace(minute=0))
        expected[key] = min(expected.get(key, (at, i)), (at, i))
    assert sorted(r.request_id for r in got.collect()) == sorted(i for _, i in expected.values())
    assert got.agg(F.sum("requests")).first()[0] == 60


def inputs(spark):
    return spark.createDataFrame(
        [("C000000001", 5.0, 2.0, 10.0, 5.0, 0.5, 3, 0, 30, "premium"), ("C000000002", 90.0, 0.0, 0.0, 0.0, 0.0, 3, 0, 30, "premium")],
        "customer_id string, recency_30d double, frequency_30d double, monetary_total_30d double, monetary_avg_30d double,"
        " engagement_score double, customer_tenure_months int, support_tickets_30d int, age int, value_tier string",
    )


def test_scores_and_reuse(spark, folder_of, out):
    path = folder_of([[event(i, i, user=1 + i % 2) for i in range(10)] + [event(99, 3, user=77)]])
    requests = jobs.request_stream(spark, path, files="*.parquet")
    scored = jobs.run_append(jobs.scored_stream(requests, inputs(spark)), out)
    assert scored.count() == 10
    assert {r.risk_level for r in scored.filter("customer_id = 'C000000002'").collect()} == {"HIGH"}
    first = jobs.run_upsert(
        jobs.first_requests(requests, inputs(spark), scoring.INPUT_FIELDS), f"{out}-first", jobs.REUSE_KEYS
    )
    assert sorted(r.customer_id for r in first.collect()) == ["C000000001", "C000000002"]


def test_a_result_is_not_reused_long_after_it_expired(spark, folder_of, out):
    path = folder_of([[event(1, 0)], [event(2, 30)], [event(3, 300, user=2)], [event(4, 301, user=2)], [event(5, 600)]])
    requests = jobs.request_stream(spark, path, files="*.parquet", maxFilesPerTrigger="1")
    first = jobs.run_upsert(jobs.first_requests(requests, inputs(spark), scoring.INPUT_FIELDS), out, jobs.REUSE_KEYS)
    assert sorted(r.request_id for r in first.collect()) == [1, 3, 5]


def test_minute_counters(spark, folder_of, out):
    path = folder_of([[event(i, i / 4, kind="error" if i % 2 else "click", value=float(i)) for i in range(40)]])
    got = jobs.run_upsert(jobs.minute_metrics(jobs.request_stream(spark, path, files="*.parquet")), out, ["minute_start"])
    rows = got.orderBy("minute_start").collect()
    assert [r.requests for r in rows] == [4] * 10 and sum(r.errors for r in rows) == 20
    assert float(rows[0].response_ms) == 6.0
