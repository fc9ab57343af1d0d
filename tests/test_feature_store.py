"""Key checks, merge writes, lookups and point-in-time lookups."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.operators import feature_store as fs
from staywise.operators.rfm import transaction_windows
from staywise.plans import features as plans
from staywise.sources import readers, sinks

START = date(2024, 1, 1)


def test_merge_keeps_newest_and_prefers_updates(spark):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old"), ("c", 2, "old")], "id string, v int, x string")
    new = spark.createDataFrame([("a", 2, "new"), ("b", 4, "new"), ("c", 2, "new"), ("d", 1, "new")], "id string, v int, x string")
    got = {r.id: (r.v, r.x) for r in fs.merged(old, new, ["id"], "v").collect()}
    assert got == {"a": (2, "new"), "b": (5, "old"), "c": (2, "new"), "d": (1, "new")}


def test_merge_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("id"), F.col("id").alias("v"))
    plan = fs.merged(df, df, ["id"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_table_create_merge_and_conform(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType()), T.StructField("x", T.DoubleType())])
    table = fs.FeatureTable("behavior", ("id",), schema, "behaviour features")
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    table.create(spark, first)
    rows = table.conform(spark.createDataFrame([(1.5, "k", 3)], "x double, id string, v int"))
    fs.merge_write(rows, first, second, table.primary_keys, "v")
    assert [tuple(r) for r in spark.read.parquet(second).select("id", "v", "x").collect()] == [("k", 3, 1.5)]


def test_key_report(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "id string")
    got = {r.table_name: r for r in fs.key_report({"a": (a, ["id"]), "b": (a.distinct(), ["id"]), "e": (a.limit(0), ["id"])}).collect()}
    assert (got["a"].rows, got["a"].duplicate_keys, got["a"].is_unique) == (3, 1, False)
    assert got["b"].is_unique and (got["e"].rows, got["e"].is_unique) == (0, True)
    assert [r.id for r in fs.duplicate_keys(a, ["id"]).collect()] == ["x"]


def test_lookup_by_list_table_and_all(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "id string, a int")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "id string, b int")
    wanted = spark.createDataFrame([("y",), ("y",), ("q",)], "id string")
    assert fs.looked_up([a, b], "id").count() == 2
    assert [tuple(r) for r in fs.looked_up([a, b], "id", ["x", "z"]).collect()] == [("x", 1, 1)]
    assert [tuple(r) for r in fs.looked_up([a, b], "id", wanted).collect()] == [("y", 2, 2)]


def test_as_of_lookup_equals_brute_force(spark):
    rng = random.Random(2)
    keys = ["hot"] * 5 + [f"k{i}" for i in range(10)]
    requests = [(i, rng.choice(keys), START + timedelta(days=rng.randrange(60))) for i in range(600)]
    versions = {(rng.choice(keys), START + timedelta(days=rng.randrange(60))): rng.randrange(99) for _ in range(200)}
    got = fs.as_of_lookup(
        spark.createDataFrame(requests, "request_id int, k string, day date"),
        spark.createDataFrame([(k, d, v) for (k, d), v in versions.items()], "k string, version date, v int"),
        "k", "day", "version", ["v"],
    ).collect()
    assert len(got) == len(requests)
    for r in got:
        known = [d for (k, d) in versions if k == r.k and d <= r.day]
        assert r.version == (max(known) if known else None)
        assert r.v == (versions[(r.k, max(known))] if known else None)


def test_prepared_partitions_are_overwritten_one_by_one(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_partition(spark.range(3), path, "ds", "2024-01-01")
    sinks.write_partition(spark.range(5), path, "ds", "2024-01-02")
    sinks.write_partition(spark.range(1), path, "ds", "2024-01-01")
    got = {str(r.ds): r["count"] for r in spark.read.parquet(path).groupBy("ds").count().collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 5}


def test_log_is_appended_by_day_and_read_by_day(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.range(48).select("id", (F.lit(START).cast("timestamp") + F.make_dt_interval(hours="id")).alias("ts"))
    sinks.append_log(log, path)
    sinks.append_log(log.limit(1), path)
    recent = spark.read.schema("id long, ts timestamp, day string").parquet(path).filter("day >= '2024-01-02'")
    assert recent.count() == 24
    assert "PartitionFilters: [isnotnull(day" in recent._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    base = spark.range(500).select(F.col("id").cast("string").alias("customer_id"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_a", "bucketed_b"):
            location = str(tmp_path / name)
            sinks.save_bucketed(base, name, ["customer_id"], 4, location)
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "customer_id")
        assert joined.count() == 500
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_recent_labelled_filter_reaches_the_scan(spark, tmp_path):
    schema = (
        "customer_id string, recency_30d double, frequency_30d double, monetary_total_30d double,"
        " engagement_score double, customer_tenure_months int, support_tickets_30d int, churned int, created_at date"
    )
    day = date(2024, 1, 31)
    rows = [("a", 1.0, 1.0, 1.0, 0.5, 1, 0, c, day - timedelta(days=a)) for a, c in ((0, 1), (30, 0), (31, 1), (3, None))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "f"))
    df = fs.recent_labelled(spark.read.parquet(str(tmp_path / "f")), day)
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at,2024-01-01)" in plan and "IsNotNull(churned)" in plan


SAMPLE = [
    ("buyer", "Ada", 51, "metro", "2021-11-02", "premium", 12),
    ("visitor", "Ben", 19, "suburban", "2023-03-08", "basic", 6),
    ("silent", "Cleo", 67, "rural", "31/31/2020", "enterprise", 18),
]
NAMES = ["customer_id", "customer_name", "age", "city_type", "signup_date", "subscription_tier", "customer_tenure_months"]


def test_complete_feature_table_from_literal_rows(spark):
    customers = readers.with_parsed_date(readers.from_rows(spark, SAMPLE, NAMES), "signup_date")
    tx = spark.createDataFrame([("buyer", date(2024, 1, 30), 80.0, "a")], "customer_id string, transaction_date date, transaction_amount double, product_category string")
    ev = spark.createDataFrame([("visitor", date(2024, 1, 30), "login", None, None, None)], "customer_id string, event_date date, event_type string, feature_name string, duration_minutes double, content_id int")
    rows = {r.customer_id: r for r in plans.feature_table(customers, tx, ev, date(2024, 1, 31)).collect()}
    assert len(rows) == 3 and rows["buyer"].feature_creation_timestamp is not None
    assert rows["silent"].signup_date is None and rows["silent"].customer_lifecycle_stage == "veteran"
    assert rows["silent"].monetary_total_365d == 0.0 and rows["visitor"].frequency_30d == 0
    assert rows["buyer"].churn_risk_score == pytest.approx(0.25 + 0.2 + 0.15)
    assert {r.recency_score for r in rows.values()} == {3, 4, 5}


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_typed_readers(spark, tmp_path, fmt):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    path = str(tmp_path / fmt)
    writer = spark.createDataFrame([("x", 1), ("y", 2)], schema).write.format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)
    assert readers.read_typed(spark, path, schema, fmt).agg(F.sum("n")).first()[0] == 3
    stream = readers.stream_typed(spark, path, schema, fmt)
    assert stream.isStreaming and stream.schema == schema


def test_canonical_inputs_round_trip(spark, tmp_path):
    path = str(tmp_path / "tx")
    spark.createDataFrame([("a", START, None, "x")], readers.INPUTS["transactions"]).write.parquet(path)
    df = readers.read_input(spark, "transactions", path)
    assert df.count() == 1 and df.dtypes == readers.read_input(spark, "transactions", path, streaming=True).dtypes


def test_stored_tables_hold_their_features(spark, tmp_path):
    day = date(2024, 1, 31)
    tx = spark.createDataFrame([("a", day, 5.0, "x")], "customer_id string, transaction_date date, transaction_amount double, product_category string")
    rows = transaction_windows(tx, day, (30,)).withColumn("version_date", F.lit(day))
    table = fs.TABLES["transactions"]
    assert set(fs.TABLES) == {"demographics", "behavior", "transactions"}
    first, second = str(tmp_path / "1"), str(tmp_path / "2")
    table.create(spark, first)
    fs.merge_write(table.conform(rows), first, second, table.primary_keys, "version_date")
    got = spark.read.parquet(second).first()
    assert (got.frequency_30d, got.monetary_total_30d, got.purchase_frequency_30d) == (1, 5.0, 1 / 30)
