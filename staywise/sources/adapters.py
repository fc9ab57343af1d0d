"""Adapters from the raw star-schema tables to the canonical inputs.

Date ranges are turned into plain comparisons on the stored timestamp, so that they reach the Parquet scan.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2024, 1, 31)
ORDER_SHIFT_DAYS = 8218
EVENT_SHIFT_STEPS = 4
EVENT_SHIFT_DAYS = 30
SIGNUP_START = date(2020, 1, 1)
SIGNUP_SPAN = 1480


# Columns read from each raw table. A stated schema spares the footer pass that would find it out.
RAW_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_extendedprice DOUBLE",
    "part": "p_partkey BIGINT, p_type STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def customer_key(number: Column) -> Column:
    text = number.cast("string")
    return F.concat(F.lit("C"), F.when(F.length(text) < 9, F.lpad(text, 9, "0")).otherwise(text))


def _ntz(day: date) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{day.isoformat()} 00:00:00'")


def customers(spark: SparkSession, folder: str, as_of: date = AS_OF) -> DataFrame:
    key = F.col("c_custkey")
    signup = F.date_add(F.lit(SIGNUP_START), (key * 13 % SIGNUP_SPAN).cast("int"))
    return table(spark, folder, "customer").select(
        customer_key(key).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(key % 50 != 0, 18 + key * 7 % 62).cast("int").alias("age"),
        F.element_at(
            F.array(F.lit("metro"), F.lit("suburban"), F.lit("rural")), (F.col("c_nationkey") % 3 + 1).cast("int")
        ).alias("city_type"),
        signup.alias("signup_date"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "premium")
        .when(F.col("c_mktsegment") == "MACHINERY", "enterprise")
        .otherwise("basic")
        .alias("subscription_tier"),
        F.floor(F.datediff(F.lit(as_of), signup) / 30).cast("int").alias("customer_tenure_months"),
    )


def transactions(
    spark: SparkSession, folder: str, since: date | None = None, until: date | None = None, category: bool = True
) -> DataFrame:
    """Order lines as transactions, optionally restricted to ``since <= transaction_date <= until``.

    Without ``category`` the parts are not read, which saves a shuffle of all lines.
    """
    orders = table(spark, folder, "orders")
    shift = timedelta(days=ORDER_SHIFT_DAYS)
    if since is not None:
        orders = orders.filter(F.col("o_orderdate") >= _ntz(since - shift))
    if until is not None:
        orders = orders.filter(F.col("o_orderdate") < _ntz(until - shift + timedelta(days=1)))
    bought = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    columns = [
        customer_key(F.col("o_custkey")).alias("customer_id"),
        F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT_DAYS).alias("transaction_date"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(16,4)")
        .alias("transaction_amount"),
    ]
    if not category:
        return bought.select(*columns)
    parts = table(spark, folder, "part")
    return bought.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        *columns, F.col("p_type").alias("product_category")
    )


def engagement_columns(raw: DataFrame) -> DataFrame:
    """Raw events, batch or streaming, in the shape of the engagement log (event id and time kept)."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    raw = raw.withColumn("k", k)
    even = F.col("k") % 2 == 0
    kind = (
        F.when(F.col("event_type") == "click", "login")
        .when(F.col("event_type") == "view", "content_view")
        .when(F.col("event_type") == "purchase", "feature_usage")
        .when((F.col("event_type") == "error") & even, "support_ticket")
        .when(F.col("event_type") == "error", "support_resolution")
        .when((F.col("event_type") == "signup") & even, "forum_post")
        .when(F.col("event_type") == "signup", "review_submission")
    )
    shift = (F.col("event_id") % EVENT_SHIFT_STEPS * EVENT_SHIFT_DAYS).cast("int")
    return raw.select(
        "event_id",
        "ts",
        customer_key(F.col("user_id")).alias("customer_id"),
        F.date_sub(F.col("ts").cast("date"), shift).alias("event_date"),
        kind.alias("event_type"),
        F.when(kind == "feature_usage", F.concat(F.lit("f"), (F.col("k") % 12).cast("string"))).alias("feature_name"),
        F.when(kind == "content_view", F.col("value").cast("decimal(12,2)")).alias("duration_minutes"),
        F.when(kind == "content_view", F.col("k")).alias("content_id"),
        F.col("value"),
        F.col("k"),
    )


def engagement(spark: SparkSession, folder: str) -> DataFrame:
    return engagement_columns(table(spark, folder, "events")).drop("event_id", "ts", "value", "k")


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every raw event seen as one scoring request: who asked, when, how long it took, how it ended."""
    rows = engagement_columns(table(spark, folder, "events"))
    return rows.select(
        F.col("event_id").alias("request_id"),
        "customer_id",
        "ts",
        F.col("value").alias("response_ms"),
        (F.coalesce(F.col("k"), F.lit(1)) % 3 == 0).alias("cache_hit"),
        F.col("event_type").isin("support_ticket", "support_resolution").alias("error"),
    )


def intake(spark: SparkSession, folder: str) -> DataFrame:
    """Unchecked scoring requests built from the customer table; some of them break the input rules."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        F.when(key % 97 != 0, customer_key(key)).alias("customer_id"),
        (key % 45).cast("double").alias("recency_30d"),
        (key % 9).cast("double").alias("frequency_30d"),
        F.col("c_acctbal").alias("monetary_total_30d"),
        F.when(key % 31 != 0, F.abs(F.col("c_acctbal"))).alias("monetary_avg_30d"),
        ((key % 120).cast("double") / F.lit(100.0)).alias("engagement_score"),
        (key % 60 - 1).cast("int").alias("customer_tenure_months"),
        (key % 12).cast("int").alias("support_tickets_30d"),
        F.when(key % 50 != 0, key * 7 % 95 + 10).cast("int").alias("age"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "premium")
        .when(F.col("c_mktsegment") == "MACHINERY", "high_value")
        .when(F.col("c_mktsegment") == "BUILDING", "low_value")
        .otherwise("medium")
        .alias("value_tier"),
    )
