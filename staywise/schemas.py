"""Explicit schemas of the three inputs, the serving log and the scored record."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("customer_name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("city_type", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("subscription_tier", T.StringType()),
        T.StructField("customer_tenure_months", T.IntegerType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("transaction_amount", MONEY),
        T.StructField("product_category", T.StringType()),
    ]
)

ENGAGEMENT = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("duration_minutes", MONEY),
        T.StructField("content_id", T.IntegerType()),
    ]
)

SERVING_LOG = T.StructType(
    [
        T.StructField("request_id", T.LongType(), False),
        T.StructField("customer_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("response_ms", T.DoubleType()),
        T.StructField("cache_hit", T.BooleanType()),
        T.StructField("error", T.BooleanType()),
    ]
)

SCORED = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("churn_prediction", T.BooleanType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("recommended_actions", T.ArrayType(T.StringType())),
        T.StructField("model_version", T.StringType()),
        T.StructField("prediction_timestamp", T.TimestampType()),
    ]
)

# Raw shape of the event table that feeds the streaming jobs.
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Stored feature tables. Counts are long, amounts and shares double, one version date per row.
DEMOGRAPHIC_FEATURES = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("age", T.IntegerType()),
        T.StructField("city_type", T.StringType()),
        T.StructField("subscription_tier", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("version_date", T.DateType()),
    ]
)


def windowed_features(names: list[str], doubles: tuple[str, ...]) -> T.StructType:
    """Schema of a table of windowed features; names starting with one of ``doubles`` are double, others long."""
    fields = [T.StructField("customer_id", T.StringType(), False)]
    fields += [T.StructField(n, T.DoubleType() if n.startswith(doubles) else T.LongType()) for n in names]
    return T.StructType([*fields, T.StructField("version_date", T.DateType())])
