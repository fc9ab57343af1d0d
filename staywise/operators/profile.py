"""Value, risk, lifecycle, affinity and demographic features derived from the windowed columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise import config
from staywise.functions import rules, scores


def predicted_clv(variant: str = "standard") -> Column:
    return scores.clv_score(
        F.col("monetary_total_365d"),
        F.col("monetary_avg_90d"),
        F.col("purchase_frequency_90d"),
        F.col("customer_tenure_months"),
        variant,
    )


def with_risk_and_health(features: DataFrame, recency: str = "recency_30d") -> DataFrame:
    """Churn risk and its complement.

    A 30-day recency never exceeds 30, so with the default column the recency part stays 0; pass
    ``recency_365d`` to let it count.
    """
    risk = scores.risk_score(
        F.col(recency),
        F.col("purchase_frequency_30d"),
        F.col("monetary_total_30d"),
        F.col("engagement_score"),
        F.col("support_tickets_30d"),
    )
    return features.withColumn("churn_risk_score", risk).withColumn(
        "customer_health_score", F.lit(1.0) - F.col("churn_risk_score")
    )


def lifecycle_columns(as_of: date) -> dict[str, Column]:
    today = F.lit(as_of)
    days = F.datediff(today, F.col("signup_date"))
    return {
        "days_since_signup": days,
        "customer_lifecycle_stage": rules.lifecycle_stage(days),
        "signup_month": F.month("signup_date"),
        "signup_quarter": F.quarter("signup_date"),
        "current_month": F.month(today),
        "is_holiday_season": rules.flag(F.month(today).isin(*config.HOLIDAY_MONTHS)),
    }


def affinity_columns() -> dict[str, Column]:
    variance = F.col("spending_variance_90d")
    ratio = F.try_divide(variance, F.col("monetary_avg_90d"))
    return {
        "product_diversity_score": F.col("category_diversity_90d").cast("double") / 10.0,
        # An average of 0 gives NULL here, which the final fill turns into 0.
        "spending_consistency": F.when(variance > 0, F.try_divide(F.lit(1.0), 1.0 + ratio)).otherwise(1.0),
        "value_tier": rules.value_tier(F.col("monetary_total_365d")),
    }


def demographic_columns(as_of: date) -> dict[str, Column]:
    return {
        "age_group": rules.age_group(F.col("age")),
        "is_urban": rules.flag(F.col("city_type") == "metro"),
        "account_age_months": F.months_between(F.lit(as_of), F.col("signup_date")),
        "has_premium_features": rules.flag(F.col("subscription_tier").isin(*config.PAID_TIERS)),
    }


def snapshot_columns(as_of: date) -> dict[str, Column]:
    """Features straight from a per-customer snapshot table (totals already known)."""
    recency = F.datediff(F.lit(as_of), F.col("last_purchase_date"))
    engagement = (
        F.col("login_frequency_30d") * 0.3
        + F.col("support_interactions_30d") * 0.2
        + F.col("feature_usage_score") * 0.3
        + F.col("community_participation") * 0.2
    )
    earlier = F.greatest(F.col("revenue_60d"), F.lit(1.0))
    return {
        "recency_days": recency,
        "purchase_frequency_30d": F.col("purchases_30d").cast("double") / 30.0,
        "purchase_frequency_90d": F.col("purchases_90d").cast("double") / 90.0,
        "avg_order_value": F.col("total_revenue") / F.greatest(F.col("total_orders").cast("double"), F.lit(1.0)),
        "revenue_trend": (F.col("revenue_30d") - F.col("revenue_60d")) / earlier,
        "engagement_score": engagement,
        "high_risk_churn": (recency > 60) & (engagement < 0.3) & (F.col("support_tickets_30d") > 5),
    }


def filled_by_type(df: DataFrame) -> DataFrame:
    """Missing int, long, float and double values become 0, missing text becomes 'unknown'."""
    numeric = [n for n, t in df.dtypes if t in ("int", "bigint", "float", "double")]
    text = [n for n, t in df.dtypes if t == "string"]
    return df.fillna(0, subset=numeric).fillna("unknown", subset=text)
