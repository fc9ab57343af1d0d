"""Lifetime value, churn risk and trend, as Column expressions and as SQL functions.

All three stay inside the JVM: Catalyst inlines them, so there is no Python stage in any plan that uses them.
A zero or NULL argument counts as "no information", as described at each function.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def informative(column: Column) -> Column:
    """True where the value is neither NULL nor zero (never NULL itself)."""
    return F.coalesce(column != 0, F.lit(False))


def _double(column: Column) -> Column:
    return column.cast("double")


def clv_score(
    total_revenue: Column,
    avg_order_value: Column,
    purchase_frequency: Column,
    tenure_months: Column,
    variant: str = "standard",
) -> Column:
    """Predicted lifetime value.

    ``standard``: 0 without revenue or tenure; missing frequency or order value count as 0.
    ``simple``: only a zero tenure is guarded, the lowest tier starts strictly below 50, NULLs propagate.
    """
    revenue, order_value = _double(total_revenue), _double(avg_order_value)
    frequency, tenure = _double(purchase_frequency), _double(tenure_months)
    if variant == "simple":
        tier = F.when(order_value > 500, 1.5).when(order_value > 200, 1.2).when(order_value < 50, 0.8).otherwise(1.0)
        monthly = F.when(tenure > 0, F.try_divide(revenue, tenure)).otherwise(0.0)
        value = monthly * _capped(tenure * 1.2, 60.0) * _capped(frequency * 2, 3.0) * tier
        return F.when(tenure == 0, 0.0).otherwise(value)
    if variant != "standard":
        raise ValueError("variant must be 'standard' or 'simple'")
    order_value = F.coalesce(order_value, F.lit(0.0))
    tier = F.when(order_value > 500, 1.5).when(order_value > 200, 1.2).when(order_value > 50, 1.0).otherwise(0.8)
    monthly = revenue / F.greatest(tenure, F.lit(1.0))
    value = monthly * _capped(tenure * 1.2, 60.0) * _capped(F.coalesce(frequency, F.lit(0.0)) * 2, 3.0) * tier
    return F.when(informative(revenue) & informative(tenure), value).otherwise(0.0)


def _capped(column: Column, limit: float) -> Column:
    # least() skips NULLs, so keep them explicitly.
    return F.when(column.isNotNull(), F.least(column, F.lit(limit)))


def risk_score(
    recency: Column, frequency: Column, monetary: Column, engagement: Column, support_tickets: Column
) -> Column:
    """Churn risk in [0, 1]; an argument that is NULL or 0 adds nothing."""
    recency, frequency, monetary = _double(recency), _double(frequency), _double(monetary)
    engagement, tickets = _double(engagement), _double(support_tickets)
    recency_part = F.when(recency > 90, 0.3).when(recency > 60, 0.2).when(recency > 30, 0.1).otherwise(0.0)
    frequency_part = (
        F.when(informative(frequency) & (frequency < 0.1), 0.25)
        .when(informative(frequency) & (frequency < 0.2), 0.15)
        .otherwise(0.0)
    )
    monetary_part = F.when(informative(monetary) & (monetary < 100), 0.2).otherwise(0.0)
    engagement_part = F.when(informative(engagement) & (engagement < 0.3), 0.15).otherwise(0.0)
    ticket_part = F.when(tickets > 10, 0.1).otherwise(0.0)
    return F.least(recency_part + frequency_part + monetary_part + engagement_part + ticket_part, F.lit(1.0))


def customer_trend(current: Column, previous: Column, threshold: Column | float = 0.1) -> Column:
    """improving / declining / stable by relative change, unknown where either side is NULL or 0."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    current, previous = _double(current), _double(previous)
    change = F.try_divide(current - previous, previous)
    return (
        F.when(~(informative(current) & informative(previous)), "unknown")
        .when(change > threshold, "improving")
        .when(change < -threshold, "declining")
        .otherwise("stable")
    )


SQL_FUNCTIONS = {
    "calculate_clv_score": """
        (total_revenue DOUBLE, avg_order_value DOUBLE, purchase_frequency DOUBLE, tenure_months DOUBLE)
        RETURNS DOUBLE
        RETURN CASE
            WHEN coalesce(total_revenue, 0D) = 0D OR coalesce(tenure_months, 0D) = 0D THEN 0D
            ELSE total_revenue / greatest(tenure_months, 1D) * least(tenure_months * 1.2D, 60D)
                * least(coalesce(purchase_frequency, 0D) * 2D, 3D)
                * CASE WHEN avg_order_value > 500D THEN 1.5D WHEN avg_order_value > 200D THEN 1.2D
                       WHEN avg_order_value > 50D THEN 1D ELSE 0.8D END
        END""",
    "calculate_risk_score": """
        (recency DOUBLE, frequency DOUBLE, monetary DOUBLE, engagement DOUBLE, support_tickets DOUBLE)
        RETURNS DOUBLE
        RETURN least(1D,
            CASE WHEN recency > 90D THEN 0.3D WHEN recency > 60D THEN 0.2D WHEN recency > 30D THEN 0.1D ELSE 0D END
            + CASE WHEN frequency = 0D OR frequency IS NULL THEN 0D WHEN frequency < 0.1D THEN 0.25D
                   WHEN frequency < 0.2D THEN 0.15D ELSE 0D END
            + CASE WHEN monetary <> 0D AND monetary < 100D THEN 0.2D ELSE 0D END
            + CASE WHEN engagement <> 0D AND engagement < 0.3D THEN 0.15D ELSE 0D END
            + CASE WHEN support_tickets > 10D THEN 0.1D ELSE 0D END)""",
    "determine_customer_trend": """
        (current_value DOUBLE, previous_value DOUBLE, threshold DOUBLE DEFAULT 0.1D)
        RETURNS STRING
        RETURN CASE
            WHEN coalesce(current_value, 0D) = 0D OR coalesce(previous_value, 0D) = 0D THEN 'unknown'
            WHEN try_divide(current_value - previous_value, previous_value) > threshold THEN 'improving'
            WHEN try_divide(current_value - previous_value, previous_value) < -threshold THEN 'declining'
            ELSE 'stable'
        END""",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the three scores callable from SQL text under their well-known names."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
    return list(SQL_FUNCTIONS)
