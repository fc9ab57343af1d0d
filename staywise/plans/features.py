"""The complete feature table: one row per customer with every feature group."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.operators import profile
from staywise.operators.engagement import with_engagement_score, with_engagement_windows
from staywise.operators.rfm import with_rfm_scores, with_transaction_windows


def rfm_features(
    customers: DataFrame, transactions: DataFrame, as_of: date, inactive_recency: str = "best"
) -> DataFrame:
    """Windowed recency, frequency and monetary features with scores and segment."""
    return with_rfm_scores(with_transaction_windows(customers, transactions, as_of), inactive_recency)


def behavioral_features(customers: DataFrame, engagement: DataFrame, as_of: date) -> DataFrame:
    """Windowed engagement features with components, score and trend."""
    return with_engagement_score(with_engagement_windows(customers, engagement, as_of))


def advanced_features(features: DataFrame, as_of: date) -> DataFrame:
    """Lifetime value, risk, health, lifecycle, affinity and demographic features."""
    features = features.withColumn("predicted_clv", profile.predicted_clv())
    return profile.with_risk_and_health(features).withColumns(
        {**profile.lifecycle_columns(as_of), **profile.affinity_columns(), **profile.demographic_columns(as_of)}
    )


def feature_table(
    customers: DataFrame,
    transactions: DataFrame,
    engagement: DataFrame,
    as_of: date,
    creation_timestamp: bool = True,
    inactive_recency: str = "best",
) -> DataFrame:
    """Everything above in one table, missing values filled by type."""
    windowed = with_engagement_windows(with_transaction_windows(customers, transactions, as_of), engagement, as_of)
    scored = with_engagement_score(with_rfm_scores(windowed, inactive_recency))
    finished = profile.filled_by_type(advanced_features(scored, as_of))
    return finished.withColumn("feature_creation_timestamp", F.current_timestamp()) if creation_timestamp else finished
