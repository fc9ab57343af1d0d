"""Engagement counts over nested windows and the weighted engagement score."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise import config
from staywise.functions.scores import customer_trend
from staywise.operators import bands

KEY = "customer_id"

# Output column -> event type it counts.
EVENT_COUNTS = {
    "login_count": "login",
    "feature_usage": "feature_usage",
    "support_tickets": "support_ticket",
    "support_resolved": "support_resolution",
    "forum_posts": "forum_post",
    "reviews": "review_submission",
}

# Output column -> SQL text of the member that it counts once.
MEMBERS = {
    "active_days": "IF(event_type = 'login', CAST(event_date AS STRING), NULL)",
    "features_used": "IF(event_type = 'feature_usage', feature_name, NULL)",
    "unique_content": "IF(event_type = 'content_view', CAST(content_id AS STRING), NULL)",
}

# The five components, each in [0, 1]; without tickets support counts as neutral.
COMPONENTS = {
    "login_engagement": "least(login_count_30d / 30D, 1D)",
    "feature_engagement": "least(features_used_30d / 10D, 1D)",
    "support_engagement": """CASE WHEN support_tickets_30d > 0
        THEN least(CAST(support_resolved_30d AS DOUBLE) / support_tickets_30d, 1D) ELSE 0.5D END""",
    "community_engagement": "least((forum_posts_30d + reviews_30d) / 5D, 1D)",
    "content_engagement": "least(content_minutes_30d / 300D, 1D)",
}


def engagement_columns(days: int) -> list[str]:
    """Feature names of one window, in output order."""
    return [
        f"login_count_{days}d",
        f"active_days_{days}d",
        f"feature_usage_{days}d",
        f"features_used_{days}d",
        f"support_tickets_{days}d",
        f"support_resolved_{days}d",
        f"forum_posts_{days}d",
        f"reviews_{days}d",
        f"content_minutes_{days}d",
        f"unique_content_{days}d",
    ]


def engagement_windows(
    events: DataFrame,
    as_of: date,
    windows: Sequence[int] = config.ENGAGEMENT_WINDOWS,
    weight: str = "1",
    members: bool = True,
) -> DataFrame:
    """All windowed engagement features of the customers with an event in the longest window.

    ``weight`` is the number of events a row stands for, for rows that are already partial sums. Without ``members`` the
    distinct counts are left out, and with them their copy of the rows and one shuffle.
    """
    edges = bands.band_edges(windows)
    records = bands.band_records(
        events,
        KEY,
        "event_date",
        as_of,
        edges,
        measures={"event": "event_type", "events": f"CAST({weight} AS BIGINT)", "minutes": "IF(event_type = 'content_view', duration_minutes, 0)"},
        facts={
            **{name: f"sum(IF(event = '{event}', events, 0L))" for name, event in EVENT_COUNTS.items()},
            "content_minutes": "sum(minutes)",
        },
        members=MEMBERS if members else {},
    )
    columns = {}
    for days in windows:
        for name in engagement_columns(days):
            if not members and name.rsplit("_", 1)[0] in MEMBERS:
                continue
            total = bands.up_to(days, name.rsplit("_", 1)[0])
            columns[name] = f"CAST({total} AS DOUBLE)" if name.startswith("content_minutes") else total
    return bands.over_windows(records, KEY, columns)


def with_engagement_windows(
    customers: DataFrame, events: DataFrame, as_of: date, windows: Sequence[int] = config.ENGAGEMENT_WINDOWS
) -> DataFrame:
    return customers.join(engagement_windows(events, as_of, windows), KEY, "left")


def with_engagement_score(features: DataFrame, previous: Column | None = None) -> DataFrame:
    """Five capped components, their weighted sum and the trend label.

    Every ``*_30d`` column is filled with 0 first, the transaction ones included. The trend compares with
    ``previous``; without one, 0.9 of the score itself stands in for it.
    """
    features = features.fillna(0, subset=[name for name in features.columns if name.endswith("_30d")])
    features = features.selectExpr("*", *[f"{sql} AS {name}" for name, sql in COMPONENTS.items()])
    score = " + ".join(f"{name} * {weight}D" for name, weight in config.ENGAGEMENT_WEIGHTS.items())
    features = features.selectExpr("*", f"{score} AS engagement_score")
    before = F.col("engagement_score") * 0.9 if previous is None else previous
    return features.withColumn("engagement_trend_30_90", customer_trend(F.col("engagement_score"), before))
