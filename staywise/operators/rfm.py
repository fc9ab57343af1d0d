"""Recency, frequency and monetary features over five nested windows, quintile scores and segments."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise import config
from staywise.functions import rules
from staywise.operators import bands
from staywise.operators.ranking import global_ntile
from staywise.session import written

KEY = "customer_id"


def rfm_columns(days: int, diversity: bool = True) -> list[str]:
    """Feature names of one window, in output order."""
    names = [
        f"recency_{days}d",
        f"frequency_{days}d",
        f"monetary_total_{days}d",
        f"monetary_avg_{days}d",
        f"category_diversity_{days}d",
        f"spending_variance_{days}d",
        f"purchase_frequency_{days}d",
        f"recent_spending_{days}d",
    ]
    return names if diversity else [n for n in names if not n.startswith("category_diversity")]


def transaction_windows(
    transactions: DataFrame,
    as_of: date,
    windows: Sequence[int] = config.TRANSACTION_WINDOWS,
    diversity: bool = True,
) -> DataFrame:
    """All windowed transaction features of the customers who bought in the longest window.

    A customer without a row in some window has NULL in its columns. Without ``diversity`` the distinct
    categories are left out, which saves a copy of the rows and a shuffle.
    """
    edges = bands.band_edges(windows, halves=True)
    records = bands.band_records(
        transactions,
        KEY,
        "transaction_date",
        as_of,
        edges,
        measures={"amount": "transaction_amount"},
        facts={
            "newest_age": "min(age)",
            "n": "count(age)",
            "priced": "count(amount)",
            "spend": "sum(amount)",
            "spread": "var_pop(amount) * count(amount)",
            "low": "min(amount)",
            "high": "max(amount)",
        },
        members={"categories": "product_category"} if diversity else {},
    )
    totals = {"newest_age": "min(newest_age)"}
    for edge in edges:
        totals[f"n_{edge}"] = bands.up_to(edge, "n")
        totals[f"spend_{edge}"] = bands.up_to(edge, "spend")
        totals[f"own_priced_{edge}"] = bands.only(edge, "priced")
        totals[f"own_mean_{edge}"] = bands.only(edge, "try_divide(CAST(spend AS DOUBLE), CAST(priced AS DOUBLE))")
    for days in windows:
        totals[f"priced_{days}"] = bands.up_to(days, "priced")
        if diversity:
            totals[f"categories_{days}"] = bands.up_to(days, "categories")
        totals[f"spread_{days}"] = bands.up_to(days, "spread")
        totals[f"low_{days}"] = bands.up_to(days, "low", "min")
        totals[f"high_{days}"] = bands.up_to(days, "high", "max")
    wide = bands.over_windows(records, KEY, totals)
    means = wide.selectExpr(
        "*", *[f"try_divide(CAST(spend_{w} AS DOUBLE), CAST(priced_{w} AS DOUBLE)) AS mean_{w}" for w in windows]
    )
    return means.selectExpr(KEY, *[column for days in windows for column in _window_features(days, edges, diversity)])


def _window_features(days: int, edges: Sequence[int], diversity: bool) -> list[str]:
    half = days // 2
    # Moments merged over the bands without cancelling: spread inside each band plus spread of the band means.
    between = " + ".join(
        f"coalesce(own_priced_{e} * power(own_mean_{e} - mean_{days}, 2), 0D)" for e in edges if e <= days
    )
    merged = f"(spread_{days} + {between})"
    values = [
        f"IF(newest_age <= {days}, newest_age, NULL)",
        f"n_{days}",
        f"CAST(spend_{days} AS DOUBLE)",
        f"mean_{days}",
        *([f"categories_{days}"] if diversity else []),
        # Equal amounts have no spread at all, whatever their means were rounded to.
        f"IF(priced_{days} > 1, IF(low_{days} = high_{days}, 0D, sqrt({merged} / greatest(priced_{days} - 1, 1))), NULL)",
        f"CAST(n_{days} AS DOUBLE) / {days}D",
        # All rows in the newer half: their sum, NULL if none of them has an amount. Otherwise older rows add 0.
        f"CAST(IF(n_{days} > coalesce(n_{half}, 0), coalesce(spend_{half}, 0), spend_{half}) AS DOUBLE)",
    ]
    return [f"{value} AS {name}" for value, name in zip(values, rfm_columns(days, diversity), strict=True)]


def with_transaction_windows(
    customers: DataFrame,
    transactions: DataFrame,
    as_of: date,
    windows: Sequence[int] = config.TRANSACTION_WINDOWS,
    diversity: bool = True,
) -> DataFrame:
    """One row per customer, bought or not."""
    return customers.join(transaction_windows(transactions, as_of, windows, diversity), KEY, "left")


def with_rfm_scores(features: DataFrame, inactive_recency: str = "best") -> DataFrame:
    """Quintile scores, composite and segment from the 30-day metrics.

    Ties are broken by customer id, which makes the quintiles reproducible. Customers without a purchase in
    30 days have a NULL recency; it sorts first and thereby scores best, the behaviour to match.
    ``inactive_recency="worst"`` puts them last instead.
    """
    if inactive_recency not in ("best", "worst"):
        raise ValueError("inactive_recency must be 'best' or 'worst'")
    features = written(features, "rfm-features")
    never = float("inf")
    recency = F.col("recency_30d").cast("double")
    ranked = global_ntile(
        features,
        KEY,
        {
            "recency": recency if inactive_recency == "best" else F.coalesce(recency, F.lit(never)),
            "frequency": F.col("frequency_30d").cast("double"),
            "monetary": F.col("monetary_total_30d").cast("double"),
        },
        buckets=5,
    )
    scores = ranked.select(
        KEY,
        (6 - F.col("recency")).alias("recency_score"),
        F.col("frequency").alias("frequency_score"),
        F.col("monetary").alias("monetary_score"),
    )
    composite = F.col("recency_score") * 100 + F.col("frequency_score") * 10 + F.col("monetary_score")
    return (
        features.join(scores, KEY, "left")  # a customer without an id has no rank, but stays
        .withColumn("rfm_score", composite)
        .withColumn("customer_segment", rules.customer_segment(F.col("rfm_score")))
    )
