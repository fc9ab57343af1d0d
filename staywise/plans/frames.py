"""Frames shared by the registered queries: scoring inputs, labelled history, candidate models, drift sides."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise import config
from staywise.functions import rules
from staywise.operators.engagement import with_engagement_score, with_engagement_windows
from staywise.operators.histograms import HistogramStore
from staywise.operators.rfm import with_transaction_windows
from staywise.operators.scoring import formula_probability
from staywise.session import work_folder
from staywise.sources import adapters
from staywise.sources.readers import input_state

AS_OF = adapters.AS_OF
OUTCOME_DAYS = 90
LABEL_DATE = AS_OF - timedelta(days=OUTCOME_DAYS)
SPLITS = (("train", 0.7), ("val", 0.1), ("test", 0.2))
DRIFT_FEATURES = (
    "recency_30d",
    "frequency_30d",
    "monetary_total_30d",
    "engagement_score",
    "support_tickets_30d",
)

# Candidate models as fixed formulas over the scoring fields; the order settles ties.
CANDIDATES = ("blend", "recency", "frequency", "engagement")


def history(
    spark: SparkSession, folder: str, as_of: date = AS_OF, days: int = 365, category: bool = True
) -> DataFrame:
    """Transactions dated in ``[as_of - days, as_of]``, filtered at the scan."""
    return adapters.transactions(spark, folder, as_of - timedelta(days=days), as_of, category)


def windowed(
    spark: SparkSession,
    folder: str,
    as_of: date = AS_OF,
    windows: tuple[int, ...] = (30, 365),
    engagement_windows: tuple[int, ...] = (30,),
    diversity: bool = False,
) -> DataFrame:
    """Customers with transaction and engagement windows, nothing filled."""
    customers = adapters.customers(spark, folder, as_of)
    rows = history(spark, folder, as_of, max(windows), category=diversity)
    bought = with_transaction_windows(customers, rows, as_of, windows, diversity)
    return with_engagement_windows(bought, adapters.engagement(spark, folder), as_of, engagement_windows)


def scoring_inputs(spark: SparkSession, folder: str, as_of: date = AS_OF) -> DataFrame:
    """One scoring request per customer.

    ``recency_30d`` carries the days since the last purchase of the past year (0 without one), so that the
    rules on long inactivity can apply.
    """
    scored = with_engagement_score(windowed(spark, folder, as_of))
    number = lambda name: F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return scored.select(
        "customer_id",
        number("recency_365d").alias("recency_30d"),
        number("frequency_30d").alias("frequency_30d"),
        number("monetary_total_30d").alias("monetary_total_30d"),
        number("monetary_avg_30d").alias("monetary_avg_30d"),
        "engagement_score",
        F.coalesce("customer_tenure_months", F.lit(0)).alias("customer_tenure_months"),
        F.coalesce("support_tickets_30d", F.lit(0)).alias("support_tickets_30d"),
        F.coalesce("age", F.lit(config.DEFAULT_AGE)).alias("age"),
        rules.value_tier(F.col("monetary_total_365d")).alias("value_tier"),
        "city_type",
        "subscription_tier",
        "signup_date",
    )


def scored_inputs(spark: SparkSession, folder: str, as_of: date = AS_OF) -> DataFrame:
    return scoring_inputs(spark, folder, as_of).withColumn("probability", formula_probability())


def buyers_after(spark: SparkSession, folder: str, start: date, days: int) -> DataFrame:
    """Customers with a purchase in ``(start, start + days]``."""
    bought = adapters.transactions(spark, folder, start + timedelta(days=1), start + timedelta(days=days), False)
    return bought.select("customer_id").distinct()


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring inputs as of the label date with probability, prediction and what happened afterwards.

    ``label`` is 1 for customers without a purchase in the 90 days after the label date. Features use nothing
    later than the label date.
    """
    bought = buyers_after(spark, folder, LABEL_DATE, OUTCOME_DAYS).withColumn("bought", F.lit(1))
    return (
        scored_inputs(spark, folder, LABEL_DATE)
        .join(bought, "customer_id", "left")
        .withColumn("label", F.when(F.col("bought").isNull(), 1).otherwise(0))
        .withColumn("prediction", F.when(F.col("probability") > 0.5, 1).otherwise(0))
        .withColumn("split", rules.hash_split(F.col("customer_id"), config.SPLIT_SEED, SPLITS))
        .drop("bought")
    )


def candidate_scores() -> dict[str, Column]:
    return {
        "blend": formula_probability(),
        "recency": F.least(F.col("recency_30d") / 365.0, F.lit(1.0)),
        "frequency": 1.0 / (F.col("frequency_30d") + 1.0),
        "engagement": 1.0 - F.col("engagement_score"),
    }


def candidate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(model, customer_id, split, label, prediction, probability) of every candidate, from one pass."""
    scores = candidate_scores()
    rows = F.array(
        *[F.struct(F.lit(m).alias("model"), scores[m].alias("probability")) for m in CANDIDATES]
    )
    return (
        labelled(spark, folder)
        .drop("probability", "prediction")
        .select("customer_id", "split", "label", F.inline(rows))
        .withColumn("prediction", F.when(F.col("probability") > 0.5, 1).otherwise(0))
    )


DRIFT_DAYS = {"baseline": LABEL_DATE, "current": AS_OF}


def drift_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Value counts of the drift features on the label date (baseline) and today (current), missing values left as they are.

    Each day is counted once and kept in the work folder under a name made from the state of the input files; a changed file
    leads to another name. Later calls read two stored partitions.
    """
    state = input_state(spark, [f"{folder}/{name}.parquet" for name in ("customer", "orders", "lineitem", "events")])
    store = HistogramStore(f"{work_folder(spark).rstrip('/')}/histograms-{state}")
    known = store.days(spark)
    for day in DRIFT_DAYS.values():
        if day.isoformat() not in known:
            store.put(_with_score(windowed(spark, folder, day, windows=(30,))), DRIFT_FEATURES, day)
    return store.compared(spark, DRIFT_DAYS)


def _with_score(raw: DataFrame) -> DataFrame:
    """Adds the engagement score but keeps NULLs in the 30-day columns (the score itself fills them)."""
    kept = [name for name in DRIFT_FEATURES if name in raw.columns]
    copies = raw.withColumns({f"{name}_raw": F.col(name) for name in kept})
    scored = with_engagement_score(copies)
    return scored.select("customer_id", "engagement_score", *[F.col(f"{name}_raw").alias(name) for name in kept])
