"""Feature drift (PSI, KS), performance drift, the retraining decision, candidate gates and A/B comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise import config
from staywise.operators.ranking import quantiles_of_counts, running_totals
from staywise.session import written

SHARE_FLOOR = 1e-4
DECILES = tuple(i / 10 for i in range(1, 10))
BASELINE, CURRENT = "baseline", "current"


def stacked_features(sides: dict[str, DataFrame], features: Sequence[str]) -> DataFrame:
    """(side, feature, value) rows of two or more feature tables."""
    result = None
    for side, df in sides.items():
        pairs = F.array(
            *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
        )
        rows = df.select(F.lit(side).alias("side"), F.inline(pairs))
        result = rows if result is None else result.unionByName(rows)
    return result


def value_counts(stacked: DataFrame) -> DataFrame:
    """(side, feature, value, n): exact counts of every value, NULL included. Counts of disjoint rows add up."""
    return stacked.groupBy("side", "feature", "value").agg(F.count("*").alias("n"))


def psi(stacked: DataFrame, shares: Sequence[float] = DECILES) -> DataFrame:
    """Population stability index per feature, from stacked rows."""
    return psi_of_counts(written(value_counts(stacked), "drift"), shares)


def psi_of_counts(counts: DataFrame, shares: Sequence[float] = DECILES) -> DataFrame:
    """Population stability index per feature, from counted values (side, feature, value, n).

    Bins are cut at the baseline deciles with open ends; NULLs form a bin of their own; a share is at least 1e-4.
    """
    edges = (
        quantiles_of_counts(counts.filter(F.col("side") == BASELINE), ["feature"], "value", shares)
        .groupBy("feature")
        .agg(F.collect_list("quantile").alias("edges"))  # one short array per feature
    )
    value = F.col("value")
    below = F.size(F.filter("edges", lambda edge: edge < value))
    counted = (
        counts.join(F.broadcast(edges), "feature", "left")
        .groupBy("feature", F.when(value.isNotNull(), below).alias("bin"))
        .agg(
            _rows_of(BASELINE).alias("baseline_rows"),
            _rows_of(CURRENT).alias("current_rows"),
        )
    )
    totals = counted.groupBy("feature").agg(
        F.sum("baseline_rows").alias("baseline_all"), F.sum("current_rows").alias("current_all")
    )
    expected = F.greatest(F.try_divide(F.col("baseline_rows"), F.col("baseline_all")), F.lit(SHARE_FLOOR))
    actual = F.greatest(F.try_divide(F.col("current_rows"), F.col("current_all")), F.lit(SHARE_FLOOR))
    return (
        counted.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.round(F.sum((actual - expected) * F.ln(actual / expected)), 6).alias("psi"))
    )


def _rows_of(side: str) -> Column:
    return F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(F.lit(0)))


def ks(stacked: DataFrame) -> DataFrame:
    """Largest gap between the two empirical distributions, per feature; NULLs are left out."""
    return ks_of_counts(value_counts(stacked))


def ks_of_counts(counts: DataFrame) -> DataFrame:
    """The same from counted values (side, feature, value, n)."""
    counted = (
        counts.filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(_rows_of(BASELINE).alias("b"), _rows_of(CURRENT).alias("c"))
    )
    placed = running_totals(counted, ["feature"], ["value"], ["b", "c"])
    gap = F.abs(
        F.try_divide(F.col("b_upto").cast("double"), F.col("b_all").cast("double"))
        - F.try_divide(F.col("c_upto").cast("double"), F.col("c_all").cast("double"))
    )
    return placed.groupBy("feature").agg(F.max(gap).alias("ks"))


def drift_alerts(scores: DataFrame, score: str, threshold: float = config.FEATURE_DRIFT_THRESHOLD) -> DataFrame:
    """One row: the feature that drifted most and whether that calls for an alert."""
    return scores.agg(
        F.max_by("feature", F.struct(F.col(score), F.col("feature"))).alias("feature"),
        F.max(score).alias("drift_score"),
        F.count_if(F.col(score) > threshold).alias("features_over_threshold"),
    ).withColumn("alert", F.coalesce(F.col("drift_score") > threshold, F.lit(False)))


def performance_drift(accuracy: Column, baseline: Column) -> Column:
    return F.try_divide(baseline - accuracy, baseline)


def retrain_decision(
    df: DataFrame,
    threshold: float = config.DRIFT_THRESHOLD,
    min_accuracy: float = config.PERFORMANCE_THRESHOLD,
) -> DataFrame:
    """Adds the drift columns and the decision to rows with current_accuracy, baseline_accuracy, drift_score.

    Without a model (no baseline accuracy) the answer is to train, with zeros reported.
    """
    known = F.col("baseline_accuracy").isNotNull()
    drift = performance_drift(F.col("current_accuracy"), F.col("baseline_accuracy"))
    data_drift = F.col("drift_score") > threshold
    retrain = (drift > threshold) | data_drift | (F.col("current_accuracy") < min_accuracy)
    reported = lambda column: F.when(known, F.round(column, 4)).otherwise(0.0)
    others = [c for c in df.columns if c not in ("current_accuracy", "baseline_accuracy", "drift_score")]
    return df.select(
        *others,
        reported(drift).alias("performance_drift"),
        F.coalesce(known & data_drift, F.lit(False)).alias("data_drift_detected"),
        F.when(known, F.coalesce(retrain, F.lit(False))).otherwise(True).alias("requires_retraining"),
        reported(F.col("current_accuracy")).alias("current_accuracy"),
        F.coalesce("baseline_accuracy", F.lit(0.0)).alias("baseline_accuracy"),
        reported(F.col("drift_score")).alias("drift_score"),
    )


def candidate_validation(
    df: DataFrame,
    min_accuracy: float = config.PERFORMANCE_THRESHOLD,
    min_auc: float = config.MIN_AUC,
    max_drop: float = config.MAX_ACCURACY_DROP,
    check_precision_recall: bool = False,
) -> DataFrame:
    """Gates for rows with accuracy, auc, baseline_accuracy (and precision, recall for the optional checks).

    Every failed gate is named in ``rejection_reasons``.
    """
    accuracy, auc = F.col("accuracy"), F.coalesce(F.col("auc"), F.lit(0.0))
    gain = accuracy - F.col("baseline_accuracy")
    checks = {
        "accuracy_check": (accuracy >= min_accuracy, F.lit(f"accuracy below {min_accuracy}")),
        "auc_check": (auc >= min_auc, F.lit(f"auc below {min_auc}")),
        "performance_regression_check": (-gain <= max_drop, F.lit(f"accuracy drop above {max_drop}")),
    }
    if check_precision_recall:
        checks["precision_check"] = (
            F.col("precision") >= config.MIN_PRECISION,
            F.lit(f"precision below {config.MIN_PRECISION}"),
        )
        checks["recall_check"] = (F.col("recall") >= config.MIN_RECALL, F.lit(f"recall below {config.MIN_RECALL}"))
    df = df.withColumns({name: condition for name, (condition, _) in checks.items()})
    passed = F.lit(True)
    for name in checks:
        passed = passed & F.col(name)
    reasons = F.array_compact(F.array(*[F.when(~F.col(name), text) for name, (_, text) in checks.items()]))
    saves = (gain * config.SAVES_PER_ACCURACY_POINT).cast("bigint")
    return df.withColumns(
        {
            "accuracy_improvement": gain,
            "validation_passed": passed,
            "rejection_reasons": reasons,
            "deployment_recommendation": F.when(passed, "APPROVE").otherwise("REJECT"),
            "estimated_customer_saves": F.when(passed, saves),
            "estimated_revenue_impact": F.when(passed, saves * config.CUSTOMER_VALUE),
        }
    )


def ab_compare(df: DataFrame, arm: str, converted: str, control: str = "A", variant: str = "B") -> DataFrame:
    """One row: size and rate per arm, lift of the variant, two-proportion z (pooled)."""
    hit = F.col(converted)
    counts = df.agg(
        *[
            column
            for name, label in ((control, "a"), (variant, "b"))
            for column in (
                F.count_if(F.col(arm) == name).alias(f"n_{label}"),
                F.count_if((F.col(arm) == name) & hit).alias(f"conversions_{label}"),
            )
        ]
    )
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    rate_a = F.try_divide(F.col("conversions_a").cast("double"), n_a)
    rate_b = F.try_divide(F.col("conversions_b").cast("double"), n_b)
    pooled = F.try_divide(F.col("conversions_a") + F.col("conversions_b").cast("double"), n_a + n_b)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n_a) + F.try_divide(F.lit(1.0), n_b)))
    return counts.select(
        "n_a",
        "conversions_a",
        F.round(rate_a, 6).alias("rate_a"),
        "n_b",
        "conversions_b",
        F.round(rate_b, 6).alias("rate_b"),
        F.round(F.try_divide(rate_b - rate_a, rate_a), 6).alias("lift"),
        F.round(F.try_divide(rate_b - rate_a, error), 6).alias("z"),
    )
