"""Classification, ranking, business and stability metrics over (label, prediction, probability) rows.

Every function takes ``group`` columns, so one pass serves any number of models and splits. Counts come from
one grouped aggregate; everything after it works on a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise import config
from staywise.operators.ranking import exact_quantiles, running_totals
from staywise.session import written

LABEL, PREDICTION, PROBABILITY = "label", "prediction", "probability"


def confusion_counts(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group."""
    actual, said = F.col(LABEL) == 1, F.col(PREDICTION) == 1
    return df.groupBy(*group).agg(
        F.count_if(~actual & ~said).alias("tn"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"),
        F.count_if(actual & said).alias("tp"),
    )


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _class_scores(hit: str, false_alarm: str, missed: str) -> tuple[Column, Column, Column]:
    h, a, m = F.col(hit), F.col(false_alarm), F.col(missed)
    return _share(h, h + a), _share(h, h + m), _share(2 * h, 2 * h + a + m)


def classification_scores(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Accuracy; precision, recall, F1 weighted by class support; the same for the positive class alone."""
    counts = confusion_counts(df, group)
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    positive = _class_scores("tp", "fp", "fn")
    negative = _class_scores("tn", "fn", "fp")
    weighted = [_share(negatives * b + positives * a, n) for a, b in zip(positive, negative, strict=True)]
    return counts.select(
        *group,
        n.alias("n"),
        _share(F.col("tp") + F.col("tn"), n).alias("accuracy"),
        weighted[0].alias("precision_weighted"),
        weighted[1].alias("recall_weighted"),
        weighted[2].alias("f1_weighted"),
        positive[0].alias("precision_churn"),
        positive[1].alias("recall_churn"),
        positive[2].alias("f1_churn"),
    )


def class_report(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One row per class: precision, recall, F1, support."""
    counts = confusion_counts(df, group)
    rows = []
    for label, cells, support in ((0, ("tn", "fn", "fp"), ("tn", "fp")), (1, ("tp", "fp", "fn"), ("tp", "fn"))):
        precision, recall, f1 = _class_scores(*cells)
        rows.append(
            F.struct(
                F.lit(label).alias("class"),
                precision.alias("precision"),
                recall.alias("recall"),
                f1.alias("f1"),
                (F.col(support[0]) + F.col(support[1])).alias("support"),
            )
        )
    return counts.select(*group, F.inline(F.array(*rows)))


def roc_auc(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve per group; NULL where a class is missing.

    Rows are first counted per distinct score, then the negatives below each score come from exact running
    totals. Half of the negatives at the same score count as below.
    """
    group = list(group)
    plain = df.select(*group, F.lit(0).alias("_all"), LABEL, PROBABILITY)
    by = [*group, "_all"]
    counted = plain.groupBy(*by, PROBABILITY).agg(
        F.count_if(F.col(LABEL) == 1).alias("positives"), F.count_if(F.col(LABEL) != 1).alias("negatives")
    )
    placed = running_totals(counted, by, [PROBABILITY], ["positives", "negatives"])
    # Twice the number of (positive, negative) pairs in the right order; exact in decimals.
    twice = F.col("positives").cast("decimal(19,0)") * (
        2 * F.col("negatives_upto") - F.col("negatives")
    ).cast("decimal(19,0)")
    return (
        placed.groupBy(*by)
        .agg(
            F.sum(twice).cast("double").alias("_twice"),
            F.max("positives_all").cast("double").alias("_positives"),
            F.max("negatives_all").cast("double").alias("_negatives"),
        )
        .select(*group, F.try_divide(F.col("_twice"), 2.0 * F.col("_positives") * F.col("_negatives")).alias("auc"))
    )


def overfit_gaps(df: DataFrame, group: Sequence[str], split: str = "split") -> DataFrame:
    """Accuracy and AUC on train and validation rows and their differences, per group."""
    by = [*group, split]
    df = written(df.select(*by, LABEL, PREDICTION, PROBABILITY), "predictions")
    scores = classification_scores(df, by).select(*by, "accuracy").join(roc_auc(df, by), by)
    pick = lambda name, part: F.max(F.when(F.col(split) == part, F.col(name)))
    wide = scores.groupBy(*group).agg(
        *[
            pick(metric, part).alias(f"{part}_{metric}")
            for metric in ("accuracy", "auc")
            for part in ("train", "val")
        ]
    )
    return wide.withColumn("accuracy_diff", F.col("train_accuracy") - F.col("val_accuracy")).withColumn(
        "auc_diff", F.col("train_auc") - F.col("val_auc")
    )


def business_metrics(
    df: DataFrame,
    group: Sequence[str] = (),
    value: float = config.CUSTOMER_VALUE,
    cost: float = config.RETENTION_COST,
) -> DataFrame:
    """Money view of the confusion matrix, plus the score that still catches 90 % of the churners."""
    group = list(group)
    by = [*group, "_all"]
    plain = written(df.select(*group, F.lit(0).alias("_all"), LABEL, PREDICTION, PROBABILITY), "predictions")
    counts = confusion_counts(plain, by)
    cut = exact_quantiles(plain.filter(F.col(LABEL) == 1), by, PROBABILITY, [0.1]).select(
        *by, F.col("quantile").alias("precision_threshold_90")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    lost, wasted, saved = fn * value, fp * cost, tp * (value - cost)
    roi = (saved - (lost + wasted)).cast("double") / F.greatest(lost + wasted, F.lit(1)).cast("double")
    return counts.join(cut, by, "left").select(
        *group,
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        F.col("tn").alias("true_negatives"),
        fn.alias("false_negatives"),
        _share(tp, tp + fp).alias("precision_at_risk"),
        _share(tp, tp + fn).alias("recall_at_risk"),
        lost.alias("cost_of_false_negatives"),
        wasted.alias("cost_of_false_positives"),
        saved.alias("savings_from_true_positives"),
        "precision_threshold_90",
        roi.alias("roi"),
    )


def fold_stability(df: DataFrame, fold: str, group: Sequence[str] = ()) -> DataFrame:
    """Accuracy per fold, then mean, spread and stability over the folds (population moments)."""
    per_fold = df.groupBy(*group, fold).agg(
        (F.count_if(F.col(LABEL) == F.col(PREDICTION)).cast("double") / F.count("*")).alias("accuracy")
    )
    mean, std = F.avg("accuracy"), F.stddev_pop("accuracy")
    return per_fold.groupBy(*group).agg(
        F.count("*").alias("folds"),
        F.round(mean, 6).alias("cv_mean_accuracy"),
        F.round(std, 6).alias("cv_std_accuracy"),
        F.round(F.min("accuracy"), 6).alias("cv_min_accuracy"),
        F.round(F.max("accuracy"), 6).alias("cv_max_accuracy"),
        F.round(F.var_pop("accuracy"), 6).alias("cv_variance"),
        F.round(1 - F.try_divide(std, mean), 6).alias("stability_score"),
    )


def leaderboard(scores: DataFrame, order: Sequence[str], model: str = "model", by: str = "val_accuracy") -> DataFrame:
    """Marks the model with the best value; on a tie the one that comes first in ``order`` wins."""
    place = F.array_position(F.array(*[F.lit(name) for name in order]), F.col(model))
    # One row per trained model: the window over all of them is as small as the list of models.
    all_models = Window.partitionBy(F.lit(0))
    best = F.max_by(model, F.struct(F.col(by), -place)).over(all_models)
    return scores.withColumn("is_best", F.col(model) == best)
