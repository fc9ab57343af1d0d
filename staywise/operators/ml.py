"""Preparation, search spaces, evaluation and storage of churn classifiers with Spark ML; ``search`` trains and compares them.

Known differences from single-machine libraries, none of which can be removed here: boosted trees are first order
and sample columns per node; the minimum leaf size counts rows; there is no minimum split size; the neural network
has sigmoid units and no weight penalty. The
regularisation of the logistic regression is converted with ``regParam = 1 / (C * n)``.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise import config
from staywise.operators import metrics, quality
from staywise.operators.ranking import exact_quantiles, global_rank

NUMERIC_TYPES = ("int", "bigint", "float", "double")
CATEGORICAL_TYPES = ("string", "boolean")
MODEL_ORDER = ("gradient_boosting", "random_forest", "neural_network", "logistic_regression")


@dataclass(frozen=True)
class Preset:
    """Search spaces and effort. ``draws=None`` searches the whole grid."""

    grids: dict[str, dict[str, list]]
    draws: int | None
    folds: int
    iterations: int
    parallelism: int = 4


# The search spaces to match.
FULL = Preset(
    grids={
        "gradient_boosting": {
            "maxIter": [100, 200, 300],
            "maxDepth": [6, 8, 10, 12],
            "stepSize": [0.01, 0.1, 0.2],
            "subsamplingRate": [0.8, 0.9, 1.0],
            "featureSubsetStrategy": ["0.8", "0.9", "all"],
            "minInstancesPerNode": [1, 3, 5],
        },
        "random_forest": {
            "numTrees": [100, 200, 300],
            "maxDepth": [10, 15, 20, 30],
            "minInstancesPerNode": [1, 2, 4],
            "featureSubsetStrategy": ["sqrt", "log2", "0.8"],
        },
        "neural_network": {
            "hidden": [(100,), (200,), (100, 50), (200, 100)],
            "stepSize": [0.001, 0.01, 0.1],
        },
        "logistic_regression": {"C": [0.1, 1, 10, 100], "mix": [1.0, 0.0, 0.1, 0.5, 0.9]},
    },
    draws=20,
    folds=5,
    iterations=1000,
)

SHORT = Preset(
    grids={
        "gradient_boosting": {
            "maxIter": [100, 200, 300],
            "maxDepth": [6, 8, 10],
            "stepSize": [0.01, 0.1, 0.2],
            "subsamplingRate": [0.8, 0.9, 1.0],
        },
        "random_forest": {"numTrees": [100, 200, 300], "maxDepth": [10, 15, 20], "minInstancesPerNode": [1, 2, 4]},
        "neural_network": {"hidden": [(100,), (200,), (100, 50)], "stepSize": [0.001, 0.01, 0.1]},
    },
    draws=None,
    folds=5,
    iterations=1000,
)

# Models of full size at a few points of ``FULL``: what the registered queries train. README has the times of all three.
BRIEF = Preset(
    grids={
        "gradient_boosting": {"maxIter": [100], "maxDepth": [6], "stepSize": [0.1], "subsamplingRate": [0.8, 1.0]},
        "random_forest": {"numTrees": [100, 200], "maxDepth": [10], "minInstancesPerNode": [1, 4]},
        "neural_network": {"hidden": [(100,)], "stepSize": [0.01, 0.1]},
        "logistic_regression": {"C": [0.1, 1, 10], "mix": [1.0, 0.0]},
    },
    draws=None,
    folds=5,
    iterations=100,
    parallelism=20,  # threads of the driver; each waits for short jobs, so there are more than cores
)

# For tests only.
TINY = Preset(
    grids={
        "gradient_boosting": {"maxIter": [3, 5], "maxDepth": [2, 3]},
        "random_forest": {"numTrees": [5, 8], "maxDepth": [3, 5]},
        "neural_network": {"hidden": [(4,), (6,)], "stepSize": [0.03]},
        "logistic_regression": {"C": [1, 10], "mix": [0.0]},
    },
    draws=2,
    folds=2,
    iterations=20,
)


@dataclass
class FeatureColumns:
    """Which columns go into the model, in order, and which were left out."""

    numeric: list[str]
    categorical: list[str]
    dropped: list[str] = field(default_factory=list)

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def exact_split(
    df: DataFrame, key: str, label: str, shares: Sequence[tuple[str, float]], seed: int = config.SPLIT_SEED
) -> DataFrame:
    """Adds ``split`` with exact shares per label: rows are ranked by a digest of their key inside each label.

    ``rules.hash_split`` needs no shuffle and is near these shares on large data; this one is for small or rare labels.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    ranked = global_rank(df.select(key, label, digest.alias("_digest")), [label], ["_digest", key], "_rows")
    place, reached, split = F.col("position") / F.col("_rows"), 0.0, None
    for name, share in shares[:-1]:
        reached = round(reached + share, 12)
        split = F.when(place <= reached, name) if split is None else split.when(place <= reached, name)
    return df.join(ranked.select(key, split.otherwise(shares[-1][0]).alias("split")), key)


def choose_columns(df: DataFrame, target: str, ignore: Sequence[str] = (), limit: int = config.MAX_CATEGORIES):
    """Columns by type; categorical columns with more than ``limit`` distinct values are left out."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    kinds = {n: t for n, t in df.dtypes if n != target and n not in ignore}
    numeric = [n for n, t in kinds.items() if t in NUMERIC_TYPES]
    text = [n for n, t in kinds.items() if t in CATEGORICAL_TYPES]
    kept = set()
    if text:
        kept = {r.column_name for r in quality.cardinality(df, text, limit).filter("kept").collect()}
    return FeatureColumns(numeric, [n for n in text if n in kept], [n for n in kinds if n not in {*numeric, *kept}])


def indexed_target(df: DataFrame, target: str) -> DataFrame:
    """Adds ``label``: the target itself, or its alphabetical class number if it is text."""
    if dict(df.dtypes)[target] == "string":
        return StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(df).transform(df)
    return df.withColumn("label", F.col(target).cast("double"))


def preparation(columns: FeatureColumns, fit: NumericFit | None = None) -> Pipeline:
    """Median imputation and scaling of numbers, 'missing' and one-hot slots for categories, one feature vector.

    ``fit`` holds the statistics of the numeric columns. A category unseen in training gets all zeros.
    """
    numbers = [f"{_scaled_text(c, fit)} AS `num_{c}`" for c in columns.numeric]
    texts = [f"coalesce(CAST(`{c}` AS STRING), 'missing') AS `cat_{c}`" for c in columns.categorical]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(numbers + texts)} FROM __THIS__")]
    parts = []
    if columns.numeric:
        stages.append(VectorAssembler(inputCols=[f"num_{c}" for c in columns.numeric], outputCol="scaled"))
        parts.append("scaled")
    if columns.categorical:
        codes, slots = [f"code_{c}" for c in columns.categorical], [f"slot_{c}" for c in columns.categorical]
        stages += [
            StringIndexer(
                inputCols=[f"cat_{c}" for c in columns.categorical],
                outputCols=codes,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            # The indexer's extra code for unseen labels is the last one, so it is the slot that is dropped.
            OneHotEncoder(inputCols=codes, outputCols=slots, dropLast=True),
        ]
        parts += slots
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


def slot_names(prepared: PipelineModel, columns: FeatureColumns) -> list[str]:
    """Original column of every slot of the feature vector."""
    names = list(columns.numeric)
    for stage in prepared.stages:
        if hasattr(stage, "labelsArray"):
            for column, labels in zip(columns.categorical, stage.labelsArray, strict=True):
                names += [column] * len(labels)
    return names


def drawn(grid: dict[str, list], draws: int | None, seed: int = config.SPLIT_SEED) -> list[dict]:
    """All combinations of a grid, or a seeded sample of them."""
    combinations = [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]
    if draws is None or draws >= len(combinations):
        return combinations
    return random.Random(seed).sample(combinations, draws)


def estimator(name: str, iterations: int, seed: int):
    if name == "gradient_boosting":
        return GBTClassifier(seed=seed)
    if name == "random_forest":
        return RandomForestClassifier(seed=seed)
    if name == "neural_network":
        return MultilayerPerceptronClassifier(seed=seed, maxIter=iterations, layers=[1, 2], solver="gd")
    if name == "logistic_regression":
        return LogisticRegression(maxIter=iterations)
    raise ValueError(f"unknown model {name}")


def param_map(name: str, estimator, chosen: dict, rows: int, width: int) -> dict:
    if name == "neural_network":
        return {
            estimator.layers: [width, *chosen["hidden"], 2],
            estimator.stepSize: float(chosen["stepSize"]),
        }
    if name == "logistic_regression":
        return {estimator.regParam: 1.0 / (chosen["C"] * rows), estimator.elasticNetParam: float(chosen["mix"])}
    return {estimator.getParam(p): v for p, v in chosen.items()}


@dataclass
class TrainingResult:
    columns: FeatureColumns
    preparation: PipelineModel
    models: dict
    runs: list[dict]
    best_model: str | None
    test: DataFrame

    def pipeline(self, name: str | None = None) -> PipelineModel:
        """Preparation and classifier in one transformer."""
        return PipelineModel(stages=[*self.preparation.stages, self.models[name or self.best_model]])

    def scored_test(self, name: str | None = None) -> DataFrame:
        return with_probability(self.models[name or self.best_model].transform(self.test))


def with_probability(predicted: DataFrame) -> DataFrame:
    p = F.element_at(vector_to_array(F.col("probability").alias("p")), 2)
    return predicted.withColumn("probability", p)


def evaluated(model, ready: DataFrame, split: str) -> dict[str, float]:
    """Train and validation metrics and their gaps."""
    rows = with_probability(model.transform(ready)).select(split, "label", "prediction", "probability")
    scores = {r[split]: r for r in metrics.classification_scores(rows, [split]).collect()}
    areas = {r[split]: r["auc"] for r in metrics.roc_auc(rows, [split]).collect()}
    result = {}
    for part in ("train", "val"):
        r = scores[part]
        result |= {
            f"{part}_accuracy": r["accuracy"],
            f"{part}_precision": r["precision_weighted"],
            f"{part}_recall": r["recall_weighted"],
            f"{part}_f1": r["f1_weighted"],
            f"{part}_auc": areas[part],
        }
    result["accuracy_diff"] = result["train_accuracy"] - result["val_accuracy"]
    result["auc_diff"] = result["train_auc"] - result["val_auc"]
    return result


def runs_table(spark: SparkSession, result: TrainingResult) -> DataFrame:
    """One row per (model, metric): a few dozen rows of results."""
    rows = [
        (run["model"], run["params"], run["error"], metric, float(value) if value is not None else None)
        for run in result.runs
        for metric, value in (run["metrics"] or {"failed": 1.0}).items()
    ]
    return spark.createDataFrame(rows, "model string, params string, error string, metric string, value double")


def importance_table(spark: SparkSession, result: TrainingResult, name: str, top: int = 20) -> DataFrame:
    """Importance per original column, the slots of a category added up; highest first."""
    weights: dict[str, float] = {}
    for column, weight in zip(
        slot_names(result.preparation, result.columns), result.models[name].featureImportances.toArray(), strict=True
    ):
        weights[column] = weights.get(column, 0.0) + float(weight)
    rows = spark.createDataFrame([(name, c, w) for c, w in weights.items()], "model string, feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)


def tree_model(result: TrainingResult) -> str | None:
    """The best model if it has importances, otherwise the first trained one that has."""
    for name in [result.best_model, *MODEL_ORDER]:
        if name in result.models and hasattr(result.models[name], "featureImportances"):
            return name
    return None


def final_report(result: TrainingResult) -> DataFrame:
    """Test metrics and business metrics of the winner as (metric, value) rows."""
    if result.best_model is None:
        raise ValueError("no trained model available")
    rows = result.scored_test().withColumn("model", F.lit(result.best_model))
    wide = (
        metrics.classification_scores(rows, ["model"])
        .join(metrics.roc_auc(rows, ["model"]), "model")
        .join(metrics.business_metrics(rows, ["model"]), "model")
    )
    names = [c for c in wide.columns if c != "model"]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])
    return wide.select("model", F.inline(pairs))


def save_model(result: TrainingResult, path: str, registry_path: str, created_at: str) -> None:
    """Store preparation and classifier as one pipeline and append a metadata row to the registry."""
    spark = result.test.sparkSession
    result.pipeline().write().overwrite().save(path)
    row = [(path, result.best_model, len(result.columns.all), ",".join(result.columns.all), created_at)]
    spark.createDataFrame(
        row, "model_path string, model_type string, n_features int, feature_names string, created_at string"
    ).coalesce(1).write.mode("append").parquet(registry_path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class NumericFit:
    """Median, mean and population deviation of each column: three numbers per feature."""

    median: dict[str, float]
    mean: dict[str, float]
    deviation: dict[str, float]


def _number(column: str) -> str:
    """A numeric column as a double; NaN counts as missing."""
    return f"nanvl(CAST(`{column}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def _scaled_text(column: str, fit: NumericFit) -> str:
    """One imputed and scaled column in SQL; a constant column is only centred."""
    median, mean, deviation = fit.median.get(column, 0.0), fit.mean[column] or 0.0, fit.deviation[column] or 1.0
    return f"(coalesce({_number(column)}, {median!r}D) - {mean!r}D) / {deviation!r}D"


def fit_numeric(train: DataFrame, columns: Sequence[str]) -> NumericFit:
    """Exact statistics for imputation and scaling, all columns in one stacked pass."""
    if not columns:
        return NumericFit({}, {}, {})
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.expr(_number(c)).alias("value")) for c in columns])
    stacked = train.select(F.inline(pairs))
    median = {r["name"]: r["quantile"] for r in exact_quantiles(stacked, ["name"], "value", [0.5]).collect()}
    filled = [F.coalesce(F.expr(_number(c)), F.lit(median.get(c, 0.0))).alias(c) for c in columns]
    row = (
        train.select(*filled)
        .agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
        .first()
    )
    return NumericFit(median, {c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] for c in columns})


def apply_numeric(df: DataFrame, fit: NumericFit) -> DataFrame:
    """Imputed and scaled columns, by the expressions that ``preparation`` uses."""
    return df.withColumns({c: F.expr(_scaled_text(c, fit)) for c in fit.mean})
