"""Model search that survives restarts: one stored row per (model, parameters, fold), written as soon as it is known.

A store belongs to one training table, which its first run writes there together with the fitted preparation; later runs read both, so
all pieces of a search see the same rows. Folds come from a hash of the row, not from the order of a scan, so equal rows are always on the
same side. A cell that is stored is never trained again, whatever preset asks for it; a cell that failed is tried again by the next run.
Cells of boosted trees, forests and networks that are asked for together go through the rows together (``passes``) and are stored together.
Everything collected here is one row per cell, a number that the grids fix, not the data.
"""

from __future__ import annotations

import hashlib
import json
import logging
import threading
import time
from collections import deque
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import cached_property, partial
from statistics import fmean, pstdev

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise import config
from staywise.operators import ml, passes
from staywise.session import is_written

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Cell:
    """One fit: a model with chosen parameters, trained without one fold and judged on it."""

    model: str
    params: str
    fold: int
    key: str


class SearchStore:
    """Folder layout: ``rows``, ``preparation``, ``columns``, ``ready-…``, ``cells/cell=…``, ``models/…``, ``runs/run=…``."""

    CELLS = "model string, params string, fold int, auc double, accuracy double, seconds double, cell string"
    RUNS = "model string, params string, metrics map<string,double>, run string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str, part: str) -> DataFrame:
        path = f"{self.path}/{name}"
        self.spark.createDataFrame([], schema).write.mode("ignore").partitionBy(part).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def cells(self) -> DataFrame:
        return self._table("cells", self.CELLS, "cell")

    def runs(self) -> DataFrame:
        return self._table("runs", self.RUNS, "run")

    def put(self, name: str, part: str, key: str, row: tuple, schema: str) -> None:
        """One row in a folder of its own: writers at the same time do not meet, and a repeated one changes nothing."""
        values = self.spark.createDataFrame([row], schema.rpartition(",")[0]).coalesce(1)
        values.write.mode("overwrite").parquet(f"{self.path}/{name}/{part}={key}")

    def rows(self, name: str, df: DataFrame) -> DataFrame:
        """The rows that the first run wrote under this name."""
        path = f"{self.path}/{name}"
        if not is_written(self.spark, path):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def prepared(self, labelled: DataFrame, train: DataFrame, target: str, ignore: Sequence[str]) -> tuple[ml.FeatureColumns, PipelineModel]:
        """Columns and fitted preparation; the columns are written last and so mark both as whole."""
        columns_path, path = f"{self.path}/columns", f"{self.path}/preparation"
        if is_written(self.spark, columns_path):
            row = self.spark.read.parquet(columns_path).first()
            return ml.FeatureColumns(row["numeric"], row["categorical"], row["dropped"]), PipelineModel.load(path)
        columns = ml.choose_columns(train, target, ["label", *ignore])
        fitted = ml.preparation(columns, ml.fit_numeric(train, columns.numeric)).fit(train)
        fitted.write().overwrite().save(path)
        row = self.spark.createDataFrame(
            [(columns.numeric, columns.categorical, columns.dropped)],
            "numeric array<string>, categorical array<string>, dropped array<string>",
        )
        row.write.mode("overwrite").parquet(columns_path)
        return columns, fitted


def _key(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:32]


class Search:
    """Every model of a preset by cross-validated ROC-AUC, in as many pieces as needed."""

    def __init__(
        self,
        df: DataFrame,
        target: str,
        preset: ml.Preset,
        path: str,
        split: str = "split",
        ignore: Sequence[str] = (),
        seed: int = config.SPLIT_SEED,
    ):
        if target not in df.columns:
            raise ValueError(f"target column '{target}' not found")
        self.preset, self.split, self.seed = preset, split, seed
        self.spark = df.sparkSession
        self.store = SearchStore(self.spark, path)
        rows = self.store.rows("rows", df)
        self.labelled = ml.indexed_target(rows, target)
        train = self.labelled.filter(F.col(split) == "train")
        self.columns, self.preparation = self.store.prepared(self.labelled, train, target, [split, *ignore])
        self.width = len(ml.slot_names(self.preparation, self.columns))
        fold = F.pmod(F.xxhash64(*rows.columns, F.lit(seed)), F.lit(preset.folds)).cast("int")
        ready = self.preparation.transform(self.labelled).select(split, "label", "features", fold.alias("fold"))
        # Stored, not cached: a few cached blocks lie on one or two executors, and the tasks of all fits would queue there. Each fit
        # keeps its own working copy wherever its first task runs.
        self.ready = self.store.rows(f"ready-{preset.folds}-{seed}", ready)
        self.failed: dict[str, str] = {}
        self.done: dict[str, tuple] = {}
        self.choices = {
            name: {
                json.dumps(c, sort_keys=True): c
                for c in ml.drawn(preset.grids[name], preset.draws if name != "logistic_regression" else None, seed)
            }
            for name in ml.MODEL_ORDER
            if name in preset.grids
        }
        self._asked: list[Cell] = []
        self._together = {m for m, c in self.choices.items() if passes.Passes.takes(m, list(c.values()))}
        # Boosted trees take many short steps, the others few long ones: they go side by side, each with its share of the cores.
        short, long = threading.Lock(), threading.Lock()
        self._turn = {m: short if m == "gradient_boosting" else long for m in self._together}
        self._whole: dict[tuple[str, str], Callable] = {}

    def cells(self) -> list[Cell]:
        """All fits that the preset asks for, folds of one choice together."""
        return [
            Cell(m, text, k, _key(m, text, k, self.preset.folds, self.preset.iterations, self.seed))
            for m, choices in self.choices.items()
            for text in choices
            for k in range(self.preset.folds)
        ]

    def missing(self) -> list[Cell]:
        known = {r["cell"] for r in self.store.cells().select("cell").collect()}
        return [c for c in self.cells() if c.key not in known]

    @cached_property
    def _train(self) -> DataFrame:
        return self.ready.filter(F.col(self.split) == "train")

    @cached_property
    def _rows_by_fold(self) -> dict[int, int]:
        return {r["fold"]: r["count"] for r in self._train.groupBy("fold").count().collect()}

    def _begun(self) -> None:
        """What all threads need, worked out once before them."""
        _ = self._rows_by_fold
        if any(c.model in self._together for c in self._asked):
            try:
                _ = self._passes
            except Exception:  # noqa: BLE001 - each model records it as its own failure
                logger.exception("rows could not be packed")

    @cached_property
    def _passes(self) -> passes.Passes:
        rows, n = self._train.select("label", "features", "fold"), sum(self._rows_by_fold.values())
        blocks = passes.packed(rows, n, self.spark.sparkContext.defaultParallelism)
        blocks = self.store.rows(f"blocks-{self.preset.folds}-{self.seed}", blocks)
        return passes.Passes(rows, blocks, self.width, self._rows_by_fold, self.seed, len({*map(id, self._turn.values())}))

    def _chosen(self, name: str, params: str, n: int):
        estimator = ml.estimator(name, self.preset.iterations, self.seed)
        return estimator.copy(ml.param_map(name, estimator, self.choices[name][params], n, self.width))

    def _fit(self, name: str, params: str, rows: DataFrame, n: int):
        return self._chosen(name, params, n).fit(rows)

    def _put_cell(self, cell: Cell, auc: float, accuracy: float, seconds: float) -> None:
        self.store.put("cells", "cell", cell.key, (cell.model, cell.params, cell.fold, auc, accuracy, seconds), SearchStore.CELLS)

    def _train_together(self, name: str) -> None:
        """All cells of a model that are asked for, in the same passes; whoever comes second finds them known.

        Models with many short steps are fitted on all train rows beside them, whichever choice wins: a row of steps costs more than its sums.
        """
        with self._turn[name]:
            asked = [c for c in self._asked if c.model == name]
            if not asked or name in self.failed:
                return
            started, folds = time.time(), [c.fold for c in asked]
            try:
                whole = list(self.choices[name]) if name != "random_forest" and asked == [c for c in self.cells() if c.model == name] else []
                n = sum(self._rows_by_fold.values())
                chosen = [self._chosen(name, p, n) for p in [*[c.params for c in asked], *whole]]
                judged, made = self._passes.judged(name, chosen, folds + [passes.EVERYONE] * len(whole))
                self._whole |= {(name, p): partial(made, len(asked) + i) for i, p in enumerate(whole)}
                seconds = (time.time() - started) / len(chosen)
                with ThreadPoolExecutor(self.preset.parallelism) as pool:
                    list(pool.map(lambda c, j: self._put_cell(c, *j, seconds), asked, judged[: len(asked)]))
            except Exception as problem:
                self.failed[name] = str(problem)
                raise
            self._asked = [c for c in self._asked if c.model != name]

    def _train_cell(self, cell: Cell) -> None:
        if cell.model in self.failed:
            return
        try:
            if cell.model in self._together:
                return self._train_together(cell.model)
            started = time.time()
            n = sum(c for k, c in self._rows_by_fold.items() if k != cell.fold)
            model = self._fit(cell.model, cell.params, self._train.filter(F.col("fold") != cell.fold), n)
            judged = model.transform(self._train.filter(F.col("fold") == cell.fold))
            auc = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(judged)
            accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(judged)
            self._put_cell(cell, auc, accuracy, time.time() - started)
        except Exception as problem:  # noqa: BLE001 - one model must not stop the comparison
            logger.exception("training of %s failed", cell.model)
            self.failed[cell.model] = str(problem)

    def advance(self, most: int | None = None, seconds: float | None = None) -> int:
        """Train missing cells, at most ``most`` and starting none after ``seconds``; the number still missing."""
        todo, ends = self.missing()[:most], time.time() + (seconds or float("inf"))
        self._asked = list(todo)
        if todo:
            self._begun()
            with ThreadPoolExecutor(self.preset.parallelism) as pool:
                list(pool.map(lambda c: self._train_cell(c) if time.time() < ends else None, todo))
        return sum(c.model not in self.failed for c in self.missing())

    def finish(self) -> ml.TrainingResult:
        """Train whatever is missing and return the comparison. Models that go through the rows in passes have all their cells in flight. Those
        that Spark fits one by one run two at a time beside them, more afterwards. What is left to do for a model once its own cells are known
        is done beside the cells of the others."""
        left = {name: 0 for name in self.choices}
        self._asked = self.missing()
        todo = deque(sorted(self._asked, key=lambda c: c.model not in self._together))
        most = self.preset.parallelism
        alone = lambda: [m for m in running.values() if m not in self._together]
        room = lambda: min(most, 2) if len(alone()) < len(running) else most
        for cell in todo:
            left[cell.model] += 1
        waiting = sum(n for name, n in left.items() if name in self._together)
        self._begun()
        with ThreadPoolExecutor(most + waiting) as pool, ThreadPoolExecutor(len(left) or 1) as last:
            running = {}
            finals = [last.submit(self._try_finish, name) for name, n in left.items() if not n]
            while todo or running:
                while todo and (todo[0].model in self._together or len(alone()) < room()):
                    asked = todo.popleft()
                    running[pool.submit(self._train_cell, asked)] = asked.model
                for cell in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(cell)
                    left[name] -= 1
                    if not left[name] and name not in self.failed:
                        finals.append(last.submit(self._try_finish, name))
            wait(finals)
        return self.result()

    def _scored(self) -> dict[str, list]:
        """Known cells of this preset by model."""
        asked = {c.key for c in self.cells()}
        scored: dict[str, list] = {}
        for r in self.store.cells().collect():
            if r["cell"] in asked:
                scored.setdefault(r["model"], []).append(r)
        return scored

    def _try_finish(self, name: str) -> None:
        try:
            self.done[name] = self._finished(name, self._scored()[name])
        except Exception as problem:  # noqa: BLE001
            logger.exception("training of %s failed", name)
            self.failed[name] = str(problem)

    def _finished(self, name: str, scored: list) -> tuple[object, dict]:
        """The best choice fitted on all train rows, with its metrics; read from the store if it is there."""
        by_choice = {}
        for r in scored:
            by_choice.setdefault(r["params"], []).append(r)
        order = list(self.choices[name])
        best = max(order, key=lambda p: (fmean(r["auc"] for r in by_choice[p]), -order.index(p)))
        key = _key(name, best, sorted(order), self.preset.folds, self.preset.iterations, self.seed)
        path = f"{self.store.path}/models/{name}-{key}"
        stored = self.store.runs().filter(F.col("run") == key).first()
        if stored:
            return PipelineModel.load(path).stages[0], {"model": name, "params": best, "error": None, "metrics": dict(stored["metrics"])}
        started = time.time()
        n = sum(self._rows_by_fold.values())
        if (name, best) in self._whole:
            model = self._whole[name, best]()
        elif name in self._together:
            with self._turn[name]:
                model = self._passes.model(name, self._chosen(name, best, n))
        else:
            model = self._fit(name, best, self._train, n)
        metrics = ml.evaluated(model, self.ready.filter(F.col(self.split) != "test"), self.split)
        accuracies = [r["accuracy"] for r in by_choice[best]]
        spent = sum(r["seconds"] for r in scored) + time.time() - started
        metrics |= {"cv_mean": fmean(accuracies), "cv_std": pstdev(accuracies), "training_time": spent}
        metrics = {k: None if v is None else float(v) for k, v in metrics.items()}
        PipelineModel(stages=[model]).write().overwrite().save(path)
        self.store.put("runs", "run", key, (name, best, metrics), SearchStore.RUNS)
        return model, {"model": name, "params": best, "error": None, "metrics": metrics}

    def result(self) -> ml.TrainingResult:
        """The comparison of all models; raises while cells of a model that did not fail are missing.

        The winner has the highest validation accuracy, the earlier model on a tie.
        """
        scored = self._scored()
        models, runs, best, best_accuracy = {}, [], None, 0.0
        for name, choices in self.choices.items():
            if name not in self.failed and name not in self.done:
                gap = len(choices) * self.preset.folds - len(scored.get(name, []))
                if gap:
                    raise ValueError(f"search unfinished: {gap} cells of {name} are missing")
                self._try_finish(name)
            if name not in self.failed:
                models[name], run = self.done[name]
                runs.append(run)
                accuracy = run["metrics"]["val_accuracy"]
                if accuracy is not None and accuracy > best_accuracy:
                    best, best_accuracy = name, accuracy
            else:
                runs.append({"model": name, "params": None, "error": self.failed[name], "metrics": {}})
        test = self.preparation.transform(self.labelled.filter(F.col(self.split) == "test"))
        return ml.TrainingResult(self.columns, self.preparation, models, runs, best, test)

    def close(self) -> None:
        """Nothing is held between fits: rows, cells and models are all in the store."""


def train_and_compare(
    df: DataFrame,
    target: str,
    preset: ml.Preset,
    path: str,
    split: str = "split",
    ignore: Sequence[str] = (),
    seed: int = config.SPLIT_SEED,
) -> ml.TrainingResult:
    """A whole search in one call. A model that fails is recorded with its error and the others go on."""
    search = Search(df, target, preset, path, split, ignore, seed)
    try:
        return search.finish()
    finally:
        search.close()
