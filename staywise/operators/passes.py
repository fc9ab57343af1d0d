"""Many fits in the same passes over the rows: boosted trees, forests and networks of all folds and choices step forward together.

Spark's own estimators run one row of jobs per fit and read the rows once per fit and step. Here a step reads the rows once for all fits: a
task turns a stored block of rows into histograms (trees) or gradients (networks), these are added up by key, splits are picked where they
were added up, and the driver only keeps the models. What is learned follows Spark's estimators: 32 bins, Gini or variance, logistic loss with
leaf means, Poisson bootstrap, gradient descent on whole data. Differences: networks compute in single precision and add up in double; split candidates come from all train rows instead of a sample of
10,000; random choices depend on seed, tree and stored block, so the trees of a smaller forest are the first ones of a larger one; the variance
stored in nodes of boosted trees is 0. Results are Spark's own model classes.
"""

from __future__ import annotations

import json
import math
import threading
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, MultilayerPerceptronClassifier, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.operators import metrics
from staywise.session import fresh_path, work_folder, written

BINS = 32
BLOCK_ROWS, LEAST_ROWS = 1 << 16, 1 << 13
DEEPEST = 12  # trees are kept as whole binary trees
STEP_BYTES = 1 << 26  # histograms that one task makes in one pass
CHUNK = 1 << 13  # rows at a time, so that they stay in the processor's cache
EVERYONE = -1  # the fold of a fit on all rows
FEW = 32  # blocks whose small sums the driver adds up itself: half the jobs' time is that of a second stage

BLOCKS = "block long, labels binary, folds binary, features binary"


# ---- rows ------------------------------------------------------------------------------------------------


def packed(ready: DataFrame, rows: int, cores: int) -> DataFrame:
    """(label, features, fold) rows as blocks of numpy bytes, one row each."""
    parts = max(math.ceil(rows / BLOCK_ROWS), min(cores, math.ceil(rows / LEAST_ROWS)), 1)
    plain = ready.select("label", vector_to_array("features").alias("features"), "fold").repartition(parts)
    return plain.mapInArrow(_pack, BLOCKS)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count, number = [], 0, 0

    def block():
        label, fold, values = (
            np.concatenate([x.to_numpy(zero_copy_only=False) for x in columns])
            for columns in ([b.column(0) for b in held], [b.column(2) for b in held], [b.column(1).flatten() for b in held])
        )
        if not np.isin(label, (0.0, 1.0)).all():
            raise ValueError("labels are not 0 and 1")
        stored = [label.astype(np.uint8), fold.astype(np.int32), values.astype(np.float64)]
        return pa.RecordBatch.from_arrays(
            [pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in stored]],
            ["block", "labels", "folds", "features"],
        )

    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= BLOCK_ROWS:
            yield block()
            held, count, number = [], 0, number + 1
    if count:
        yield block()


@dataclass
class Block:
    number: int
    labels: np.ndarray
    folds: np.ndarray
    values: np.ndarray  # rows x features, or features x rows once binned


def _block(row) -> Block:
    labels = np.frombuffer(row["labels"], np.uint8)
    return Block(
        row["block"], labels, np.frombuffer(row["folds"], np.int32), np.frombuffer(row["features"], np.float64).reshape(len(labels), -1)
    )


def candidates(blocks: RDD, ready: DataFrame, width: int) -> list[np.ndarray]:
    """Split candidates of each feature: the middles between its values if there are at most 32, otherwise 31 of its quantiles."""

    def values(b: Block):
        return [np.unique(b.values[:, j])[: BINS + 1] for j in range(width)]

    few = blocks.map(values).treeReduce(lambda a, b: [np.unique(np.concatenate(x))[: BINS + 1] for x in zip(a, b, strict=True)])
    many = [j for j in range(width) if len(few[j]) > BINS]
    result = [(v[1:] + v[:-1]) / 2 for v in few]
    if many:
        columns = ready.select(*[vector_to_array("features")[j].alias(f"f{j}") for j in many])
        shares = [k / 512 for k in range(513)]
        for j, found in zip(many, columns.approxQuantile(columns.columns, shares, 0.0005), strict=True):
            v = np.unique(found)[:-1]
            result[j] = v if len(v) < BINS else v[np.linspace(0, len(v) - 1, BINS + 1).round().astype(int)[1:-1]]
    return result


def _binned(b: Block, cuts: list[np.ndarray]) -> Block:
    bins = np.stack([np.searchsorted(c, b.values[:, j]).astype(np.uint8) for j, c in enumerate(cuts)])
    return Block(b.number, b.labels, b.folds, bins)


# ---- trees -----------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """A whole binary tree by level: a node that does not split sends its rows to the left child, which keeps its figures."""

    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    split: np.ndarray
    stats: np.ndarray  # of every node, the last level included: class weights, or weight and sum

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << depth) - 1
        return cls(np.zeros(n, np.int64), np.full(n, 255, np.uint8), np.zeros(n), np.zeros(n, bool), np.zeros((2 * n + 1, 2)))

    def grown(self, level: int, found: tuple) -> None:
        lo, n = (1 << level) - 1, 1 << level
        feature, cut, gain, split, left, total = found
        if level == 0:
            self.stats[0] = total[0]
        else:  # a leaf's rows come down to its left child and stay there
            split = split & np.repeat(self.split[(lo - 1) // 2 : lo], 2)
        at, kids = slice(lo, lo + n), slice(2 * lo + 1, 2 * lo + 1 + 2 * n)
        self.feature[at], self.bin[at], self.split[at] = np.where(split, feature, 0), np.where(split, cut, 255), split
        self.gain[at] = np.where(split, gain, 0.0)
        down = np.where(split[:, None], left, self.stats[at])
        self.stats[kids] = np.stack([down, self.stats[at] - down], 1).reshape(2 * n, 2)

    def open_at(self, level: int) -> bool:
        """Whether a level has nodes of its own."""
        return not level or bool(self.split[(1 << (level - 1)) - 1 : (1 << level) - 1].any())

    def values(self, of: int, among: slice) -> np.ndarray:
        """Of the nodes of the last level, a figure divided by the sum of others."""
        for level in range(int(math.log2(len(self.feature) + 1))):
            if not self.open_at(level):  # not grown: the figures above go down the left children
                lo, n = (1 << level) - 1, 1 << level
                self.stats[2 * lo + 1 : 2 * lo + 1 + 2 * n : 2] = self.stats[lo : lo + n]
        last = self.stats[len(self.feature) :]
        return last[:, of] / np.maximum(last[:, among].sum(1), 1e-300)

    def routes(self, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(self.feature[(1 << d) - 1 : (2 << d) - 1], self.bin[(1 << d) - 1 : (2 << d) - 1]) for d in range(levels)]


def _placed(routes: list, flat: np.ndarray, rows: int) -> np.ndarray:
    """The node of each row below the given levels; ``flat`` has the bins feature by feature."""
    result = np.zeros(rows, np.int64)
    for lo in range(0, rows, CHUNK):
        at = np.arange(lo, min(lo + CHUNK, rows))
        node = np.zeros(len(at), np.int64)
        for feature, cut in routes:
            here = flat.take(feature.take(node) * rows + at) > cut.take(node)
            node += node
            node += here
        result[lo : lo + len(at)] = node
    return result


def _subset(strategy: str, trees: int, width: int) -> int:
    """How many features a node looks at."""
    if strategy == "auto":
        strategy = "sqrt" if trees > 1 else "all"
    named = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}
    if strategy in named:
        return named[strategy]
    return max(1, min(width, int(strategy) if strategy.isdigit() else math.ceil(float(strategy) * width)))


def _looked_at(seed: int, tree: int, level: int, size: int, width: int) -> np.ndarray:
    """Features that the nodes of a level look at."""
    if size == width:
        return np.tile(np.arange(width), (1 << level, 1))
    return np.random.default_rng([seed, tree, level]).random((1 << level, width)).argsort(1)[:, :size]


def _summed(bins: np.ndarray, node: np.ndarray, looked: np.ndarray, weights: list[np.ndarray | None]) -> np.ndarray:
    """Sums per (figure, looked-at feature, node, bin)."""
    n, size, rows = looked.shape[0], looked.shape[1], len(node)
    result, flat, at = np.empty((len(weights), size, n, BINS)), bins.ravel(), np.arange(rows)
    base, same = node * BINS, bool((looked == looked[0]).all())
    for s in range(size):
        column = bins[looked[0, s]] if same else flat.take((looked[:, s] * rows).take(node) + at)
        index = base + column
        for k, w in enumerate(weights):
            result[k, s] = np.bincount(index, w, minlength=n * BINS).reshape(n, BINS)
    return result


def _picked(sums: np.ndarray, looked: np.ndarray, least: int, gini: bool) -> tuple:
    """The best split of every node: feature, bin, gain, whether it is one, figures of the left side and of the node."""
    left = sums.astype(np.float64).cumsum(-1)
    total = left[..., -1:]
    right = total - left
    if gini:  # figures are the weights of the two classes
        wl, wr, w = left.sum(0), right.sum(0), total.sum(0)
        score = lambda x, n: (x * x).sum(0) / np.maximum(n, 1e-300)
    else:  # weight and sum
        wl, wr, w = left[0], right[0], total[0]
        score = lambda x, n: x[1] * x[1] / np.maximum(n, 1e-300)
    gain = (score(left, wl) + score(right, wr) - score(total, w)) / np.maximum(w, 1e-300)
    gain[(wl < least) | (wr < least)] = -1.0
    by_node = gain.transpose(1, 0, 2).reshape(looked.shape[0], -1)
    best, nodes = by_node.argmax(1), np.arange(looked.shape[0])
    s, cut = best // BINS, best % BINS
    most = by_node[nodes, best]
    return looked[nodes, s], cut, most, most > 1e-12, left[:, s, nodes, cut].T, total[:, 0, :, 0].T


def _small(sums: np.ndarray) -> np.ndarray:
    """Whole counts in as few bytes as they need."""
    return sums.astype(np.uint16 if sums.max(initial=0) < 1 << 16 else np.uint32)


@dataclass(frozen=True)
class Forest:
    """Trees on the rows outside a fold; ``trees`` is the largest number that a choice asks for."""

    fold: int
    trees: int
    depth: int
    least: int
    looks: int  # features that a node looks at


def _forest_weights(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    return np.random.default_rng([seed, tree, block]).poisson(1.0, rows)


def grow_forests(binned: RDD, forests: list[Forest], width: int, seed: int, parts: int) -> list[list[Tree]]:
    """All trees of all forests, level by level."""
    grown = [[Tree.empty(f.depth) for _ in range(f.trees)] for f in forests]
    for level in range(max(f.depth for f in forests)):
        items = [(t, k) for k, f in enumerate(forests) if level < f.depth for t in range(f.trees) if grown[k][t].open_at(level)]
        items.sort(key=lambda x: (x[0], forests[x[1]].fold))  # one draw for all fits of a tree, one selection for all of a fold
        step = max(1, STEP_BYTES // ((1 << level) * max(f.looks for f in forests) * BINS * 4))
        for lo in range(0, len(items), step):
            part = [(t, k, grown[k][t].routes(level)) for t, k in items[lo : lo + step]]

            def sums(b: Block, part=part, level=level):
                drawn, weights, fold = None, None, None
                rows_of = {}
                for t, k, routes in part:
                    f = forests[k]
                    if t != drawn:
                        drawn, weights, rows_of = t, _forest_weights(seed, t, b.number, len(b.labels)), {}
                    if f.fold not in rows_of:
                        at = np.flatnonzero((b.folds != f.fold) & (weights > 0))
                        w = weights[at].astype(np.float64)
                        one = w * b.labels[at]
                        rows_of = {f.fold: (b.values.take(at, 1), [w - one, one])}
                    bins, both = rows_of[f.fold]
                    looked = _looked_at(seed, t, level, f.looks, width)
                    yield (t, k), _small(_summed(bins, _placed(routes, bins.ravel(), bins.shape[1]), looked, both))

            pick = lambda x, level=level: (
                x[0],
                _picked(x[1], _looked_at(seed, x[0][0], level, forests[x[0][1]].looks, width), forests[x[0][1]].least, True),
            )
            added = binned.flatMap(sums).reduceByKey(_added, min(parts, len(part)))
            for (t, k), found in added.map(pick).collect():
                grown[k][t].grown(level, found)
    return grown


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.add(a, b, dtype=np.float64 if a.dtype.kind == "f" or b.dtype.kind == "f" else np.uint32)


def _class_one(tree: Tree) -> tuple[list, np.ndarray]:
    """Routes and the share of class 1 in each node below them."""
    return tree.routes(int(math.log2(len(tree.feature) + 1))), tree.values(1, slice(0, 2))


@dataclass(frozen=True)
class Boosted:
    fold: int
    trees: int
    depth: int
    least: int
    looks: int
    share: float
    rate: float


def grow_boosted(binned: RDD, cells: list[Boosted], width: int, seed: int, parts: int, every: int = 20) -> tuple[list[list[Tree]], RDD]:
    """The trees of every cell, one tree after the other for all cells, and blocks with the margins that they add up to."""
    grown: list[list[Tree]] = [[] for _ in cells]
    state = binned.map(lambda b: (b, np.zeros((len(cells), len(b.labels)))))
    held, last, stored = None, [], []
    for m in range(max(c.trees for c in cells) + 1):
        moves = [
            (k, grown[k][-1].routes(cells[k].depth), (1.0 if m == 1 else cells[k].rate) * grown[k][-1].values(1, slice(0, 1))) for k in last
        ]

        def moved(x, moves=moves):
            b, margins = x
            margins, flat = margins.copy(), b.values.ravel()
            for k, routes, value in moves:
                margins[k] += value.take(_placed(routes, flat, len(b.labels)))
            return b, margins

        if moves:
            state = state.map(moved)
        state.persist(StorageLevel.MEMORY_AND_DISK)
        if m and m % every == 0:
            state.checkpoint()  # else every task carries all trees so far
            stored.append(state)
        last = [k for k, c in enumerate(cells) if m < c.trees]
        for k in last:
            grown[k].append(Tree.empty(cells[k].depth))
        for level in range(max((cells[k].depth for k in last), default=0)):
            part = [(k, grown[k][-1].routes(level)) for k in last if level < cells[k].depth and grown[k][-1].open_at(level)]
            if not part:
                break

            def sums(x, part=part, level=level, m=m):
                b, margins = x
                sign, drawn = 2.0 * b.labels - 1.0, np.random.default_rng([seed, m, b.number]).random(len(b.labels))
                rows_of = {}
                for k, routes in part:
                    c = cells[k]
                    if (c.fold, c.share) not in rows_of:
                        at = np.flatnonzero((b.folds != c.fold) & (drawn < c.share))
                        rows_of[c.fold, c.share] = at, b.values.take(at, 1), sign[at]
                    at, bins, y = rows_of[c.fold, c.share]
                    target = y if m == 0 else 4.0 * y / (1.0 + np.exp(np.minimum(2.0 * y * margins[k].take(at), 700.0)))
                    node = _placed(routes, bins.ravel(), len(at))
                    yield k, _summed(bins, node, _looked_at(seed, m, level, c.looks, width), [None, target])

            pick = lambda x, level=level, m=m: (
                x[0],
                _picked(x[1], _looked_at(seed, m, level, cells[x[0]].looks, width), cells[x[0]].least, False),
            )
            for k, found in _by_key(state.flatMap(sums), pick, min(parts, len(part))):
                grown[k][-1].grown(level, found)
        if last:
            if held is not None:
                held.unpersist()
            held = state
            if len(stored) > 1 and state is stored[-1]:
                _removed(stored.pop(0))
    return grown, state


def _by_key(pairs: RDD, then: Callable, parts: int) -> list:
    """Arrays added up by key, and what becomes of each sum."""
    if pairs.getNumPartitions() > FEW:
        return pairs.reduceByKey(_added, parts).map(then).collect()
    sums: dict = {}
    for key, value in pairs.collect():
        sums[key] = _added(sums[key], value) if key in sums else value
    return [then(x) for x in sums.items()]


def _removed(rdd: RDD) -> None:
    """Deletes the stored form of rows that a later one replaces."""
    if at := rdd.getCheckpointFile():
        folder = rdd.ctx._jvm.org.apache.hadoop.fs.Path(at)
        folder.getFileSystem(rdd.ctx._jsc.hadoopConfiguration()).delete(folder, True)


# ---- networks --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    fold: int
    layers: tuple[int, ...]
    rate: float
    iterations: int
    tolerance: float


def _single(b: Block) -> Block:
    return Block(b.number, b.labels, b.folds, b.values.astype(np.float32))


def _matrices(weights: np.ndarray, layers: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of each layer's matrix (inputs x outputs) and its offsets, in the order of Spark's weight vector."""
    result, at = [], 0
    for a, b in zip(layers, layers[1:], strict=False):
        result.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return result


def _activations(x: np.ndarray, matrices: list) -> list[np.ndarray]:
    values = [x]
    for k, (w, offset) in enumerate(matrices):
        z = values[-1] @ w
        z += offset
        if k < len(matrices) - 1:
            np.negative(z, z)
            np.exp(z, z)
            z += 1
            np.reciprocal(z, z)
        else:
            z -= z.max(1, keepdims=True)
            np.exp(z, z)
            z /= z.sum(1, keepdims=True)
        values.append(z)
    return values


def _slope(x: np.ndarray, labels: np.ndarray, weights: np.ndarray, layers: tuple[int, ...]) -> np.ndarray:
    """Sum of the cross entropy's gradients over the rows."""
    result, step = np.zeros_like(weights), max(64, CHUNK * 4 // max(layers))
    matrices, sums = _matrices(weights.astype(x.dtype), layers), _matrices(result, layers)
    for lo in range(0, len(x), step):
        values = _activations(x[lo : lo + step], matrices)
        delta = values.pop()
        delta[np.arange(len(delta)), labels[lo : lo + step]] -= 1
        for k in range(len(matrices) - 1, -1, -1):
            a = values[k]
            sums[k][0][:] += a.T @ delta
            sums[k][1][:] += delta.sum(0)
            if k:
                delta = delta @ matrices[k][0].T
                delta *= a
                delta *= 1 - a
    return result


def descend(blocks: RDD, cells: list[Network], starts: list[np.ndarray], rows_by_fold: dict[int, int]) -> list[np.ndarray]:
    """Gradient descent of all networks, one pass over the rows per step."""
    weights, moving = [s.copy() for s in starts], set(range(len(cells)))
    counts = [sum(n for fold, n in rows_by_fold.items() if fold != c.fold) for c in cells]
    for i in range(1, max(c.iterations for c in cells) + 1):
        part = [(k, weights[k]) for k in sorted(moving)]
        if not part:
            break

        def slopes(b: Block, part=part):
            rows_of, result = {}, {}
            for k, w in part:
                fold = cells[k].fold
                if fold not in rows_of:
                    rows_of = {fold: (b.values[b.folds != fold], b.labels[b.folds != fold])}
                result[k] = _slope(*rows_of[fold], w, cells[k].layers)
            return result

        each, add = blocks.map(slopes), lambda a, b: {k: a[k] + b[k] for k in a}
        total = each.reduce(add) if each.getNumPartitions() <= FEW else each.treeReduce(add)
        for k, slope in total.items():
            before = weights[k]
            weights[k] = before - cells[k].rate * slope / counts[k]
            change, length = np.linalg.norm(weights[k] - before), np.linalg.norm(weights[k])
            if i >= cells[k].iterations or (i > 1 and change < cells[k].tolerance * max(length, 1.0)):
                moving.discard(k)
    return weights


# ---- judging ---------------------------------------------------------------------------------------------


def _judged(spark: SparkSession, scored: RDD) -> dict[int, tuple[float, float]]:
    """Exact AUC and accuracy by cell from (cell, labels, probabilities of class 1) with numpy bytes."""

    def unpacked(batches):
        for batch in batches:
            for r in batch.to_pylist():
                p = np.frombuffer(r["p"], np.float64)
                y = np.frombuffer(r["y"], np.uint8).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), r["cell"], np.int32)), pa.array(y), pa.array((p > 0.5).astype(np.int32)), pa.array(p)],
                    ["cell", "label", "prediction", "probability"],
                )

    rows = spark.createDataFrame(scored, "cell int, y binary, p binary")
    rows = written(rows.mapInArrow(unpacked, "cell int, label int, prediction int, probability double"), "judged")
    right = {r["cell"]: r["right"] for r in rows.groupBy("cell").agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("right")).collect()}
    # Without one of the classes the area is 0, as Spark's evaluator has it.
    return {r["cell"]: (r["auc"] or 0.0, right[r["cell"]]) for r in metrics.roc_auc(rows, ["cell"]).collect()}


# ---- Spark's models --------------------------------------------------------------------------------------


def _nodes(number: int, tree: Tree, gini: bool) -> list[tuple]:
    """Rows of a tree as Spark's models store them, parents before children."""
    rows: list = []

    def add(at: int) -> int:
        here = len(rows)
        rows.append(None)
        a, b = map(float, tree.stats[at])
        count = a + b if gini else a
        if gini:
            stats, value, impurity = [a, b], float(b > a), 1.0 - (a * a + b * b) / max(count * count, 1e-300)
        else:
            value = b / max(a, 1e-300)
            stats, impurity = [a, b, b * value], 0.0
        if at < len(tree.split) and tree.split[at]:
            kids = add(2 * at + 1), add(2 * at + 2)
            split = (int(tree.feature[at]), int(tree.bin[at]))
            rows[here] = (number, here, value, impurity, stats, round(count), float(tree.gain[at]), *kids, split)
        else:
            rows[here] = (number, here, value, impurity, stats, round(count), -1.0, -1, -1, None)
        return here

    add(0)
    return rows


def spark_trees(spark: SparkSession, estimator, trees: list[Tree], rates: list[float], cuts: list[np.ndarray], gini: bool):
    """Grown trees as Spark's model class, by way of its stored form: a model fitted on four rows gives the frame, the trees are put in."""
    frame = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i)] * len(cuts))) for i in range(4)], ["label", "features"])
    params = {estimator.getParam("maxDepth"): 1, estimator.getParam("numTrees" if gini else "maxIter"): 1}
    model, path = estimator.fit(frame.coalesce(1), params), fresh_path(spark, "trees")
    model.write().save(f"{path}-frame")
    rows = []
    for i, tree in enumerate(trees):
        for tree_id, node, value, impurity, stats, count, gain, left, right, split in _nodes(i, tree, gini):
            cut = (split[0], [float(cuts[split[0]][split[1]])], -1) if split else (-1, [], -1)
            rows.append((tree_id, (node, value, impurity, stats, count, gain, left, right, cut)))
    schema = spark.read.parquet(f"{path}-frame/data").schema
    about = json.loads(spark.read.text(f"{path}-frame/metadata").first()["value"])
    about["paramMap"] |= {p.name: v for p, v in estimator.extractParamMap().items() if estimator.isSet(p)}
    about["paramMap"].pop("numTrees" if gini else "maxIter", None)
    about["paramMap"]["numTrees" if gini else "maxIter"] = len(trees)
    about["numTrees"] = len(trees)
    one = spark.read.parquet(f"{path}-frame/treesMetadata")
    id_, text, weight = one.columns
    first = json.loads(one.first()[text])
    first["paramMap"]["maxDepth"] = about["paramMap"].get("maxDepth", about["defaultParamMap"]["maxDepth"])
    kept = [(i, json.dumps(first | {"uid": f"{first['uid']}_{i}"}), float(r)) for i, r in enumerate(rates)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/data")
    spark.createDataFrame(kept, one.schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return (RandomForestClassificationModel if gini else GBTClassificationModel).load(path)


def spark_network(spark: SparkSession, cell: Network, weights: np.ndarray, seed: int):
    """Weights as Spark's model class: a fit of no steps that starts at them."""
    model = _start(spark, cell, seed, weights)
    return model._set(maxIter=cell.iterations, stepSize=cell.rate)


def _start(spark: SparkSession, cell: Network, seed: int, weights: np.ndarray | None = None):
    rows = spark.createDataFrame([(float(i), Vectors.dense([0.0] * cell.layers[0])) for i in range(2)], ["label", "features"])
    estimator = MultilayerPerceptronClassifier(seed=seed, maxIter=0, layers=list(cell.layers), solver="gd")
    return estimator.fit(rows, {estimator.initialWeights: Vectors.dense(weights)} if weights is not None else {})


# ---- what the search asks for ----------------------------------------------------------------------------


class Passes:
    """Fits of one training table. ``ready`` has (label, features, fold) of the train rows, ``blocks`` the same as ``packed``."""

    def __init__(self, ready: DataFrame, blocks: DataFrame, width: int, rows_by_fold: dict[int, int], seed: int, lanes: int = 1):
        self.spark, self.width, self.rows_by_fold, self.seed = ready.sparkSession, width, rows_by_fold, seed
        self.ready = ready
        # A task in Python costs more than the sums of one block, and another model takes the other cores.
        self.parts = math.ceil(self.spark.sparkContext.defaultParallelism / lanes)
        self.blocks = blocks.rdd.coalesce(max(self.parts, blocks.rdd.getNumPartitions() // FEW)).map(_block)
        self._begin = threading.Lock()
        work_folder(self.spark)  # where margins are stored now and then
        self._cuts: list[np.ndarray] | None = None

    @staticmethod
    def takes(name: str, choices: list[dict]) -> bool:
        """Whether these fits can go together; others are left to Spark's estimators."""
        return name == "neural_network" or (
            name in ("gradient_boosting", "random_forest") and all(c.get("maxDepth", 5) <= DEEPEST for c in choices)
        )

    def cuts(self) -> list[np.ndarray]:
        with self._begin:
            if self._cuts is None:
                self._cuts = candidates(self.blocks, self.ready, self.width)
        return self._cuts

    def _binned(self) -> RDD:
        cuts = self.cuts()
        return self.blocks.map(lambda b: _binned(b, cuts)).persist(StorageLevel.MEMORY_AND_DISK)

    def judged(self, name: str, estimators: list, folds: list[int]) -> tuple[list, Callable]:
        """Exact AUC and accuracy on each estimator's fold, trained on the rows of the others, or None if that fold is ``EVERYONE``;
        and what makes the model of such an estimator by its place."""
        made, scored, held = getattr(self, f"_{name}")(estimators, folds)
        found = _judged(self.spark, scored) if any(k != EVERYONE for k in folds) else {}
        for rdd in held:
            rdd.unpersist()
        return [found[i] if k != EVERYONE else None for i, k in enumerate(folds)], made

    def model(self, name: str, estimator):
        """An estimator fitted on all rows."""
        return self.judged(name, [estimator], [EVERYONE])[1](0)

    def _gradient_boosting(self, estimators: list, folds: list[int]):
        cells = [
            Boosted(
                k,
                e.getMaxIter(),
                e.getMaxDepth(),
                e.getMinInstancesPerNode(),
                _subset(e.getFeatureSubsetStrategy(), 1, self.width),
                e.getSubsamplingRate(),
                e.getStepSize(),
            )
            for e, k in zip(estimators, folds, strict=True)
        ]
        binned = self._binned()
        trees, state = grow_boosted(binned, cells, self.width, self.seed, self.parts)

        def scores(x):
            b, margins = x
            for k, c in enumerate(cells):
                at = b.folds == c.fold
                if at.any():
                    yield k, b.labels[at].tobytes(), (1.0 / (1.0 + np.exp(np.maximum(-2.0 * margins[k, at], -700.0)))).tobytes()

        made = lambda i: spark_trees(
            self.spark, estimators[i], trees[i], [1.0] + [cells[i].rate] * (cells[i].trees - 1), self.cuts(), False
        )
        return made, state.flatMap(scores), [binned, state]

    def _random_forest(self, estimators: list, folds: list[int]):
        kinds: dict[tuple, list[int]] = {}
        for i, (e, k) in enumerate(zip(estimators, folds, strict=True)):
            looks = _subset(e.getFeatureSubsetStrategy(), e.getNumTrees(), self.width)
            kinds.setdefault((k, e.getMaxDepth(), e.getMinInstancesPerNode(), looks), []).append(i)
        forests = [
            Forest(fold, max(estimators[i].getNumTrees() for i in same), *rest) for (fold, *rest), same in kinds.items()
        ]
        binned = self._binned()
        trees = grow_forests(binned, forests, self.width, self.seed, self.parts)
        asked = [{i: estimators[i].getNumTrees() for i in same} for same in kinds.values()]
        judges = [[_class_one(t) for t in own] if f.fold != EVERYONE else [] for f, own in zip(forests, trees, strict=True)]
        ready = self.spark.sparkContext.broadcast(judges)

        def scores(b: Block):
            for f, own, wanted in zip(forests, ready.value, asked, strict=True):
                at = b.folds == f.fold
                bins, labels = np.ascontiguousarray(b.values[:, at]), b.labels[at]
                if not len(labels):
                    continue
                total = np.zeros(len(labels))
                for n, (routes, share) in enumerate(own, 1):
                    total += share.take(_placed(routes, bins.ravel(), len(labels)))
                    for i, size in wanted.items():
                        if size == n:
                            yield i, labels.tobytes(), (total / n).tobytes()

        def made(i):
            n = estimators[i].getNumTrees()
            own = next(t for t, same in zip(trees, kinds.values(), strict=True) if i in same)
            return spark_trees(self.spark, estimators[i], own[:n], [1.0] * n, self.cuts(), True)

        return made, binned.flatMap(scores), [binned]

    def _neural_network(self, estimators: list, folds: list[int]):
        cells = [
            Network(k, tuple(e.getLayers()), e.getStepSize(), e.getMaxIter(), e.getTol()) for e, k in zip(estimators, folds, strict=True)
        ]
        begun = {layers: None for layers in {c.layers for c in cells}}
        for c in cells:
            if begun[c.layers] is None:
                begun[c.layers] = np.asarray(_start(self.spark, c, self.seed).weights.toArray())
        blocks = self.blocks.map(_single).persist(StorageLevel.MEMORY_AND_DISK)
        weights = descend(blocks, cells, [begun[c.layers] for c in cells], self.rows_by_fold)

        def scores(b: Block):
            for k, c in enumerate(cells):
                at = b.folds == c.fold
                if at.any():
                    p = _activations(b.values[at], _matrices(weights[k].astype(np.float32), c.layers))[-1][:, 1]
                    yield k, b.labels[at].tobytes(), p.astype(np.float64).tobytes()

        return lambda i: spark_network(self.spark, cells[i], weights[i], self.seed), blocks.flatMap(scores), [blocks]
