"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Statistics come from the whole text only. Each class has a Gaussian with a shrunken covariance: class covariance, pooled covariance and a scaled
identity are blended (``POOL``, ``ROUND``). The score is the logistic of the difference of the log densities, worked out as Mahalanobis
distances by Cholesky factors that are computed once and sent with the scoring function.

Fitting uses every labelled row: class moments are summed in the tasks and added up by Spark, so only a few hundred numbers reach the
driver. ``fit`` never sees held-out rows; ids, languages, sources and labels are no inputs.

Edge cases: null and empty texts have all statistics 0 and get the score of such a point. Null labels are left out. Without rows of
both classes every score is 0.5. Repeated rows are scored each; repeated labels weigh each. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.session import written

from .rules import STOP_WORDS
from .text import as_bytes, id_and_text, map_rows, shingle_hashes, word_bounds, word_hashes

POOL = 0.2
ROUND = 0.05
CUT = 0.3
HELD_OUT_OF = 5

STATISTICS = (
    "words", "word_length", "length_spread", "symbols", "capitals", "marks", "digits", "distinct", "top_word",
    "repeats", "same_lines", "stop_words", "line_length", "bare_marks",
)

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(range(0x21, 0x41)) + list(range(0x5B, 0x61)) + list(range(0x7B, 0x7F))] = 1
_CLASS[list(b"#*$%&|<>")] = 2
_CLASS[list(range(ord("A"), ord("Z") + 1))] = 3
_CLASS[list(range(ord("0"), ord("9") + 1))] = 4


def _hash_list(words: list[str]) -> np.ndarray:
    rows = [as_bytes(w) for w in words]
    return np.unique(np.concatenate([word_hashes(r, *word_bounds(r)) for r in rows]))


_STOP = _hash_list(STOP_WORDS)


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text, in the order of ``STATISTICS``."""
    data = as_bytes(text)
    starts, ends = word_bounds(data)
    n = len(starts)
    if not n:
        return [0.0] * len(STATISTICS)
    hashes = word_hashes(data, starts, ends)
    lengths = ends - starts
    kinds = np.bincount(_CLASS[data], minlength=5)
    # Capital letters outside ASCII: two-byte letters below U+00E0, which stand after the byte 0xC3.
    capitals = int(kinds[3]) + int(((data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[:-1] == 0xC3)).sum())
    total = int(lengths.sum())
    _, counts = np.unique(hashes, return_counts=True)
    _, again = np.unique(shingle_hashes(hashes, 3), return_counts=True)
    lines = [line for line in text.split("\n") if line.strip()]
    bare = int((_CLASS[data[starts]] == 2).sum())
    stops = int((_STOP[np.minimum(np.searchsorted(_STOP, hashes), len(_STOP) - 1)] == hashes).sum())
    return [
        math.log1p(n),
        math.log(total / n),
        math.log1p(float(lengths.std())),
        math.log1p(10 * int(kinds[2]) / n),
        math.sqrt(capitals / total),
        math.sqrt(int(kinds[1] + kinds[2]) / total),
        math.sqrt(int(kinds[4]) / total),
        math.log(len(counts) / n),
        math.sqrt(int(counts.max()) / n),
        math.sqrt(int(again[again > 1].sum()) / max(1, n - 2)),
        math.sqrt((len(lines) - len(set(lines))) / max(1, len(lines))),
        math.sqrt(stops / n),
        math.log1p(n / max(1, len(lines))),
        math.log1p(10 * bare / n),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x) of every row, written."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text in source:
            yield doc, statistics(text)

    return written(map_rows(id_and_text(docs, id_col, text_col), rows, "doc_id long, x array<double>"), "statistics")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0


@dataclass
class Discriminant:
    """Per class: mean, inverse Cholesky factor, half log determinant, log share; over standardised statistics."""

    shift: np.ndarray
    scale: np.ndarray
    classes: list[tuple[np.ndarray, np.ndarray, float, float]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 of each row."""
        if len(self.classes) < 2:
            return np.full(len(x), 0.5)
        z = (x - self.shift) / self.scale
        logs = [
            share - half - 0.5 * np.square((z - mean) @ factor.T).sum(axis=1)
            for mean, factor, half, share in self.classes
        ]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def fit(rows: DataFrame) -> Discriminant:
    """``rows``: (x, label 0 or 1). Class moments are summed by Spark."""
    k = len(STATISTICS)

    def moments(source: Iterator[tuple]) -> Iterator[tuple]:
        sums = np.zeros((2, 1 + k + k * k))
        for x, label in source:
            v = np.array(x)
            sums[label, 0] += 1
            sums[label, 1 : 1 + k] += v
            sums[label, 1 + k :] += np.outer(v, v).ravel()
        for label in (0, 1):
            if sums[label, 0]:
                yield label, sums[label].tolist()

    parts = map_rows(rows.where("label in (0, 1)").select("x", F.col("label").cast("int")), moments, "label int, v array<double>")
    added = parts.select("label", F.posexplode("v").alias("at", "v")).groupBy("label", "at").agg(F.sum("v").alias("v"))
    sums = np.zeros((2, 1 + k + k * k))
    for r in added.collect():  # two classes, 1 + k + k * k numbers each
        sums[r["label"], r["at"]] = r["v"]
    n, first, second = sums[:, 0], sums[:, 1 : 1 + k], sums[:, 1 + k :].reshape(2, k, k)
    if not n.all():
        return Discriminant(np.zeros(k), np.ones(k), [])
    total = n.sum()
    shift = first.sum(axis=0) / total
    scale = np.sqrt(np.maximum(np.diag(second.sum(axis=0)) / total - shift**2, 1e-9))
    means = (first / n[:, None] - shift) / scale
    covariances = []
    for c in (0, 1):
        mean = first[c] / n[c]
        covariances.append((second[c] / n[c] - np.outer(mean, mean)) / np.outer(scale, scale))
    pooled = sum(n[c] / total * covariances[c] for c in (0, 1))
    classes = []
    for c in (0, 1):
        blend = (1 - POOL) * covariances[c] + POOL * pooled
        blend = (1 - ROUND) * blend + ROUND * max(np.trace(blend) / k, 1e-6) * np.eye(k)
        factor = np.linalg.cholesky(blend)
        half = float(np.log(np.diag(factor)).sum())
        classes.append((means[c], np.linalg.inv(factor), half, math.log(n[c] / total)))
    return Discriminant(shift, scale, classes)


def score(table: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, held_out, score, predicted) for rows (doc_id, x)."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc, x in source:
            yield doc, float(model.score(np.array([x]))[0])

    scored = map_rows(table.select("doc_id", "x"), rows, "doc_id long, score double")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """Fit on the labelled rows that are not held out, score every row."""
    table = document_statistics(docs)
    known = labels.select("doc_id", F.col(label_col).alias("label")).where(~held_out(F.col("doc_id")))
    return score(table, fit(table.join(known, "doc_id")))
