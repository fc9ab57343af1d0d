"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One replaced letter takes one from a count and adds one to another; one inserted letter adds one. So words of one length that are near differ by one step down
and one step up, words of neighbouring lengths by one step up: an L1 distance of two or one. Range searches in k-d trees prune every box that
needs more, and the letter order of the few pairs left is compared exactly.

1. Runs of letters are counted natively, with map-side combining; words are told apart by themselves.
2. A plan of one tree for each length, made on the driver from a sample of words, deals the words to cells of some thousand words. The sample
   (``SAMPLE`` words at most) only decides where boxes are cut; every word is placed and searched.
3. Each word goes to its own cell, and as a query to the cells within reach: of its own length (those after its own cell, so that
   a pair is met once) and of the next length. Cells are tasks' work by one shuffle.
4. Inside a cell a finer tree over its words takes the queries in blocks. Pairs are counted per word there, so a word with very many variants costs one row per cell.
   No cell is cut short: leaves that can't be divided (anagrams) are compared block by block.
5. A word's form is its most frequent near word, if that is ``RATIO`` times as frequent. Roots follow by pointer doubling; a chain is no longer than the
   logarithm of the largest count.

Edge cases: null texts have no words, null ids count as empty strings in the hash. Repeated rows count each time. Only the id and the
text are read, so other columns never clash. Empty tables, and texts without letters, give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.session import written

from .text import map_rows

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
DROPPED_OF = 31  # of the hashes, one in so many loses a letter
SAMPLE = 200_000
CELL = 4096  # words of a cell, as the sample estimates it
LEAF = 24  # words of a leaf inside a cell
BLOCK = 2048  # rows compared at once
MOST_COMPARED = 1 << 22  # counts compared at once
MOST_ROUNDS = 64

# Letters are Latin-1: a to z, and the code points from C0 on. A column of the vector for each.
FIRST_HIGH = 0xC0
LETTERS = 26 + 0x100 - FIRST_HIGH
_COLUMN = np.zeros(256, np.int64)
_COLUMN[ord("a") : ord("z") + 1] = np.arange(26)
_COLUMN[FIRST_HIGH:] = np.arange(26, LETTERS)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z in lower case; of one run in ``DROPPED_OF`` by hash one letter is left out."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(r"[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("run"),
    )
    runs = runs.where(F.length("run") >= LEAST_LENGTH).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % DROPPED_OF == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters(words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of one length as rows of Latin-1 bytes, and their letter counts."""
    rows = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)
    flat = np.repeat(np.arange(len(words)), length) * LETTERS + _COLUMN[rows].ravel()
    counts = np.bincount(flat, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)
    return rows, counts.astype(np.int16 if length < 1 << 14 else np.int32)


def narrowed(counts: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The columns in use, and all others added up: to a row that has none of the others, distances stay the same."""
    others = counts[:, ~used].sum(axis=1, dtype=counts.dtype)
    return np.concatenate([counts[:, used], others[:, None]], axis=1)


class Tree:
    """A k-d tree over letter counts. ``cut`` is None in a leaf, else (column, threshold): up to it left, above it right."""

    __slots__ = ("cut", "left", "right", "rows", "number")

    def __init__(self, counts: np.ndarray, rows: np.ndarray, leaf: int) -> None:
        self.cut = self.left = self.right = None
        self.rows, self.number = rows, 0
        if len(rows) <= leaf:
            return
        own = counts[rows]
        # Where to cut: the column whose counts spread most; its median if both sides get rows, else the next value.
        column = int(own.var(axis=0).argmax())
        values = own[:, column]
        low, high = int(values.min()), int(values.max())
        if low == high:
            return
        middle = int(np.median(values))
        at = min((t for t in {max(low, middle - 1), min(middle, high - 1)} if low <= t < high), key=lambda t: abs(2 * int((values <= t).sum()) - len(rows)))
        side = values <= at
        self.cut = (column, at)
        self.left, self.right = Tree(counts, rows[side], leaf), Tree(counts, rows[~side], leaf)
        self.rows = None

    def numbered(self, first: int = 0) -> int:
        """Number the leaves from ``first`` in order; returns the next number."""
        if self.cut is None:
            self.number = first
            return first + 1
        return self.right.numbered(self.left.numbered(first))

    def home(self, counts: np.ndarray, rows: np.ndarray) -> Iterator[tuple[Tree, np.ndarray]]:
        """Leaves with the rows that lie in them."""
        if not len(rows):
            return
        if self.cut is None:
            yield self, rows
            return
        column, at = self.cut
        side = counts[rows, column] <= at
        yield from self.left.home(counts, rows[side])
        yield from self.right.home(counts, rows[~side])

    def reached(self, counts: np.ndarray, rows: np.ndarray, up: np.ndarray, down: np.ndarray) -> Iterator[tuple[Tree, np.ndarray]]:
        """Leaves whose box a row reaches with the steps it has: ``up`` counts more by one, ``down`` fewer by one."""
        if not len(rows):
            return
        if self.cut is None:
            yield self, rows
            return
        column, at = self.cut
        values = counts[rows, column]
        inside = values <= at
        step = (values == at + 1) & (down > 0)
        go = inside | step
        yield from self.left.reached(counts, rows[go], up[go], (down - step)[go])
        step = (values == at) & (up > 0)
        go = ~inside | step
        yield from self.right.reached(counts, rows[go], (up - step)[go], down[go])


def plan(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, Tree]:
    """A tree for each length that the sample holds, its leaves numbered as cells."""
    n = words.count()
    share = min(1.0, sample / n) if n else 1.0
    # Chosen by hash, so that a repeated run cuts alike; twice the expectation is never passed but by a bad hash, and then cut off.
    chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("word").limit(2 * sample)
    by_length: dict[int, list[str]] = {}
    for word in chosen.toArrow()["word"].to_pylist():
        by_length.setdefault(len(word), []).append(word)
    trees, number = {}, 0
    for length, sampled in sorted(by_length.items()):
        counts = letters(sorted(sampled), length)[1]
        trees[length] = Tree(counts, np.arange(len(sampled)), max(1, int(cell * share)))
        number = trees[length].numbered(number)
    for tree in trees.values():
        _forget(tree)
    return trees


def _forget(tree: Tree) -> None:
    """The plan needs no sampled rows."""
    tree.rows = None
    if tree.cut is not None:
        _forget(tree.left)
        _forget(tree.right)


def _dealt(trees) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """(cell, length, own, word, n): each word in its own cell, and as a query in the cells within reach."""

    def deal(batch: list[tuple[str, int]], length: int) -> Iterator[tuple]:
        words = [w for w, _ in batch]
        counts = letters(words, length)[1]
        rows = np.arange(len(words))
        one, none = np.ones(len(words), np.int8), np.zeros(len(words), np.int8)
        # A length that the sample missed is one cell, numbered below all others.
        tree, longer = trees.value.get(length), trees.value.get(length + 1)
        home = np.full(len(words), -length, np.int64)
        for leaf, at in tree.home(counts, rows) if tree else ():
            home[at] = leaf.number
        for row in rows.tolist():
            yield int(home[row]), length, True, *batch[row]
        for leaf, at in tree.reached(counts, rows, one, one) if tree else ():
            for row in at[home[at] < leaf.number].tolist():
                yield leaf.number, length, False, *batch[row]
        if longer is None:
            for row in rows.tolist():
                yield -(length + 1), length, False, *batch[row]
        else:
            for leaf, at in longer.reached(counts, rows, one, none):
                for row in at.tolist():
                    yield leaf.number, length, False, *batch[row]

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, list] = {}
        for word, n in source:
            held.setdefault(len(word), []).append((word, n))
            if len(held[len(word)]) >= BLOCK:
                yield from deal(held.pop(len(word)), len(word))
        for length, batch in held.items():
            yield from deal(batch, length)

    return rows


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether b is a with one letter more: what agrees from the front and from the back covers a."""
    length = a.shape[1]
    front = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= length


class _Found:
    """Of each word of one side: how many near words, and the most frequent of them."""

    def __init__(self, words: list[str], n: np.ndarray) -> None:
        self.words, self.n = words, n
        self.many = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, str]] = {}

    def add(self, mine: np.ndarray, theirs: np.ndarray, other: _Found) -> None:
        np.add.at(self.many, mine, 1)
        for i, j in zip(mine.tolist(), theirs.tolist(), strict=True):
            found = (-int(other.n[j]), other.words[j])
            if i not in self.best or found < self.best[i]:
                self.best[i] = found

    def rows(self) -> Iterator[tuple]:
        for i, (less, word) in self.best.items():
            yield self.words[i], int(self.many[i]), less, word


def _searched(source: Iterator[tuple]) -> Iterator[tuple]:
    """(word, many, less, other) for each cell: its words among themselves, then queries in blocks."""
    for _, group in groupby(source, key=lambda r: r[0]):
        words: list[str] = []
        n: list[int] = []
        own: _Found | None = None
        block: list[tuple] = []
        for _, length, at_home, word, count in group:
            if at_home:
                words.append(word)
                n.append(count)
                continue
            if not words:
                continue  # no word of the cell to be near to
            if own is None:
                own, tree, table, used = _ready(words, n)
                _near(tree, table, own, table, own, True)
            if block and (len(block) >= BLOCK or len(block[0][0]) != length):
                yield from _asked(block, tree, table, used, own)
                block = []
            block.append((word, count))
        if words and own is None:
            own, tree, table, used = _ready(words, n)
            _near(tree, table, own, table, own, True)
        if block:
            yield from _asked(block, tree, table, used, own)
        if own is not None:
            yield from own.rows()


def _ready(words: list[str], n: list[int]) -> tuple[_Found, Tree, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Words of a cell with their tree, their rows and counts, and the letters that occur in the cell: most of Latin-1 does not."""
    rows, counts = letters(words, len(words[0]))
    used = counts.any(axis=0)
    counts = narrowed(counts, used)
    return _Found(words, np.array(n, np.int64)), Tree(counts, np.arange(len(words)), LEAF), (rows, counts), used


def _asked(block: list[tuple], tree: Tree, table: tuple, used: np.ndarray, own: _Found) -> Iterator[tuple]:
    words = [w for w, _ in block]
    found = _Found(words, np.array([n for _, n in block], np.int64))
    rows, counts = letters(words, len(words[0]))
    _near(tree, table, own, (rows, narrowed(counts, used)), found, False)
    yield from found.rows()


def _near(tree: Tree, table: tuple, own: _Found, asked: tuple, found: _Found, same: bool) -> None:
    """All near pairs of a cell's words and the rows asked, added on both sides; ``same``: these are the cell's words themselves."""
    (rows, counts), (theirs, their_counts) = table, asked
    alike, width = rows.shape[1] == theirs.shape[1], counts.shape[1]
    for first in range(0, len(theirs), BLOCK):
        at = np.arange(first, min(first + BLOCK, len(theirs)))
        one = np.ones(len(at), np.int8)
        for leaf, reached in tree.reached(their_counts, at, one, one if alike else np.zeros_like(one)):
            step = max(1, MOST_COMPARED // (width * len(leaf.rows)))
            for k in range(0, len(reached), step):
                part = reached[k : k + step]
                for m in range(0, len(leaf.rows), MOST_COMPARED // width):
                    held = leaf.rows[m : m + MOST_COMPARED // width]
                    apart = np.abs(their_counts[part][:, None, :] - counts[held][None, :, :]).sum(axis=2, dtype=counts.dtype)
                    q, r = np.nonzero(apart == (2 if alike else 1))
                    q, r = part[q], held[r]
                    if same:
                        q, r = q[q < r], r[q < r]
                    if not len(q):
                        continue
                    near = one_replaced(theirs[q], rows[r]) if alike else one_inserted(theirs[q], rows[r])
                    found.add(q[near], r[near], own)
                    own.add(r[near], q[near], found)


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """(word, n_near, other, other_n) of all words (word, n) that have a near word; ``other`` is the most frequent near word."""
    shared = words.sparkSession.sparkContext.broadcast(plan(words, sample, cell))
    cells = map_rows(words.select("word", "n"), _dealt(shared), "cell long, length int, own boolean, word string, n long")
    placed = cells.repartition("cell").sortWithinPartitions("cell", F.desc("own"), "length")
    hits = map_rows(placed, _searched, "word string, many long, less long, other string")
    best = F.min(F.struct("less", "other"))
    return (
        hits.groupBy("word")
        .agg(F.sum("many").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form, from (word, form), by pointer doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MOST_ROUNDS):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        now = written(moved, "roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError(f"forms did not settle in {MOST_ROUNDS} rounds")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, cell: int = CELL
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``LEAST_LENGTH`` letters or more that occurs ``LEAST_COUNT`` times or more."""
    words = written(word_counts(docs, id_col, text_col), "words")
    near = written(near_words(words, sample, cell), "near")
    known = words.join(near, "word", "left")
    has = F.col("other_n") >= RATIO * F.col("n")
    known = written(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("other")).alias("form"),
            F.when(has, F.col("other_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
