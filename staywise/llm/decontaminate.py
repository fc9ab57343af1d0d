"""Benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND with every training passage.

Index. Items are cut into words, counted and weighted by Spark; the index is built in blocks whose size is bounded (``BLOCK_POSTINGS``). Each
block is sent to the tasks, ``BLOCKS_A_PASS`` at a time, and all texts are searched against it, so any number of items is searched whole. Impacts are divided by
the item's score against itself: a passage that holds the item's words scores 1, whatever the item's length. Inside a block items lie in ranges
(``RANGE`` items of similar weight); every term has a maximal impact per range, the block maxima.

Search. Passages are windows of ``2 * half`` words, one every ``half`` words, over whole texts; ``half`` is ``HALF`` doubled until an item fits,
and a block holds items of one ``half`` only. So a passage of an item's words lies whole in some window, at any offset. The sum of block maxima over a window's words bounds
every score from above; it is taken for all windows and ranges of a text at once. Windows it cannot rule out go to block-max WAND, which returns
all items at or above the threshold. Nothing else is cut off: no top k, no cap on candidates.

Verification. Around a hit (a window and an item's length to either side) the share of three-word runs of the item's question and of its answer is
counted; both must reach ``OVERLAP``. Items given as one text use their last quarter of words (three at least) as the answer. Items of
fewer than ``SHORT`` words must occur word by word.

Edge cases: null or empty texts and items hit nothing; repeated items (same id and words) count once; null ids are carried; repeated rows are judged
one by one. Empty tables give empty results. Words are lower-cased runs of letters and digits.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import batched, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.session import written

from .text import id_and_text, map_rows

K1, B = 1.2, 0.75
HALF = 32
RANGE = 16
FINE = 4  # items of a narrow range, whose maxima are asked only for windows that the wide ranges leave
THRESHOLD = 0.5
OVERLAP = 0.6
SHORT = 8
BLOCK_POSTINGS = 20_000
BLOCKS_A_PASS = 16
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(words: list[str], n: int = 3) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def overlap(part: list[str], region: list[str]) -> float:
    """The share of the part's runs of three words (of all its words, if fewer) that the region has; 1 for no words."""
    wanted = grams(part)
    if not wanted:
        return 1.0
    have = grams(region, min(3, len(part)))
    return len(wanted & have) / len(wanted)


def split_item(words: list[str]) -> tuple[list[str], list[str]]:
    cut = len(words) - max(3, len(words) // 4)
    return (words[:cut], words[cut:]) if cut > 0 else (words, [])


def half_of(n_words: int) -> int:
    half = HALF
    while half < n_words:
        half *= 2
    return half


class Index:
    """One block of items: postings with impacts, range maxima, and the items' words for verification."""

    def __init__(self, items: list[tuple[int | None, list[str], list[str], dict[str, float]]], threshold: float = THRESHOLD):
        """``items``: id, question words, answer words, impact of each term (summing to 1)."""
        self.threshold = threshold
        self.half = max([half_of(len(q) + len(a)) for _, q, a, _ in items], default=HALF)
        items = sorted(items, key=lambda x: -max(x[3].values()))
        self.items = [(i, q, a) for i, q, a, _ in items]
        self.terms: dict[str, int] = {}
        postings: list[list[tuple[int, float]]] = []
        for at, (_, _, _, impacts) in enumerate(items):
            for term, impact in impacts.items():
                k = self.terms.setdefault(term, len(postings))
                if k == len(postings):
                    postings.append([])
                postings[k].append((at, impact))
        self.lists = [([p for p, _ in row], [w for _, w in row]) for row in postings]
        self.most = [max(w) for _, w in self.lists]
        n_ranges = -(-len(items) // RANGE)
        self.fine = np.zeros((len(postings), n_ranges * (RANGE // FINE)), np.float32)
        for k, row in enumerate(postings):
            for at, impact in row:
                self.fine[k, at // FINE] = max(self.fine[k, at // FINE], np.float32(impact) * np.float32(1.000001))
        self.maxima = self.fine.reshape(len(postings), n_ranges, RANGE // FINE).max(axis=2)

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """(item position, score) of all items at or above the threshold; block-max WAND over ``terms`` without repeats."""
        least = self.threshold - 1e-9
        cursors = [[self.lists[t][0][0], 0, t] for t in terms]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                total += self.most[t]
                if total >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            part = item // RANGE
            if sum(float(self.maxima[c[2], part]) for c in cursors[: pivot + 1]) >= least:
                if cursors[0][0] == item:
                    score = sum(self.lists[c[2]][1][c[1]] for c in cursors[: pivot + 1])
                    if score >= least:
                        found.append((item, score))
                    goal, moved = item + 1, cursors[: pivot + 1]
                else:
                    goal, moved = item, [c for c in cursors[:pivot] if c[0] < item]
            else:
                goal = (part + 1) * RANGE
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                goal, moved = max(goal, item + 1), cursors[: pivot + 1]
            for c in moved:
                row = self.lists[c[2]][0]
                c[1] = bisect_left(row, goal, c[1])
                c[0] = row[c[1]] if c[1] < len(row) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def windows(self, ids: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(first word, distinct terms) of the windows that the range maxima cannot rule out; -1 is an unknown word."""
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return
        size = len(self.lists)
        keys = np.unique((at // self.half) * size + ids[at])
        cells, terms = keys // size, keys % size
        heads = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        bounds = np.zeros((int(cells[-1]) + 3, self.maxima.shape[1]), np.float32)
        bounds[cells[heads] + 1] = np.add.reduceat(self.maxima[terms], heads, axis=0)
        both = (bounds[:-1] + bounds[1:]).max(axis=1)  # entry k: cells k - 1 and k
        edges = np.searchsorted(cells, np.arange(int(cells[-1]) + 3))
        for k in np.flatnonzero(both >= self.threshold - 1e-4):
            low, high = edges[max(0, k - 1)], edges[min(k + 1, len(edges) - 1)]
            inside = np.unique(terms[low:high])
            if self.fine[inside].sum(axis=0).max() >= self.threshold - 1e-4:
                yield max(0, k - 1) * self.half, inside.tolist()

    def hits(self, words: list[str]) -> list[tuple[int | None, int, float, float, float]]:
        """(item id, first word of the best window, score, question overlap, answer overlap) of verified items."""
        ids = np.fromiter(map(self.terms.get, words, repeat(-1)), np.int64, len(words))
        best: dict[int, tuple[float, float, float, int]] = {}
        for start, terms in self.windows(ids):
            for item, score in self.search(terms):
                _, question, answer = self.items[item]
                n = len(question) + len(answer)
                region = words[max(0, start - n) : start + 2 * self.half + n]
                shares = overlap(question, region), overlap(answer, region)
                if n < SHORT:
                    whole = question + answer
                    found = any(region[i : i + n] == whole for i in range(len(region) - n + 1))
                    shares = (1.0, 1.0) if found else (0.0, 0.0)
                if min(shares) >= OVERLAP and (item not in best or score > best[item][0]):
                    best[item] = (score, *shares, start)
        return [(self.items[i][0], at, s, q, a) for i, (s, q, a, at) in sorted(best.items())]


def index_blocks(items: DataFrame, threshold: float = THRESHOLD, block_postings: int = BLOCK_POSTINGS) -> Iterator[Index]:
    """Indexes of all items (item_id, question, answer; or item_id, text), a bounded block at a time."""
    if "text" in items.columns:
        items = items.select(F.col("item_id").cast("long"), "text", F.lit(None).cast("string").alias("answer"))
    else:
        items = items.select(F.col("item_id").cast("long"), F.col("question").alias("text"), F.coalesce("answer", F.lit("")).alias("answer"))

    def cut(source: Iterator[tuple]) -> Iterator[tuple]:
        for item, text, answer in source:
            question, rest = (words_of(text), words_of(answer)) if answer is not None else split_item(words_of(text))
            if question or rest:
                counts = Counter(question + rest)
                yield item, question, rest, list(counts), list(counts.values()), half_of(len(question) + len(rest))

    schema = "item_id long, question array<string>, answer array<string>, terms array<string>, counts array<int>, half int"
    parts = written(map_rows(items.distinct(), cut, schema).dropDuplicates(["item_id", "question", "answer"]), "items")
    totals = parts.agg(
        F.count("*").alias("n"), F.avg(F.size("question") + F.size("answer")).alias("length")
    ).first()
    if not totals["n"]:
        return
    df = parts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(totals["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    size = F.size("question") + F.size("answer")
    one = parts.select(
        F.xxhash64("item_id", F.size("question"), "question", "answer").alias("key"),
        size.alias("size"),
        F.explode(F.arrays_zip("terms", "counts")).alias("t"),
    ).select("key", "size", F.col("t.terms").alias("term"), F.col("t.counts").alias("tf"))
    weight = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.lit(totals["length"])))
    weighted = one.join(df.select("term", idf.alias("idf")), "term").select("key", "term", weight.alias("w"))
    impacts = weighted.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("w"))
    sizes = {r["half"]: r["n"] for r in parts.groupBy("half").agg(F.sum(F.size("terms")).alias("n")).collect()}
    ready = written(
        parts.select("item_id", "question", "answer", "half", F.xxhash64("item_id", F.size("question"), "question", "answer").alias("key"))
        .join(impacts, "key")
        .select("item_id", "question", "answer", "w", "half", "key"),
        "impacts",
    )
    blocks = [(h, many, b) for h in sorted(sizes) for many in [math.ceil(sizes[h] / block_postings)] for b in range(many)]
    for h, many, block in blocks:
        rows = ready.where((F.col("half") == h) & (F.pmod("key", F.lit(many)) == block)).collect()  # a bounded block
        items_of = []
        for r in rows:
            total = sum(r["w"].values())
            items_of.append((r["item_id"], r["question"], r["answer"], {t: w / total for t, w in r["w"].items()}))
        if items_of:
            yield Index(items_of, threshold)


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, first_word, score, question_overlap, answer_overlap) of every verified pair."""
    schema = "doc_id long, item_id long, first_word long, score double, question_overlap double, answer_overlap double"
    texts, out = id_and_text(docs), None
    for indexes in batched(index_blocks(items, threshold), BLOCKS_A_PASS):
        held = docs.sparkSession.sparkContext.broadcast(indexes)

        def rows(source: Iterator[tuple], held=held) -> Iterator[tuple]:
            for doc, text in source:
                words = words_of(text)
                for index in held.value:
                    for hit in index.hits(words):
                        yield doc, *hit

        # Written pass by pass, so that one pass's index is in memory at a time.
        found = written(map_rows(texts, rows, schema), "leaks")
        held.destroy()
        out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows whose text holds no item; a narrow pass a block, every column stays as it is."""
    from .text import rewrite

    for indexes in batched(index_blocks(items, threshold), BLOCKS_A_PASS):
        held = docs.sparkSession.sparkContext.broadcast(indexes)

        def clean(text: str, held=held) -> str | None:
            words = words_of(text)
            return None if any(index.hits(words) for index in held.value) else text

        docs = rewrite(docs, clean, text_col)
    return docs
