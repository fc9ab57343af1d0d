"""Phrase collocations by vertical partitioning of word suffixes.

A suffix is what follows one word place inside its piece of text; phrases are prefixes of suffixes, so the suffix tree cut at ``WORDS`` words holds the count
of every phrase as the total of the leaves below it. The tree is never built whole:

1. Prefixes of one word are counted, then prefixes of two frequent words. A prefix below ``least`` can't hold a frequent
   phrase, so suffixes are read on only while each two neighbouring words are frequent together (elastic range). Which are is told by a bitmap of
   hashes of bounded size: it may let rare ones through, never the other way round, and rare ones fall out when they are counted.
2. Prefixes are grouped by memory budget. A first word with up to ``budget`` occurrences is one prefix; more frequent ones are extended by the second
   word, then by the third. Prefixes fall into slots by hash, slots are packed into groups of ``budget`` leaves by their counts.
3. Each group is a subtree of its own. Equal leaves are added up in the map tasks first, so a phrase that stands in a third of all rows leaves each
   task as one row. A task reads its groups' leaves in word order and keeps one total per depth: a node's count is complete
   when a leaf outside it comes. Memory does not depend on the size of a group.
4. Frequent nodes are few; cuts, containment and the ranking by score are joins and groupings of them.

Leaves and nodes are told apart by their words, never by hashes. Counts are 64-bit, scores are worked out in decimals.

Driver: the packing plan (at most ``MOST_SLOTS`` totals) and one bitmap (at most ``MOST_BITS`` bits). With more frequent prefixes than the bitmap can tell
apart more leaves are read and shuffled; results stay the same.

Edge cases: null texts are empty, null languages are ``und``. Empty tables, and tables without a frequent phrase, give empty
results. Repeated rows count each time. Only the text and the language are read, so other columns never clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staywise.session import written

from .text import map_rows, mix, signed, word_hashes

WORDS = 4
LEAST = 30  # occurrences of a candidate
TOP = 2000
BUDGET = 1 << 17  # leaves of a group
MOST_SLOTS = 1 << 18
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
BITS_A_PREFIX = 16
HELD = 400_000  # distinct keys a map task adds up before it hands them on
PLACES = 1 << 20  # word places of which a map task adds up the two-word prefixes at once

# Bytes of a text after folding: word separator, piece separator. Words that hold these bytes themselves are escaped first, so that keys sort
# word by word as bytes.
WORD_END, PIECE_END = 0x00, 0x0A
_FOLD = bytearray(range(256))
_FOLD[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
_FOLD[0x20] = _FOLD[0x09] = WORD_END
for _separator in (*b".,;:!?", *range(0x0A, 0x0E)):
    _FOLD[_separator] = PIECE_END
_FOLD = bytes(_FOLD)
_RUNS = re.compile(rb"\x00{2,}")


def _escaped(data: bytes) -> bytes:
    return data.replace(b"\x01", b"\x01\x03").replace(b"\x00", b"\x01\x02")


def phrase_of(key: bytes) -> str:
    """The words of a key with single spaces between them."""
    return key.replace(b"\x00", b" ").replace(b"\x01\x02", b"\x00").replace(b"\x01\x03", b"\x01").decode()


def folded(text: str) -> bytes:
    """The folded text: exactly one separator between the words of a piece, so that a slice over some of them is the key of that phrase."""
    data = text.encode()
    if b"\x00" in data or b"\x01" in data:
        data = _escaped(data)
    data = data.translate(_FOLD)
    if b"\x00\x00" in data:
        data = _RUNS.sub(b"\x00", data)
    return data.replace(b"\x00\n", b"\n").replace(b"\n\x00", b"\n")


def places(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a folded text, and how many further words of the same piece follow each."""
    row = np.frombuffer(data, np.uint8)
    between = np.ones(len(row) + 2, bool)
    between[1:-1] = (row == WORD_END) | (row == PIECE_END)
    edges = np.flatnonzero(between[1:] != between[:-1])
    starts, ends = edges[0::2], edges[1::2]
    n = len(starts)
    if not n:
        return starts, ends, np.empty(0, np.int64)
    last = np.ones(n, bool)
    last[:-1] = row[ends[:-1]] == PIECE_END
    stop = np.flatnonzero(last)
    return starts, ends, np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(n)


@lru_cache(maxsize=1024)
def _language_seed(lang: str) -> np.uint64:
    data = np.frombuffer(b"\x02" + lang.encode(), np.uint8)
    return word_hashes(data, np.zeros(1, np.int64), np.array([len(data)]), lower=False)[0]


_SECOND, _THIRD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _prefix_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, lang: str) -> np.ndarray:
    """A hash of each word in its language."""
    return mix(word_hashes(np.frombuffer(data, np.uint8), starts, ends, lower=False) + _language_seed(lang))


def _pairs(one: np.ndarray) -> np.ndarray:
    """A hash of each word and the next."""
    return mix(one[:-1] * _SECOND + one[1:])


class _Bits:
    """A read-only bitmap of hashes."""

    def __init__(self, data: bytes) -> None:
        self.bits = np.frombuffer(data, np.uint8)
        self.mask = np.uint64(len(data) * 8 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bitmap(hashes: DataFrame) -> bytes:
    """A bitmap with the bits of all hashes (column h) set; its size follows their number up to ``MOST_BITS``."""
    size = LEAST_BITS
    n = hashes.count()
    while size < n * BITS_A_PREFIX and size < MOST_BITS:
        size *= 2
    at = F.col("h").bitwiseAND(F.lit(size - 1))
    word = F.shiftright(at, 6).alias("word")
    bit = F.expr(f"shiftleft(1L, cast((h & {size - 1}L) & 63 as int))")
    table = hashes.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return out.tobytes()


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text is not null")


def _map_arrays(df: DataFrame, arrays: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``arrays`` gets the rows of a partition and yields result columns, whole arrays or lists at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*(c.slice(at, 256).to_pylist() for c in batch.columns), strict=True)

        for columns in arrays(source()):
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)
            for at in range(0, made.num_rows, 1 << 16):
                yield made.slice(at, 1 << 16)

    return df.mapInArrow(stream, schema)


def _word_rows(source: Iterator[tuple]) -> Iterator[tuple]:
    """(lang, word, h, n) with the words of one task added up."""
    counts: dict[str, Counter] = {}

    def out() -> Iterator[tuple]:
        for lang, of_lang in counts.items():
            of_lang.pop(b"", None)
            if not of_lang:
                continue
            keys = list(of_lang)
            ends = np.cumsum([len(k) for k in keys])
            starts = np.concatenate([[0], ends[:-1]])
            yield [lang] * len(keys), keys, signed(_prefix_hashes(b"".join(keys), starts, ends, lang)), list(of_lang.values())
        counts.clear()

    for lang, text in source:
        counts.setdefault(lang, Counter()).update(folded(text).replace(b"\n", b"\x00").split(b"\x00"))
        if sum(map(len, counts.values())) >= HELD:
            yield from out()
    yield from out()


def _pair_rows(words) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """(h, first, n): two frequent words of a piece, by hash, added up over many places."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        frequent = _Bits(words.value)
        held: list[np.ndarray] = []
        n = 0

        def out() -> Iterator[tuple]:
            both = np.concatenate(held, axis=1)
            _, at, many = np.unique(both[0], return_index=True, return_counts=True)
            yield signed(both[0][at]), signed(both[1][at]), many
            held.clear()

        for lang, text in source:
            data = folded(text)
            starts, ends, after = places(data)
            if len(starts) < 2:
                continue
            one = _prefix_hashes(data, starts, ends, lang)
            fit = frequent.has(one)
            keep = np.flatnonzero(fit[:-1] & fit[1:] & (after[:-1] > 0))
            held.append(np.stack([_pairs(one)[keep], one[keep]]))
            n += len(keep)
            if n >= PLACES:
                yield from out()
                n = 0
        if held:
            yield from out()

    return rows


def _slot(one: np.ndarray, two: np.ndarray, three: np.ndarray, heavy: np.ndarray, heavier: np.ndarray, slots: int) -> np.ndarray:
    """The slot of a suffix: by its first word, by two if that is too frequent, by three if those are."""
    key = np.where(_in(heavier, two), three, np.where(_in(heavy, one), two, one))
    return (mix(key) >> np.uint64(8)) % np.uint64(slots)


def _in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _leaf_rows(pairs, plan, words: int) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """(group, lang, key, part, n): leaves of two words or more, added up in the task; ``part``: shorter nodes stand in other groups as well."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        frequent = _Bits(pairs.value)
        heavy, heavier, group_of = plan.value
        counts: dict[str, Counter] = {}

        def out() -> Iterator[tuple]:
            for lang, of_lang in counts.items():
                if not of_lang:
                    continue
                keys = list(of_lang)
                blob = b"\n".join(keys)
                starts, ends, after = places(blob)
                one = _prefix_hashes(blob, starts, ends, lang)
                # The first word of each key: one that does not follow another of its piece.
                at = np.flatnonzero(np.append(True, after[:-1] == 0))
                two = _pairs(one)[at]
                third = np.where(after[at] > 1, one[np.minimum(at + 2, len(one) - 1)], np.uint64(0))
                slots = _slot(one[at], two, mix(two * _THIRD + third), heavy, heavier, len(group_of))
                yield group_of[slots], [lang] * len(keys), keys, _in(heavier, two), list(of_lang.values())
            counts.clear()

        held = 0
        for lang, text in source:
            data = folded(text)
            starts, ends, after = places(data)
            if len(starts) < 2:
                continue
            one = _prefix_hashes(data, starts, ends, lang)
            go_on = np.append(frequent.has(_pairs(one)), False) & (after > 0)
            # Words of the leaf after the first: as long as each next two words are frequent together.
            more = go_on.astype(np.int64)
            for k in range(1, min(words - 1, len(more))):
                more[: len(more) - k] += (more[: len(more) - k] == k) & go_on[k:]
            at = np.flatnonzero(more)
            bounds = zip(starts[at].tolist(), ends[at + more[at]].tolist(), strict=True)
            counts.setdefault(lang, Counter()).update([data[s:e] for s, e in bounds])
            held += len(at)
            if held >= HELD:
                held = sum(map(len, counts.values()))
                if held >= HELD:
                    yield from out()
                    held = 0
        yield from out()

    return rows


def _node_rows(least: int) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """(lang, key, words, n): nodes of two words or more, from the leaves of each group in order of language and key.

    Nodes that stand in other groups too (``part`` and two words) go on whatever their total.
    """

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        last: list[bytes] = []
        totals = [0] * (WORDS + 1)  # by depth; open are those down to the last leaf's
        place, split = None, False

        def close(depth: int) -> Iterator[tuple]:
            """Nodes deeper than ``depth`` are complete; each adds its total to the one above."""
            for d in range(len(last), max(depth, 1), -1):
                n, totals[d] = totals[d], 0
                totals[d - 1] += n
                if n >= least or split and d == 2:
                    yield place, b"\x00".join(last[:d]), d, n

        for lang, key, part, n in source:
            words = key.split(b"\x00")
            shared = 0
            if lang == place:
                for mine, theirs in zip(words, last):  # noqa: B905
                    if mine != theirs:
                        break
                    shared += 1
            yield from close(shared)
            last, place, split = words, lang, part
            totals[1] = 0
            totals[len(words)] += n
        yield from close(0)

    return rows


def _packed(weights: dict[int, int], slots: int, budget: int) -> tuple[np.ndarray, int]:
    """The group of each slot, and the number of groups: the largest slot left opens a group, the smallest ones fill it up."""
    group_of = np.zeros(slots, np.int32)
    order = sorted(range(slots), key=lambda s: -weights.get(s, 0))
    low, high, group = 0, slots - 1, 0
    while low <= high:
        group_of[order[low]] = group
        room = budget - weights.get(order[low], 0)
        low += 1
        while low <= high and weights.get(order[high], 0) <= room:
            group_of[order[high]] = group
            room -= weights.get(order[high], 0)
            high -= 1
        group += 1
    return group_of, group


def _column_of_hashes(df: DataFrame) -> np.ndarray:
    return np.sort(df.toArrow()["h"].to_numpy().view(np.uint64))


def plan_groups(words: DataFrame, pairs: DataFrame, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(first words above the budget, pairs above it, group of each slot, number of groups). All are bounded by places / budget.

    ``words`` and ``pairs``: (h, first, n) of the frequent prefixes. A pair of a word above the budget weighs on its own slot.
    """
    total = pairs.agg(F.sum("n")).first()[0] or 0
    slots = int(min(MOST_SLOTS, max(16, 16 * -(-total // budget))))
    budget = max(budget, -(-16 * total // slots))  # beyond the most slots groups become larger instead of more
    heavy = _column_of_hashes(words.where(F.col("n") > budget).select("h"))
    heavier = _column_of_hashes(pairs.where(F.col("n") > budget).select("h"))

    def weighed(source: Iterator[tuple]) -> Iterator[tuple]:
        out = np.zeros(slots, np.int64)
        while chunk := [r for _, r in zip(range(1 << 16), source)]:  # noqa: B905
            h, first, n = (np.array(c, np.int64) for c in zip(*chunk, strict=True))
            two, one = h.view(np.uint64), first.view(np.uint64)
            # What a pair above the budget holds is spread over the slots by the third word.
            spread = _in(heavier, two)
            np.add.at(out, _slot(one[~spread], two[~spread], two[~spread], heavy, heavier, slots).astype(np.int64), n[~spread])
            out += n[spread].sum() // slots
        for s in np.flatnonzero(out).tolist():
            yield s, int(out[s])

    sums = map_rows(pairs.select("h", "first", "n"), weighed, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    group_of, groups = _packed({r["slot"]: r["n"] for r in sums.collect()}, slots, budget)
    return heavy, heavier, group_of, groups


def phrase_counts(
    docs: DataFrame, least: int = LEAST, words: int = WORDS, budget: int = BUDGET, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """(lang, key, words, f): phrases of one to ``words`` words with ``least`` occurrences or more; (lang, n): words in all."""
    texts = _texts(docs, text_col, lang_col)
    context = docs.sparkSession.sparkContext
    single = (
        _map_arrays(texts, _word_rows, "lang string, key binary, h long, n long")
        .groupBy("lang", "key", "h")
        .agg(F.sum("n").alias("n"))
    )
    single = written(single, "words")
    per_lang = single.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = single.where(F.col("n") >= least)
    word_bits = context.broadcast(_bitmap(frequent.select("h")))
    pairs = _map_arrays(texts, _pair_rows(word_bits), "h long, first long, n long").groupBy("h").agg(
        F.sum("n").alias("n"), F.min("first").alias("first")
    )
    pairs = written(pairs.where(F.col("n") >= least), "pairs")
    pair_bits = context.broadcast(_bitmap(pairs.select("h")))
    *plan, groups = plan_groups(frequent.select("h", "n"), pairs, budget)
    shared = context.broadcast(tuple(plan))
    leaves = _map_arrays(texts, _leaf_rows(pair_bits, shared, words), "grp int, lang string, key binary, part boolean, n long")
    order = ["grp", "lang", "key"]
    # Leaves that several tasks have in common are added up by the task that walks the subtree: they stand side by side there.
    placed = leaves.repartition(groups, "grp").sortWithinPartitions(*order).select("lang", "key", "part", "n")
    nodes = map_rows(placed, _node_rows(least), "lang string, key binary, words int, n long")
    nodes = nodes.groupBy("lang", "key", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    nodes = written(nodes, "nodes")
    for sent in (word_bits, pair_bits, shared):
        sent.unpersist()
    ones = frequent.select("lang", "key", F.lit(1).alias("words"), F.col("n").alias("f"))
    return ones.unionByName(nodes), per_lang


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, budget: int = BUDGET, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, cut): the best ``top`` phrases of each language.

    The score of a cut is floor(2000000 a / (l + r)); a phrase has that of its lowest cut. Phrases that stand almost always (80 per cent) inside
    one longer phrase are left out.
    """
    counts, per_lang = phrase_counts(docs, least, WORDS, budget, text_col, lang_col)
    counts = written(counts.select("lang", "key", "words", "f"), "counts")
    candidates = counts.where("words > 1")

    cut = map_rows(candidates.select("lang", "key", "words", "f"), _cut_rows, "lang string, key binary, a long, k int, side int, part binary")
    known = counts.select("lang", F.col("key").alias("part"), F.col("f").alias("of_part"))
    sides = written(cut.join(known, ["lang", "part"]), "cuts")
    whole = F.expr("cast(cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0)) div cast(l + r as decimal(19,0)) as long)")
    scored = (
        sides.groupBy("lang", "key", "a", "k")
        .agg(F.sum(F.when(F.col("side") == 0, F.col("of_part"))).alias("l"), F.sum(F.when(F.col("side") == 1, F.col("of_part"))).alias("r"))
        .withColumn("score", whole)
        .groupBy("lang", "key", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    longer = map_rows(candidates.where("words > 2").select("lang", "key", "words", "f"), _inner_rows, "lang string, key binary, f long")
    longer = longer.groupBy("lang", "key").agg(F.max("f").alias("inside"))
    kept = scored.join(longer, ["lang", "key"], "left").where(F.col("inside").isNull() | (F.lit(100) * F.col("inside") < F.lit(80) * F.col("a")))
    named = map_rows(
        kept.select("lang", "key", "a", "best.l", "best.r", "best.score", "best.k"),
        lambda rows: ((lang, phrase_of(key), *rest) for lang, key, *rest in rows),
        "lang string, phrase string, a long, l long, r long, score long, cut int",
    )
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(best_first).cast("long")).where(F.col("rank") <= top)
    return ranked.join(per_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def _cut_rows(source: Iterator[tuple]) -> Iterator[tuple]:
    for lang, key, n_words, a in source:
        words = key.split(b"\x00")
        for k in range(1, n_words):
            yield lang, key, a, k, 0, b"\x00".join(words[:k])
            yield lang, key, a, k, 1, b"\x00".join(words[k:])


def _inner_rows(source: Iterator[tuple]) -> Iterator[tuple]:
    """Phrases of two words or more inside a longer one, with its count."""
    for lang, key, n_words, f in source:
        words = key.split(b"\x00")
        for size in range(2, n_words):
            for at in range(n_words - size + 1):
                yield lang, b"\x00".join(words[at : at + size]), f
