"""Substring dedup by MinHash banding of paragraphs.

Paragraphs are the lines of a text, and blocks of ``BLOCK`` words that start at content-defined anchors, for passages that stand inside
other lines or run over several. An anchor is the word whose five-word shingle has the smallest hash among ``REACH`` neighbours, so a passage of
``BLOCK + REACH - 1`` words or more has an anchor at the same place in every text that holds it, whatever surrounds it.

1. One pass makes the paragraphs of at least ``BLOCK`` words: position, fingerprint of the words, MinHash bands. Lines have ``LINE_BANDS`` bands of
   ``ROWS`` rows (98.6 % recall at similarity 0.8), blocks have one band: they serve exact repeats, which always collide.
2. A band key found in more than one text ties its paragraphs to its first one. Keys are counted with map-side combining; a hot key is never
   gathered, each paragraph is first joined with the key's leader.
3. Paragraphs with equal fingerprints are one node. Ties of different nodes are verified by exact Jaccard similarity of their five-word shingles.
   Nodes of a key that the verified ties leave in more than one component are then compared pair by pair, in tasks of two chunks of
   ``CHUNK`` nodes. Components of all verified ties are the clusters.
4. In a cluster that spans texts the first paragraph (smallest id, then position) stays, the others are removed. Overlapping
   spans of a text are merged.

Edge cases: null, empty and short texts have no paragraphs and no rows. Rows with one id count as one text; null ids are left
out, since a removal could not name them. Empty tables give empty results. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staywise.session import written

from .components import components
from .jaccard import common
from .text import as_bytes, code_points, id_and_text, map_rows, mix, shingle_hashes, signed, word_bounds, word_hashes

WIDTH = 5
BLOCK = 32
REACH = 20
ROWS = 3
LINE_BANDS = 6
PERCENT = 80
CHUNK = 2048
MIXED_AT_ONCE = 1 << 20
FLUSH = 1 << 15  # paragraphs a task hands on at once
SEEDS = mix(np.arange(1, 1 + ROWS * LINE_BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def anchors(shingles: np.ndarray, n_words: int) -> np.ndarray:
    """Word positions where blocks start."""
    last = n_words - BLOCK
    if last < 0:
        return np.empty(0, np.int64)
    reach = min(REACH, len(shingles))
    views = np.lib.stride_tricks.sliding_window_view(shingles, reach)
    found = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return found[found <= last]


def _bands(minima: np.ndarray) -> np.ndarray:
    """Band keys from (paragraphs x ROWS * bands) minima."""
    rows = minima.reshape(len(minima), minima.shape[1] // ROWS, ROWS)
    keys = np.broadcast_to(np.arange(1, rows.shape[1] + 1, dtype=np.uint64), rows.shape[:2])
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return keys


def _minima(shingles: np.ndarray, seeds: np.ndarray, least: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """(paragraphs x seeds): ``least`` of the shingles mixed with each seed, each shingle once. Long texts take few seeds at a time."""
    step = max(1, MIXED_AT_ONCE // len(shingles))
    parts = [least(mix(shingles ^ seeds[k : k + step, None])) for k in range(0, len(seeds), step)]
    return np.concatenate(parts).T


def paragraph_arrays(text: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (start, end, words, fingerprint, band keys: a row each) of a text's blocks and of its lines of enough words."""
    data = as_bytes(text)
    starts, ends = word_bounds(data)
    n = len(starts)
    if n < BLOCK:
        return
    hashes = word_hashes(data, starts, ends)
    shingles = shingle_hashes(hashes, WIDTH)
    points = code_points(data, np.stack([starts, ends]))
    line_of = np.searchsorted(np.flatnonzero(data == 10), starts)
    heads = np.flatnonzero(np.r_[True, line_of[1:] != line_of[:-1]])
    sizes = np.diff(np.r_[heads, n])
    heads, sizes = heads[sizes >= BLOCK], sizes[sizes >= BLOCK]
    running = np.r_[np.uint64(0), np.cumsum(mix(shingles), dtype=np.uint64)]
    blocks = anchors(shingles, n)
    block_minima = _minima(
        shingles, SEEDS[:ROWS], lambda m: np.lib.stride_tricks.sliding_window_view(m, BLOCK - WIDTH + 1, axis=1)[:, blocks].min(axis=2)
    )
    groups = [(blocks, np.full(len(blocks), BLOCK), _bands(block_minima) ^ np.uint64(0x5555555555555555))]
    if len(heads):
        cuts = np.stack([heads, heads + sizes - WIDTH + 1], axis=1).ravel()
        # A last cut at the very end needs one more column, which no paragraph takes.
        line_minima = _minima(shingles, SEEDS, lambda m: np.minimum.reduceat(np.pad(m, ((0, 0), (0, 1))), cuts, axis=1)[:, 0::2])
        groups.append((heads, sizes, _bands(line_minima)))
    for first, many, keys in groups:
        # Order matters in a fingerprint: shingles carry it, their sum does not lose them.
        print_of = mix(running[first + many - WIDTH + 1] - running[first] + many.astype(np.uint64))
        from_, to = points[0][first], points[1][first + many - 1]
        yield from_, to, many, signed(print_of), signed(keys)


def paragraphs(text: str) -> Iterator[tuple[int, int, int, int, list[int]]]:
    """The same, one paragraph at a time."""
    for group in paragraph_arrays(text):
        yield from zip(*(column.tolist() for column in group), strict=True)


def _found(texts: DataFrame) -> DataFrame:
    """(id, start, end, words, print, keys) of the paragraphs of all texts; whole arrays go to the JVM."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def out() -> pa.RecordBatch:
            columns = [np.concatenate([h[k] for h in held]) for k in range(5)]
            widths = np.concatenate([np.full(len(h[0]), h[5].shape[1]) for h in held])
            flat = np.concatenate([h[5].ravel() for h in held])
            offsets = np.r_[0, np.cumsum(widths)].astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))
            columns[3] = columns[3].astype(np.int32)
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), keys], ["id", "start", "end", "words", "print", "keys"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, rows = (c.slice(at, 256).to_pylist() for c in batch.columns)
                for doc, text in zip(ids, rows, strict=True):
                    for group in paragraph_arrays(text):
                        held.append((np.full(len(group[0]), doc, np.int64), *group))
                        n += len(group[0])
                    if n >= FLUSH:
                        yield out()
                        held, n = [], 0
        if held:
            yield out()

    return texts.mapInArrow(stream, "id long, start long, end long, words int, print long, keys array<long>")


def _shingles_of(text: str, start: int, end: int) -> tuple[int, np.ndarray]:
    data = as_bytes(text[start:end])
    starts, ends = word_bounds(data)
    shingles = shingle_hashes(word_hashes(data, starts, ends), WIDTH)
    fingerprint = mix(np.array([mix(shingles).sum(dtype=np.uint64)]) + np.uint64(len(starts)))
    return int(signed(fingerprint)[0]), np.unique(signed(shingles))


def _sets(source: Iterator[tuple]) -> Iterator[tuple]:
    for fingerprint, start, end, text in source:
        found, tokens = _shingles_of(text, start, end)
        if found == fingerprint:
            yield fingerprint, tokens.tobytes()


def _similar(source: Iterator[tuple]) -> Iterator[tuple]:
    for a, b, x, y in source:
        x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
        both = common(x, y)
        if 100 * both >= PERCENT * (len(x) + len(y) - both):
            yield a, b


def _cell_links(source: Iterator[tuple]) -> Iterator[tuple]:
    """Links between parts of each cell (key, x, y); those that join nothing new in the cell are left out."""
    for (_, x, y), group in groupby(source, key=lambda r: r[:3]):
        members = list(group)
        chunk = np.array([r[3] for r in members])
        sets = [np.frombuffer(r[6], np.int64) for r in members]
        sizes = np.array([len(v) for v in sets])
        names, part = np.unique([r[5] for r in members], return_inverse=True)
        n_parts = len(names)
        tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        for i, v in enumerate(sets):
            if n_parts == 1:
                break
            low = np.searchsorted(tokens, v, "left")
            many = np.searchsorted(tokens, v, "right") - low
            at = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            both = np.bincount(owners[at], minlength=len(sets))
            near = (100 * both >= PERCENT * (sizes + len(v) - both)) & (part != part[i])
            if x != y:
                near &= chunk != chunk[i]
            for j in np.flatnonzero(near).tolist():
                if part[j] != part[i]:
                    part[part == part[j]] = part[i]
                    n_parts -= 1
                    yield members[i][4], members[j][4]


def _open_links(tied: DataFrame, sets: DataFrame, part: DataFrame) -> DataFrame:
    """Links of the nodes of a key that are in different components. ``tied``: (key, print) without the leaders, which have met all."""
    labelled = tied.join(part.withColumnRenamed("node", "print"), "print", "left").select(
        "key", "print", F.coalesce("component", "print").alias("part")
    )
    labelled = written(labelled, "labelled")
    open_keys = labelled.groupBy("key").agg(F.count("*").alias("many"), F.min("part").alias("p"), F.max("part").alias("q"))
    k = F.ceil(F.col("many") / CHUNK).cast("int")
    dealt = labelled.join(open_keys.where("p <> q").select("key", k.alias("k")), "key").withColumn(
        "c", F.pmod(F.xxhash64("print"), F.col("k")).cast("int")
    )
    cells = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")).select(
        "key", F.least("c", "other").alias("x"), F.greatest("c", "other").alias("y"), "c", "print", "part"
    )
    cell = ["key", "x", "y"]
    placed = cells.join(sets, "print").select(*cell, "c", "print", "part", "v").repartition(*cell).sortWithinPartitions(*cell)
    return map_rows(placed, _cell_links, "a long, b long")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, cluster, removed): spans that repeat across texts; the first of a cluster is not removed.

    ``cluster`` is the smallest fingerprint of the clusters that meet in the span.
    """
    texts = id_and_text(docs, id_col, text_col).where("id is not null")

    found = written(_found(texts.select(F.col("id").cast("long").alias("id"), "text")), "paragraphs")
    keyed = found.select("id", "start", "end", "print", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(
        F.min(F.struct("id", "start", "end", "print")).alias("leader"), F.max("id").alias("last")
    ).where("leader.id <> last")
    members = written(keyed.join(shared.drop("last"), "key"), "members")

    tied = members.where(F.col("leader.print") != F.col("print")).select("key", "print", F.col("leader.print").alias("b")).distinct()
    tied = written(tied, "tied")
    ties = written(tied.select(F.col("print").alias("a"), "b").distinct(), "ties")
    nodes = ties.select(F.col("a").alias("print")).union(ties.select("b")).distinct()
    # A leader is a member of its own key, so members hold an example of every node. Reduced first: a hot print leaves each task as one row.
    examples = members.groupBy("print").agg(F.min(F.struct("id", "start", "end")).alias("p")).join(nodes, "print", "left_semi")
    wanted = examples.select("print", F.col("p.id").alias("id"), F.col("p.start").alias("start"), F.col("p.end").alias("end"))
    # Of several texts with one id, those without the paragraph give no set.
    sets = written(
        map_rows(texts.join(wanted, "id").select("print", "start", "end", "text"), _sets, "print long, v binary", 512)
        .groupBy("print").agg(F.min("v").alias("v")),
        "paragraph-sets",
    )
    left = sets.select(F.col("print").alias("a"), F.col("v").alias("x"))
    right = sets.select(F.col("print").alias("b"), F.col("v").alias("y"))
    near = written(map_rows(ties.join(left, "a").join(right, "b").select("a", "b", "x", "y"), _similar, "a long, b long"), "near")
    part = written(components(near.select(F.col("a").alias("u"), F.col("b").alias("v"))), "leader-clusters")
    more = written(_open_links(tied.select("key", "print"), sets, part), "more")
    edges = part.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more.select("a", "b"))
    part = written(components(edges), "clusters")

    placed = members.select("id", "start", "end", "print").distinct().join(
        part.withColumnRenamed("node", "print"), "print", "left"
    )
    placed = written(placed.select("id", "start", "end", F.coalesce("component", "print").alias("cluster")), "placed")
    firsts = placed.groupBy("cluster").agg(F.min(F.struct("id", "start")).alias("first"), F.max("id").alias("last"))
    spans = placed.join(firsts.where("first.id <> last"), "cluster").select(
        "id", "start", "end", "cluster", (F.struct("id", "start") != F.col("first")).alias("removed")
    )
    return merged(spans)


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping spans of one text and one verdict become one."""
    order = Window.partitionBy("id", "removed").orderBy("start", F.desc("end"))
    fresh = F.coalesce(F.col("start") > F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = spans.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(order))
    return runs.groupBy("id", "removed", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("cluster").alias("cluster")
    ).select(F.col("id").alias("doc_id"), "start", "end", "cluster", "removed")
