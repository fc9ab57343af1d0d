"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

1. One pass over the texts makes each row's shingle set (64-bit hashes): its size, a 128-bit digest of the set, a bitmap
   and the tokens that can be needed as join keys. The result is written once.
2. Rows with equal sets form a class; only one row of each goes on. Copies are never expanded into pairs.
3. Prefix filter, rarest tokens first. Sets that reach the threshold share a token among the first ``n - ceil(t n) + 1`` in any
   order that is the same for all sets. The order here: tokens of the key zone (the lowest part of the hash space) by document
   frequency, then the others. Tokens of one set only come first, so a set that has enough of them needs no partner search at all,
   and common passages stand last. One shuffle by token counts frequencies; everything after it is small.
4. Tiles: a token and a size band. Sizes of linked sets differ by the threshold at most, so a tile meets itself and the next.
   First each set is compared with the tile's leader only (linear in the tile), and links found are merged into components. Then
   sets of one tile that are still in different components are compared: in small tiles as joined pairs; in larger ones inside tasks, chunk by
   chunk, first by their bitmaps alone; arrays travel only to where a set meets one of another component that the bitmaps cannot
   rule out, and only links that join two components become rows. A group of near copies thus gives
   fewer rows than it has members, however many of its pairs are links. Of tiles with the same rows only one is compared.
5. A pair is tested first by its bitmaps: each bit in which they differ is at least one element in which the sets differ, which
   bounds the overlap from above. Bitmaps are folded to the narrower width. Only then the sorted arrays are intersected.

Texts, bitmaps and arrays are large beside row numbers. Where few of their rows are asked for, ``presence`` picks those that may be,
so that the others are not shuffled for a join that drops them.

No candidate is dropped: the filters are bounds. Different shingles are told apart by 64 bits, different sets by 128.

Edge cases: null or word-free texts have an empty set and link with nothing, not even each other. Rows are told apart
by a row number of the written table, so repeated rows, repeated ids and null ids are kept; rows with one id count as one document. A row with
a null id takes part; its component is the smallest id reached, null if there is none. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.session import scratch, written

from .components import components
from .presence import presence
from .text import as_bytes, id_and_text, map_rows, mix, shingle_hashes, signed, word_bounds, word_hashes

SMALL_TILE = 16  # larger tiles are compared inside tasks
CHUNK = 1 << 20  # elements of all sets of a chunk; a task holds two chunks
MAP_CHUNK = 1 << 22  # the same for bitmaps, of which an element takes a byte at most
ROW_COST = 256  # elements that a row counts for beside its own in a chunk of bitmaps, so that short sets are not too many
BLOCK = 32  # sets intersected at once
KEY_ZONE = 0.2  # share of the hash space whose tokens serve as join keys; a wider zone only costs more rows


def shingle_set(text: str, width: int) -> np.ndarray:
    data = as_bytes(text)
    return np.unique(shingle_hashes(word_hashes(data, *word_bounds(data)), width))


def bitmap(tokens: np.ndarray) -> bytes:
    """One bit a hashed element; the width is a power of two of four to eight bits an element, 64 at least."""
    width = 1 << max(6, (4 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(tokens >> np.uint64(8)) & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_or.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _signed_rows(width: int, percent: int):
    limit = np.uint64(int(KEY_ZONE * 2**64))

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for number, doc, text in source:
            tokens = shingle_set(text, width)
            n = len(tokens)
            if not n:
                yield number, doc, 0, 0, 0, None, []
                continue
            keys = max(int(np.searchsorted(tokens, limit)), _prefix_length(n, percent))
            yield number, doc, n, *_digest(tokens), bitmap(tokens), signed(tokens[:keys]).tolist()

    return rows


def signatures(docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n, low, high, bits, keys) of each row, written."""
    source = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "id", "text")
    return written(
        map_rows(
            source,
            _signed_rows(width, percent),
            "row long, id long, n long, low long, high long, bits binary, keys array<long>",
            flush=512,
        ),
        "sets",
    )


def _band(percent: int) -> Column:
    """Sets whose sizes lie within the threshold are in one band or in neighbouring ones."""
    return F.floor(F.log(F.col("n").cast("double")) / -math.log(percent / 100) + 1e-9).cast("int")


def _prefixes(heads: DataFrame, percent: int) -> DataFrame:
    """(row, n, token, band): prefix tokens that at least two sets have."""
    from pyspark.sql import Window

    limit = int(KEY_ZONE * 2**64)
    rows = heads.select("row", F.explode("keys").alias("token"))
    shared = rows.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    of_row = shared.join(heads.select("row", "n", F.size("keys").alias("emitted")), "row")
    # Hashes are unsigned and stored signed, so those outside the zone are either above its limit or negative.
    in_zone = (F.col("token") >= 0) & (F.col("token") < limit) if limit < 2**63 else F.lit(True)
    outside = ~in_zone
    by_rarity = Window.partitionBy("row").orderBy(outside, F.when(outside, F.lit(0)).otherwise(F.col("df")), "token")
    whole = Window.partitionBy("row")
    needed = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    ranked = of_row.select(
        "*",
        F.row_number().over(by_rarity).alias("place"),
        F.count("*").over(whole).alias("many"),
    )
    return ranked.where(F.col("place") <= needed - (F.col("emitted") - F.col("many"))).select(
        "row", "n", "token", _band(percent).alias("band")
    )


def _bound(percent: int):
    """Keeps pairs that the bitmaps allow to reach the threshold."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for a, b, n, m, x, y in source:
            most = (n + m - differing_bits(x, y)) // 2
            if 100 * most >= percent * (n + m - most):
                yield a, b

    return rows


def _exact(percent: int):
    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for a, b, x, y in source:
            x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
            both = common(x, y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                yield a, b

    return rows


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of the set, whatever the order of its elements."""
    low = mix(tokens).sum(dtype=np.uint64)
    high = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(low.view(np.int64)), int(high.view(np.int64))


def _arrays(width: int):
    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for _, text in source:
            tokens = shingle_set(text, width)
            if len(tokens):
                yield *_digest(tokens), np.sort(signed(tokens)).tobytes()

    return rows


def _allowed(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their bitmaps allow to reach the threshold, written."""
    pairs = written(pairs, "pairs")
    sides, _ = presence(_ends(pairs))(heads.select("row", "n", "bits"), "row")
    left = sides.select(F.col("row").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    right = sides.select(F.col("row").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    tested = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "xa", "xb")
    return written(map_rows(tested, _bound(percent), "a long, b long"), "allowed")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("row")).union(pairs.select("b"))


def _arrays_of(rows: DataFrame, heads: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(row, v): the sorted array of each row named, written."""
    ends = heads.join(rows.distinct(), "row", "left_semi").select("row", F.col("id").alias("of"), "low", "high")
    ends = written(ends, "ends")
    # Texts are the largest column, so only those that may be wanted travel.
    perhaps, _ = presence(ends.select("of"))(texts, "id")
    wanted = perhaps.join(ends.select("of").distinct(), perhaps["id"].eqNullSafe(F.col("of")), "left_semi")
    # A row is found again by its id and the digest of its set, so nothing depends on the order of a second scan.
    arrays = map_rows(wanted.select("id", "text"), _arrays(width), "low long, high long, v binary", 256)
    arrays = arrays.dropDuplicates(["low", "high"])
    return written(arrays.join(ends, ["low", "high"]).select("row", "v"), "arrays")


def _linked(allowed: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    joined = allowed.join(arrays.select(F.col("row").alias("a"), F.col("v").alias("va")), "a").join(
        arrays.select(F.col("row").alias("b"), F.col("v").alias("vb")), "b"
    )
    return map_rows(joined.select("a", "b", "va", "vb"), _exact(percent), "a long, b long")


def _near_sizes(n: str, m: str, percent: int) -> Column:
    return F.lit(100) * F.least(F.col(n), F.col(m)) >= F.lit(percent) * F.greatest(F.col(n), F.col(m))


def _offered(labelled: DataFrame) -> DataFrame:
    """Rows of each tile: those of its own band, and those of the next band as the other side only; with the tile's size. Written.

    Of tiles of one band with the same rows one is enough; the rows are told apart by 128 bits.
    """
    own = labelled.withColumn("own", F.lit(True))
    offered = own.union(labelled.withColumn("band", F.col("band") - 1).withColumn("own", F.lit(False)))
    sizes = written(
        offered.groupBy("token", "band")
        .agg(
            F.count("*").alias("many"),
            F.max("own").alias("any_own"),
            F.min("row").alias("least"),
            F.bit_xor(F.xxhash64("row", "own")).alias("x"),
            F.bit_xor(F.xxhash64("own", "row", F.lit(1))).alias("y"),
        )
        .where("many > 1 and any_own")
        .groupBy("band", "many", "least", "x", "y")
        .agg(F.min("token").alias("token")),
        "tile_sizes",
    )
    return written(offered.join(sizes.select("token", "band", "many", "least"), ["token", "band"]), "offered")


def _small_tiles(offered: DataFrame, percent: int) -> DataFrame:
    """Pairs of tiles of up to ``SMALL_TILE`` rows: at most so many partners a row."""
    small = offered.where(F.col("many") <= SMALL_TILE)
    left = small.where("own").select("token", "band", *(F.col(c).alias(f"{c}_a") for c in ("row", "n", "part")))
    right = small.select("token", "band", "own", *(F.col(c).alias(f"{c}_b") for c in ("row", "n", "part")))
    return (
        left.join(right, ["token", "band"])
        .where("part_a <> part_b and (not own or row_a < row_b)")
        .where(_near_sizes("n_a", "n_b", percent))
        .select(F.least("row_a", "row_b").alias("a"), F.greatest("row_a", "row_b").alias("b"))
        .distinct()
    )


KEY = ["least", "band", "x", "y"]


def _cells(tiles: DataFrame, weight: Column, chunk: int) -> DataFrame:
    """Tiles of more than one component, dealt to tasks as pairs of chunks of ``chunk`` at most by the sum of ``weight``."""
    sizes = tiles.groupBy("least", "band").agg(F.sum(weight).alias("sum"), F.min("part").alias("p"), F.max("part").alias("q"))
    k = F.ceil(F.col("sum") / chunk).cast("int").alias("k")
    sizes = written(sizes.where("p <> q").select("least", "band", k), "united_sizes")
    dealt = tiles.join(sizes, ["least", "band"]).withColumn("c", F.pmod(F.xxhash64("row"), "k").cast("int"))
    return dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))


def _placed(cells: DataFrame, data: DataFrame) -> DataFrame:
    """The rows of each cell together, with the last column of ``data`` (row, …)."""
    perhaps, _ = presence(cells.select("row"))(data, "row")
    cells = cells.join(perhaps, "row").select(
        "least", "band", F.least("c", "other").alias("x"), F.greatest("c", "other").alias("y"),
        "c", "row", "n", "part", "own", data.columns[-1],
    )
    return cells.repartition(*KEY).sortWithinPartitions(*KEY)


def _meeting(offered: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Rows of larger tiles that meet a row of another component there which the bitmaps cannot rule out, written.

    Tokens of one shared passage have nearly the same rows, so the tiles of a band that have their least row in common are united: a
    row goes where that passage is compared once, not once a token. Only bitmaps travel, a tenth of the arrays or less, and
    a tile gives each of its rows once at most, however many of its pairs are near.
    """
    large = offered.where(F.col("many") > SMALL_TILE)
    large = written(large.select("least", "band", "row", "n", "part", "own").distinct(), "united")
    placed = _placed(_cells(large, F.col("n") + ROW_COST, MAP_CHUNK), heads.select("row", "bits"))
    shape = "least long, band int, row long, n long, part long, own boolean"
    return written(map_rows(placed, _cell_meetings(percent), shape).distinct(), "meeting")


def _large_tiles(meeting: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of larger tiles that join components: fewer than a cell has rows, however many of its pairs are links.

    ``CHUNK`` elements of sets bound a chunk, so long sets make it shorter.
    """
    # Bitmaps are made again from the arrays: that costs less than sending them along.
    return map_rows(_placed(_cells(meeting, F.col("n"), CHUNK), arrays), _cell_links(percent), "a long, b long")


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows x bytes) folded to ``width`` bytes."""
    return bits if bits.shape[1] == width else np.bitwise_or.reduce(bits.reshape(len(bits), -1, width), axis=1)


def _reach(both: np.ndarray, sizes: np.ndarray, n: int, percent: int) -> np.ndarray:
    return 100 * both >= percent * (n + sizes - both)


class _Cell:
    """The rows of one cell, by size, so that bitmaps of one width lie together and are compared as one array."""

    def __init__(self, within: bool, members: list[tuple], maps: list[bytes]):
        self.within = within
        self.cs, self.ids, self.sizes, self.parts, self.owns = (np.array([r[k] for r in members]) for k in (4, 5, 6, 7, 8))
        self.maps = maps
        widths = np.array([len(m) for m in maps])
        self.groups = []
        for width in np.unique(widths).tolist():
            first, end = np.searchsorted(widths, [width, width + 1])
            data = b"".join(maps[first:end])
            self.groups.append((int(first), int(end), np.frombuffer(data, np.uint8).reshape(end - first, width)))

    def near(self, i: int, percent: int, but: np.ndarray | None = None) -> np.ndarray:
        """Places of the rows of other components that the bitmaps allow to link with row ``i``, those marked in ``but`` left out."""
        sizes, n, mine = self.sizes, self.sizes[i], np.frombuffer(self.maps[i], np.uint8)[None]
        # Two rows of one chunk meet in that chunk's own cell only; own pairs are met once.
        ask = (self.parts != self.parts[i]) & (~self.owns | (self.ids > self.ids[i]))
        ask &= 100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)
        if not self.within:
            ask &= self.cs != self.cs[i]
        if but is not None:
            ask &= ~but
        found = []
        for first, end, bits in self.groups:
            at = np.flatnonzero(ask[first:end])
            if len(at):
                width = min(bits.shape[1], mine.shape[1])
                apart = np.bitwise_count(_folded(bits[at], width) ^ _folded(mine, width)).sum(axis=1, dtype=np.int64)
                at += first
                found.append(at[_reach((sizes[at] + n - apart) // 2, sizes[at], n, percent)])
        return np.concatenate(found) if found else np.empty(0, np.int64)


def _by_cell(of_cell):
    from itertools import groupby

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for (_, _, x, y), group in groupby(source, key=lambda r: r[:4]):
            yield from of_cell(x == y, sorted(group, key=lambda r: r[6]))

    return rows


def _cell_meetings(percent: int):
    def of_cell(within: bool, members: list[tuple]) -> Iterator[tuple]:
        cell = _Cell(within, members, [r[9] for r in members])
        met = np.zeros(len(members), bool)
        for i in np.flatnonzero(cell.owns).tolist():
            near = cell.near(i, percent, met if met[i] else None)
            if len(near):
                met[near] = met[i] = True
        for i in np.flatnonzero(met).tolist():
            yield *members[i][:2], *members[i][5:9]

    return _by_cell(of_cell)


def _cell_links(percent: int):
    def of_cell(within: bool, members: list[tuple]) -> Iterator[tuple]:
        sets = [np.frombuffer(r[9], np.int64) for r in members]
        cell = _Cell(within, members, [bitmap(v.view(np.uint64)) for v in sets])
        ids, sizes, parts = cell.ids, cell.sizes, cell.parts
        for i in np.flatnonzero(cell.owns).tolist():
            left = cell.near(i, percent)
            while len(left := left[parts[left] != parts[i]]):
                block, left = left[:BLOCK], left[BLOCK:]
                values = np.concatenate([sets[j] for j in block])
                place = np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)
                both = np.add.reduceat(sets[i][place] == values, np.cumsum(sizes[block]) - sizes[block], dtype=np.int64)
                for j in block[_reach(both, sizes[block], sizes[i], percent)].tolist():
                    if parts[j] != parts[i]:
                        yield int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))
                        parts[parts == parts[j]] = parts[i]

    return _by_cell(of_cell)


def _merged_by_leaders(tiles: DataFrame, heads: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) after each row was compared with the leaders of its tiles only."""
    leaders = written(tiles.groupBy("token", "band").agg(F.min(F.struct("row", "n")).alias("leader")), "leaders")
    first = (
        tiles.join(leaders, ["token", "band"])
        .where(F.col("leader.row") != F.col("row"))
        .select(F.col("leader.row").alias("a"), F.col("row").alias("b"), F.col("leader.n").alias("na"), "n")
        .where(_near_sizes("na", "n", percent))
        .select("a", "b")
        .distinct()
    )
    allowed = _allowed(first, heads, percent)
    found = written(_linked(allowed, _arrays_of(_ends(allowed), heads, texts, width), percent), "links")
    return components(found.select(F.col("a").alias("u"), F.col("b").alias("v")))


def links(signed_sets: DataFrame, texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(class members: row, head), (component of linked heads: node, component)."""
    whole = signed_sets.where("n > 0")
    # Aggregates are written before they are joined back: only then can AQE split a hot key.
    classes = written(whole.groupBy("n", "low", "high").agg(F.min("row").alias("head")), "heads")
    members = written(
        whole.select("row", "n", "low", "high").join(classes, ["n", "low", "high"]).select("row", "head"), "classes"
    )
    copies = members.where("row <> head").select("row")
    perhaps, single = presence(copies)(whole, "row")
    heads = single.union(perhaps.join(copies, "row", "left_anti"))
    tiles = written(_prefixes(heads, percent), "tiles")
    # Joined with rows of ``tiles`` only, so copies need not be left out.
    slim = whole.select("row", "id", "n", "low", "high", "bits")

    with scratch(texts.sparkSession) as keep:
        merged = keep(_merged_by_leaders(tiles, slim, texts, width, percent), "merged")

    labelled = tiles.join(merged.withColumnRenamed("node", "row"), "row", "left").select(
        "row", "n", "token", "band", F.coalesce("component", "row").alias("part")
    )
    open_tokens = labelled.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q")
    open_tokens = written(open_tokens.select("token"), "open")
    offered = _offered(labelled.join(open_tokens, "token", "left_semi"))
    allowed = _allowed(_small_tiles(offered, percent), slim, percent)
    meeting = _meeting(offered, slim, percent)
    arrays = _arrays_of(_ends(allowed).union(meeting.select("row")), slim, texts, width)
    more = _linked(allowed, arrays, percent).union(_large_tiles(meeting, arrays, percent))
    more = written(more, "links")
    edges = merged.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more.select("a", "b"))
    return members, components(edges)


def jaccard_components(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; ``percent`` is the threshold in whole per cent.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.
    """
    with scratch(docs.sparkSession) as keep:
        sets = signatures(docs, width, percent, id_col, text_col)
        texts = id_and_text(docs, id_col, text_col)
        members, linked = links(sets, texts, width, percent)
        # Rows with one id are one document.
        twins = sets.where("id is not null").groupBy("id").agg(F.min("row").alias("first"), F.count("*").alias("n_rows"))
        twins = written(twins.where("n_rows > 1"), "twins")
        same = sets.join(twins, "id").select(F.col("row").alias("u"), F.col("first").alias("v"))
        edges = (
            members.where("row <> head")
            .select(F.col("row").alias("u"), F.col("head").alias("v"))
            .union(linked.select("node", "component"))
            .union(same)
        )
        part = written(components(edges), "parts")
        labelled = keep(
            sets.select("row", F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"))
            .join(part.select(F.col("node").alias("row"), "component"), "row", "left")
            .withColumn("component", F.coalesce("component", "row")),
            "labelled",
        )
    least = written(labelled.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    return labelled.join(least, "component").select("doc_id", "n_shingles", "component_id")


def one_of_each(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of one document of each component, the one with the smallest id, all columns as they are.

    Of rows that repeat an id one stays. Rows with a null id stay: no link can name them.
    """
    labelled = written(jaccard_components(docs, width, percent, id_col, text_col), "components")
    gone = labelled.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    again = labelled.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
    again = again.select(F.col("doc_id").alias("_again"))
    # Most rows are sure to stay as they are; only the others travel, whole texts and all. No id is in both lists.
    either = gone.select(F.col("_gone").alias("_id")).union(again)
    perhaps, sure = presence(either)(docs, id_col)
    single = perhaps.join(either, F.col(id_col) == F.col("_id"), "left_anti")
    repeated, _ = presence(again)(docs, id_col)
    return sure.union(single).union(repeated.join(again, F.col(id_col) == F.col("_again"), "left_semi").dropDuplicates([id_col]))
