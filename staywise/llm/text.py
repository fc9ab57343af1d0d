"""Words, hashes and offsets of one text at a time, over its UTF-8 bytes, and the Arrow plumbing around them.

Every function takes whole texts; memory is bounded by one text, never by a partition. Separators are ASCII, so words
can be cut out of the bytes without decoding them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_RANDOM = np.random.default_rng(20240131)
BYTE_CODE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[ord("A") : ord("Z") + 1] = BYTE_CODE[ord("a") : ord("z") + 1]
SHINGLE_CODE = _RANDOM.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64; they grow to the longest text of the worker."""
    if not _powers or len(_powers["up"]) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", _STEP), ("down", _INVERSE)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers[name] = np.multiply.accumulate(row)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the starts and ends of the words ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    apart = np.ones(len(data) + 2, bool)
    apart[1:-1] = SEPARATOR[data]
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """One 64-bit hash a word; ``lower`` folds A-Z."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers_up_to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER_CODE if lower else BYTE_CODE)[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words, in text order; a shorter text is one shingle, no words are none."""
    if not len(words):
        return words
    span = min(width, len(words))
    n = len(words) - span + 1
    total = np.full(n, span, np.uint64)
    for k in range(span):
        total += words[k : k + n] * SHINGLE_CODE[k]
    return mix(total)


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code point offsets for byte offsets that lie between characters."""
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return lead[offsets]


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def map_rows(
    df: DataFrame,
    rows: Callable[[Iterator[tuple]], Iterable[tuple]],
    schema: str,
    flush: int = 4096,
) -> DataFrame:
    """``rows`` gets the rows of a partition as an iterator of tuples and yields result rows; both sides stream.

    ``flush`` bounds the result rows held before they go to the JVM; rows with large values should be flushed early.
    """

    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[tuple]:
            for batch in batches:
                columns = batch.columns
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*(c.slice(at, 256).to_pylist() for c in columns), strict=True)

        held: list[tuple] = []
        for row in rows(source()):
            held.append(row)
            if len(held) >= flush:
                yield _batch(held, target)
                held = []
        if held:
            yield _batch(held, target)

    return df.mapInArrow(stream, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the text operators read, under fixed names; other columns never clash."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def rewrite(df: DataFrame, change: Callable[[str], str | None], text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows and columns with ``change`` applied to the text; None drops the row. A narrow pass.

    A text that ``change`` returns unaltered stays as it was (null too). ``length_col`` gets the new number of code points.
    """
    names = df.columns
    at = names.index(text_col)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                old = batch.column(at).to_pylist()
                new = [change(t or "") for t in old]
                keep = pa.array([n is not None for n in new])
                altered = [n is not None and n != (o or "") for o, n in zip(old, new, strict=True)]
                if any(altered):
                    merged = [n if a else o for o, n, a in zip(old, new, altered, strict=True)]
                    columns = batch.columns
                    columns[at] = pa.array(merged, columns[at].type)
                    if length_col is not None:
                        k = names.index(length_col)
                        sizes = zip(columns[k].to_pylist(), merged, altered, strict=True)
                        columns[k] = pa.array([len(m) if a else s for s, m, a in sizes], columns[k].type)
                    batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
                yield batch.filter(keep)

    return df.mapInArrow(stream, df.schema)
