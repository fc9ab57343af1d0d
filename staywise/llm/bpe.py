"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

The rank file (base64 token, rank; one a line) becomes a sentencepiece BPE model without any training. A token's bytes are written as characters, one
for each byte value, and its score is its negative rank, so that the best merge is the one of the lowest rank, leftmost first. The model is written as protocol
buffer bytes: pieces, the model type, and a normaliser that changes nothing. Texts are cut into pre-tokens by the pattern and each is
encoded on its own. A pre-token that is a token as a whole has that id, whatever merges lead to. Decoding looks up the pieces of the ids
and maps their characters back to bytes.

Both passes are narrow: no shuffle, one text at a time, memory bounded by one text and its ids. The model is some megabytes at any input size (the
vocabulary's size) and is sent once. Workers remember the ids of short pre-tokens, up to ``MEMORY`` of them; that changes speed only.

Edge cases: null and empty texts have no ids and decode to empty bytes. Rows are kept as they come: null ids, repeated ids and repeated texts too.
Only the id and the text are read, so other columns never clash. An empty table gives an empty result. Ids outside the
vocabulary raise when decoded; null id lists decode to empty bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Byte b is written as this character plus b: two-byte letters, none of which the model treats specially.
FIRST_CHARACTER = 0x100
MEMORY = 1 << 18
LONGEST_REMEMBERED = 48
IDS_A_BATCH = 1 << 20

# Fixed values of the model format: field numbers and kinds.
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND, UNKNOWN_KIND = 1, 2, 3, 2
MODEL_TYPE, MODEL_SIZE, BPE_MODEL = 3, 4, 2
RULE_NAME, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _integer(field: int, n: int) -> bytes:
    return _number(field << 3) + _number(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _number(field << 3 | 2) + _number(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _number(field << 3 | 5) + struct.pack("<f", value)


def as_characters(token: bytes) -> str:
    return "".join(chr(FIRST_CHARACTER + b) for b in token)


def as_token(piece: str) -> bytes:
    return bytes(ord(c) - FIRST_CHARACTER for c in piece)


def model_bytes(tokens: list[bytes]) -> bytes:
    """The serialised model of tokens in order of rank; the unknown piece that the format asks for comes last."""
    if len(tokens) >= 1 << 24:
        raise ValueError("ranks from 2**24 on are not exact as scores")
    out = []
    for rank, token in enumerate(tokens):
        piece = _bytes(PIECE_TEXT, as_characters(token).encode()) + _float(PIECE_SCORE, -float(rank))
        out.append(_bytes(PIECES, piece))
    out.append(_bytes(PIECES, _bytes(PIECE_TEXT, b"<unk>") + _float(PIECE_SCORE, 0.0) + _integer(PIECE_KIND, UNKNOWN_KIND)))
    out.append(_bytes(TRAINER, _integer(MODEL_TYPE, BPE_MODEL) + _integer(MODEL_SIZE, len(tokens) + 1)))
    unchanged = b"".join(_integer(f, 0) for f in (DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES))
    out.append(_bytes(NORMALISER, _bytes(RULE_NAME, b"identity") + unchanged))
    return b"".join(out)


@dataclass(frozen=True)
class Vocabulary:
    """A serialised model, the id of each of its pieces, and the pattern of pre-tokens."""

    model: bytes
    ids: tuple[int, ...]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From a rank file on the driver."""
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        return cls.of_ranks({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    @classmethod
    def of_ranks(cls, ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a rank: {missing[:8]}")
        tokens = sorted(ranks, key=ranks.__getitem__)
        return cls(model_bytes(tokens), tuple(ranks[t] for t in tokens), pattern)


class Codec:
    """Encodes and decodes one text at a time."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
        self.pretokens = regex.compile(vocabulary.pattern).findall
        self.id_of = vocabulary.ids
        tokens = [as_token(p) for p in self.model.id_to_piece(list(range(len(self.id_of))))]
        self.whole = dict(zip(tokens, self.id_of, strict=True))
        self.characters = {b: chr(FIRST_CHARACTER + b) for b in range(256)}
        self.known: dict[str, tuple[int, ...]] = {}
        ids = np.array(self.id_of, np.int64)
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        sizes = np.array([len(t) for t in tokens], np.int64)
        self.size = np.full(int(ids.max()) + 1, -1, np.int64)
        self.size[ids] = sizes
        self.start = np.zeros(len(self.size), np.int64)
        self.start[ids] = np.cumsum(sizes) - sizes

    def _learn(self, pretokens: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of pre-tokens that are not remembered."""
        found, rest, mapped = {}, [], []
        for p in pretokens:
            data = p.encode("utf-8", "surrogatepass")
            whole = self.whole.get(data)
            if whole is not None:
                found[p] = (whole,)
            else:
                rest.append(p)
                mapped.append(data.decode("latin-1").translate(self.characters))
        if rest:
            for p, pieces in zip(rest, self.model.encode(mapped, out_type=int, num_threads=1), strict=True):
                found[p] = tuple(self.id_of[k] for k in pieces)
        return found

    def encode(self, text: str) -> list[int]:
        pretokens = self.pretokens(text)
        known = self.known
        missing = set(pretokens).difference(known)
        table = known
        if missing:
            fresh = self._learn(missing)
            if len(known) > MEMORY:
                known.clear()
                fresh |= self._learn({p for p in pretokens if p not in fresh})
            known.update((p, ids) for p, ids in fresh.items() if len(p) <= LONGEST_REMEMBERED)
            table = known if all(len(p) <= LONGEST_REMEMBERED for p in fresh) else known | fresh
        return list(chain.from_iterable(map(table.__getitem__, pretokens)))

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in order, and where each id's bytes end."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or (self.size[ids] < 0).any()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[ids] - (ends - sizes), sizes)
        return self.blob[at], ends


_codecs: dict[int, Codec] = {}


def _worker_codec(shared) -> Codec:
    """One codec a worker and broadcast."""
    if shared.bid not in _codecs:
        _codecs.clear()
        _codecs[shared.bid] = Codec(shared.value)
    return _codecs[shared.bid]


class _Shared:
    """A broadcast vocabulary, with a number by which a worker finds its codec again."""

    def __init__(self, df: DataFrame, vocabulary: Vocabulary) -> None:
        self.broadcast = df.sparkSession.sparkContext.broadcast(vocabulary)
        self.bid = self.broadcast._jbroadcast.id()

    def __getstate__(self) -> dict:
        return {"broadcast": self.broadcast, "bid": self.bid}

    @property
    def value(self) -> Vocabulary:
        return self.broadcast.value


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text, without special tokens."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = _Shared(docs, vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker_codec(shared)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            flat: list[np.ndarray] = []
            ends, first, held = [0], 0, 0
            for row in range(batch.num_rows):
                ids = codec.encode(texts[row].as_py() or "")
                flat.append(np.array(ids, np.int32))
                held += len(ids)
                ends.append(held)
                if held >= IDS_A_BATCH or row == batch.num_rows - 1:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat), pa.int32()))
                    yield pa.RecordBatch.from_arrays([names.slice(first, row + 1 - first), lists], ["id", "ids"])
                    flat, ends, first, held = [], [0], row + 1, 0

    return slim.mapInArrow(stream, f"id {id_type}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(id, ids, decoded): the bytes that the ids stand for."""
    shared = _Shared(encoded, vocabulary)
    id_type = encoded.schema["id"].dataType.simpleString()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker_codec(shared)
        for batch in batches:
            # One text at a time: a text's bytes and their places are all that is held.
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                ids = part.column(1).flatten().to_numpy(zero_copy_only=False)
                data, _ = codec.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([data.tobytes()], pa.binary())], ["id", "ids", "decoded"]
                )

    return encoded.select("id", "ids").mapInArrow(stream, f"id {id_type}, ids array<int>, decoded binary")


def digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, after a round trip."""
    both = decode(encode(docs, vocabulary, id_col, text_col), vocabulary)
    return both.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
