"""Secret scan: a linear-chain conditional random field tags tokens as secret begin, inside or outside.

Tokens are runs of ``[A-Za-z0-9+/_.=-]`` and runs of marks between them. Features are the token's shape (length class,
character classes, mixing, entropy class, share of vowels), the words beside it (hashed, and whether one names a key), quotes and marks, and
features of the whole text (key words, density of such tokens).

The field is decoded exactly over whole texts without visiting plain tokens one by one: a token without a digit, shorter
than ``LONG`` and not next to a key word has only the label "outside", by a hard constraint that is part of the model. Such a token splits the
chain, and what lies between two of them is decoded by Viterbi on its own; a text's best labelling is the union of these.

Training: different texts of a bounded sample, tokens labelled by the base patterns, penalised likelihood. Labels of the patterns alone would only
teach the patterns, so each secret also enters in changed forms: behind another key word, as letters only, as a long random
token with its key word masked; and plain words of the same text enter behind key words, and joined to paths, as tokens that are none. ``TRAIN_TEXTS`` bounds the sample.

Spans: those of the base patterns always stay; decoded spans that no base span touches are added as kind ``model``. Offsets are code
points, ends exclusive. Null and empty texts have no spans. Rows are independent: repeated rows, null ids and empty tables are fine.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .text import id_and_text, map_rows

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the longest runs; a shorter run fails, and so does every part of it

LONG = 20
TRAIN_TEXTS = 2000
MOST_CHAINS = 6000
OUTSIDE, BEGIN, INSIDE = 0, 1, 2

# A run that can carry a secret: at least one digit and six characters, or LONG characters.
RUN = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{5,}")
DIGIT = re.compile(r"[0-9]")
LONG_RUN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LONG},}}")
KEY_BEFORE = re.compile(r"""([A-Za-z_]+)["']?\x20*[:=]?\x20*["']?$""")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2], x[1]))]


_BODY = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
_DIGITS = re.compile(r"[0-9]+")
KEY_STEMS = "pass|pwd|secret|token|key|auth|cred|sign|bearer"
# A word that names a key, then quotes, a mark or a space, then the token; the token itself is only looked at.
_BESIDE_KEY = re.compile(
    rf"""(?:{KEY_STEMS})[A-Za-z_]{{0,24}}["']?(?:\x20{{0,4}}[:=]|\x20is\b|(?=\x20))\x20{{0,4}}["']?(?=([A-Za-z0-9+/_.=-]{{6}}))""", re.IGNORECASE
)


def open_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens that may be labelled otherwise than outside, in order; linear in the text."""
    found, at, n = [], 0, len(text)
    spots = [m.start() for m in _DIGITS.finditer(text)]
    spots += [m.start() for m in LONG_RUN.finditer(text)]
    spots += [m.start(1) for m in _BESIDE_KEY.finditer(text)]
    for spot in sorted(spots):
        if spot < at:
            continue
        start, end = spot, spot
        while start > at and text[start - 1] in _BODY:
            start -= 1
        while end < n and text[end] in _BODY:
            end += 1
        at = end
        token = text[start:end]
        key = token.rfind("=", 0, len(token.rstrip("=")))
        if key > 0 and start + key < end - 1:
            start += key + 1
        token = token.strip(".")
        while start < end and text[start] == ".":
            start += 1
        while end > start and text[end - 1] == ".":
            end -= 1
        if end - start >= 6:
            found.append((start, end))
    return found


FEATURES: dict[str, int] = {}
WORD_BUCKETS = 64
# A part of a path or name: a word in one case or capitalised, or a short number.
_PLAIN_PART = re.compile(r"(?<![A-Za-z0-9])(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,8})(?![A-Za-z0-9])")
_LEFT_WORD = re.compile(r"([^\W\d_]+)[\W_]*$")
_RIGHT_WORD = re.compile(r"[\W_]*([^\W\d_]+)")


def _bucket(word: str) -> int:
    return zlib.crc32(word.lower().encode()) % WORD_BUCKETS


def _feature_names() -> list[str]:
    names = ["always"]
    names += [f"length {k}" for k in range(8)] + [f"entropy {k}" for k in range(6)]
    names += [f"classes {k}" for k in range(8)] + [f"changes {k}" for k in range(5)]
    names += ["all hex", "all digits", "dots", "dashes", "joined"]
    names += ["letters only"] + [f"plain parts {k}" for k in range(6)] + [f"vowels {k}" for k in range(6)] + [f"{side} word {k}" for side in ("left", "right") for k in range(WORD_BUCKETS)]
    names += ["key mark before", "quote before", "quote after", "key word before", "key word near", "first of text"]
    names += [f"file open {k}" for k in range(4)] + ["file has key words"]
    return names


FEATURES.update({name: k for k, name in enumerate(_feature_names())})
KEY_WORDS = re.compile(KEY_STEMS, re.IGNORECASE)


def _entropy(token: str) -> float:
    counts = np.array([token.count(c) for c in set(token)], float) / len(token)
    return float(-(counts * np.log2(counts)).sum())


def features(text: str, start: int, end: int, file: list[int]) -> list[int]:
    token = text[start:end]
    n = end - start
    upper, lower, digit = (bool(re.search(p, token)) for p in ("[A-Z]", "[a-z]", "[0-9]"))
    kinds = re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"[0-9]", "0", token)))
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, len(kinds) - 1)
    before = text[max(0, start - 24) : start]
    on = [
        "always",
        f"length {min(7, int(math.log2(n)) if n < 16 else int(n // 8) + 2 if n < 40 else 7)}",
        f"entropy {min(5, int(_entropy(token)))}",
        f"classes {upper * 4 + lower * 2 + digit}",
        f"changes {min(4, int(changes * 8))}",
    ]
    if re.fullmatch(r"[0-9a-f]+", token):
        on.append("all hex")
    if re.fullmatch(r"[0-9.\-/]+", token):
        on.append("all digits")
    if "." in token:
        on.append("dots")
    if "-" in token or "/" in token:
        on.append("dashes")
    if start > 0 and not text[start - 1].isspace():
        on.append("joined")
    key = KEY_BEFORE.search(before)
    if re.search(r"""[:=]\x20*["']?$""", before):
        on.append("key mark before")
    if before[-1:] in "\"'" and before:
        on.append("quote before")
    if text[end : end + 1] in ('"', "'"):
        on.append("quote after")
    if key and KEY_WORDS.search(key[1]):
        on.append("key word before")
    if KEY_WORDS.search(before):
        on.append("key word near")
    if start == 0:
        on.append("first of text")
    letters = sum(c.isalpha() for c in token)
    if letters == n:
        on.append("letters only")
    if letters:
        on.append(f"vowels {int(5 * sum(token.count(c) for c in 'aeiouAEIOU') / letters)}")
    parts = _PLAIN_PART.findall(token)
    on.append(f"plain parts {int(5 * sum(map(len, parts)) / max(1, len(re.sub('[+/_.=-]', '', token))))}")
    if left := _LEFT_WORD.search(before):
        on.append(f"left word {_bucket(left[1])}")
    if right := _RIGHT_WORD.match(text[end : end + 24]):
        on.append(f"right word {_bucket(right[1])}")
    return [FEATURES[name] for name in on] + file


def file_features(text: str, n_open: int) -> list[int]:
    share = n_open * 400 / max(400, len(text))
    on = [FEATURES[f"file open {min(3, int(share))}"]]
    if KEY_WORDS.search(text):
        on.append(FEATURES["file has key words"])
    return on


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Runs of open tokens with nothing but marks and spaces between them."""
    runs: list[list[tuple[int, int]]] = []
    for span in open_tokens(text):
        if runs and not re.search(r"\w", text[runs[-1][-1][1] : span[0]]):
            runs[-1].append(span)
        else:
            runs.append([span])
    return runs


def _labelled(text: str, spans: list[tuple[int, int]], file: list[int] | None = None) -> Iterator[tuple[list[list[int]], list[int]]]:
    """Training chains of a text: tokens inside one of the spans are secrets."""
    runs = chains(text)
    if file is None:
        file = file_features(text, sum(map(len, runs)))
    for run in runs:
        labels = []
        for start, end in run:
            hit = any(s < end and start < e for s, e in spans)
            labels.append((INSIDE if labels and labels[-1] != OUTSIDE else BEGIN) if hit else OUTSIDE)
        for at in range(0, len(run), 32):
            yield [features(text, *span, file) for span in run[at : at + 32]], labels[at : at + 32]


_KEYS = ("pwd", "pass", "passphrase", "auth", "credential", "client_key", "bearer", "signing key", "secret", "token")
_MARKS = (": ", "=", " = ", ': "', " ", " is ")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_MIXED = _LETTERS + _LETTERS.upper() + "0123456789"
_PLAIN = re.compile(r"(?<![\w.-])[A-Za-z]{6,19}(?![\w.-])")
_CONTEXT = 60


def _changed(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """The surroundings of each secret with the secret in changed forms, and of plain words of the text behind key words; seeded by the text."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    pick = lambda letters, low, high: "".join(rng.choices(letters, k=rng.randint(low, high)))
    plain = [m[0] for m in _PLAIN.finditer(text) if not KEY_WORDS.search(m[0])]
    for start, end, kind in spans:
        found = ASSIGN.match(text, start) if kind == KINDS[0] else None
        value = found[2] if found else text[start:end]
        before, after = text[max(0, start - _CONTEXT) : start], text[end : end + _CONTEXT]
        key = lambda: rng.choice(_KEYS) + rng.choice(_MARKS)
        words = "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") + rng.choice(("", "n", "r", "st")) for _ in range(rng.randint(3, 5)))
        forms = [
            (key(), value),
            (key(), pick(_MIXED, 8, 40)),
            (rng.choice(_KEYS) + rng.choice(_MARKS[:4]), words),
            (key(), pick(_LETTERS, 8, 16).capitalize()),
            ("", rng.choice(("", pick(_LETTERS, 2, 4) + "_")) + pick(_MIXED, 30, 60)),
        ]
        for lead, secret in forms:
            at = len(before) + len(lead)
            yield before + lead + secret + after, [(at, at + len(secret))]
        for word in rng.sample(plain, min(3, len(plain))):
            yield f"{before}{rng.choice(_KEYS)} {word}{after}", []
        for lead in ("https://", "", "/") if len(plain) > 3 else ():
            # Paths and names made of words are no secrets however long they are.
            parts = [*rng.sample(plain, rng.randint(2, 4)), *rng.sample(("2024", "01", "15", "v2", "index.html"), 2)]
            yield f"{before}{lead}{rng.choice('/-_.').join(parts)}{after}", []


def _training_chains(text: str) -> Iterator[tuple[list[list[int]], list[int]]]:
    base = base_spans(text)
    yield from _labelled(text, [(s, e) for s, e, _ in base])
    file = file_features(text, len(base)) if base else None
    for changed, secrets in _changed(text, base):
        yield from _labelled(changed, secrets, file)


def hashed_sample(docs: DataFrame, text_col: str, where: str, most: int) -> DataFrame:
    """Texts that satisfy ``where``, at most ``most`` different ones: those with the smallest hashes.

    Only hashes are sorted; the texts stay where they are and are labelled in the tasks that read them.
    """
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(where)
    texts = texts.select("text", F.xxhash64("text").alias("h"))
    cut = texts.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    # Copies of a sampled text go before any text is labelled, so that no hot text fills the sample.
    return texts.where(F.col("h") <= F.lit(cut)).dropDuplicates(["h"]).select("text")


def train(docs: DataFrame, text_col: str = "text", most: int = TRAIN_TEXTS) -> crf.Chain:
    """A field from at most ``most`` texts that have open tokens, taken by the hash of their text."""
    sample = hashed_sample(docs, text_col, "text rlike '[0-9]'", most)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for (text,) in source:
            yield from _training_chains(text)

    found = map_rows(sample, rows, "tokens array<array<int>>, labels array<int>")
    found = found.orderBy(F.xxhash64("tokens", "labels")).limit(MOST_CHAINS).collect()
    forbidden = np.zeros((3, 3), bool)
    forbidden[OUTSIDE, INSIDE] = True
    model = crf.train([(r.tokens, r.labels) for r in found], len(FEATURES), 3, forbidden)
    model.first[INSIDE] = -1e9
    return model


def model_spans(text: str, model: crf.Chain) -> list[tuple[int, int]]:
    runs = chains(text)
    file = file_features(text, sum(map(len, runs))) if runs else []
    out: list[tuple[int, int]] = []
    for run in runs:
        scores = np.array([model.unary[features(text, *span, file)].sum(axis=0) for span in run])
        open_span = None
        for (start, end), label in zip(run, crf.viterbi(scores, model), strict=True):
            if label == INSIDE and open_span:
                open_span = (open_span[0], end)
                continue
            if open_span:
                out.append(open_span)
            open_span = (start, end) if label != OUTSIDE else None
        if open_span:
            out.append(open_span)
    return out


def all_spans(text: str, model: crf.Chain) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans)."""
    base = base_spans(text)
    merged, at = list(base), 0
    ends = [(s, e) for s, e, _ in base]
    for start, end in model_spans(text, model):
        while at < len(ends) and ends[at][1] <= start and all(e <= start for _, e in ends[at : at + 3]):
            at += 1
        if not any(s < end and start < e for s, e in ends[max(0, at - 1) : at + 64]):
            merged.append((start, end, "model"))
    order = {k: i for i, k in enumerate((*KINDS, "model"))}
    return base, sorted(merged, key=lambda x: (x[0], order[x[2]]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPANS = "array<struct<start:long,end:long,kind:string>>"


def scan(docs: DataFrame, model: crf.Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans, redacted text or null) of every row; ``redacted`` is null where nothing was found."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text in source:
            base, spans = all_spans(text, model)
            yield doc, base, spans, redact(text, spans) if spans else None

    return map_rows(id_and_text(docs, id_col, text_col), rows, f"id long, base {SPANS}, spans {SPANS}, redacted string", 512)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "<secret>") -> str:
    """The text with each span, or each stretch of overlapping spans, replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def report(docs: DataFrame, model: crf.Chain, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans as text."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text in source:
            base, spans = all_spans(text, model)
            counts = [sum(k == kind for _, _, k in base) for kind in kinds]
            yield doc, *counts, digest(base), joined(spans)

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in kinds), "base_sha256 string", "spans string"])
    return map_rows(id_and_text(docs), rows, schema, 1024)


def without_secrets(docs: DataFrame, model: crf.Chain, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns, with every span replaced in the text and the length brought up to date."""
    from .text import rewrite

    def clean(text: str) -> str:
        _, spans = all_spans(text, model)
        return redact(text, spans) if spans else text

    return rewrite(docs, clean, text_col, length_col if length_col in docs.columns else None)
