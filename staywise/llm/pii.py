"""Personal data: a skip-chain conditional random field with loopy message passing.

Tokens are runs that contain a digit or an at sign, with the marks that join their parts. Labels: outside, email, ip, card, phone.
Neighbouring tokens are tied by a chain potential. Distant tokens that repeat (same characters but for separators and case) or are similar
(numbers that differ in their prefix only) share an entity: a hidden variable tied to all of them. That is the skip potential in the form of a star instead of all pairs, so a token repeated
thousands of times in one text costs its number of repeats, not its square. Sum-product messages run over chain and stars, a
fixed number of rounds with damping. A token that a base span of the same entity covers is certain: its label enters as evidence, and the
skip potentials carry it to unclear occurrences all over the text.

Plain tokens have only the label "outside" (a hard constraint of the model) and send no messages; so whole texts are decoded exactly as
defined without visiting their plain words.

Training: chain and unary weights by penalised likelihood on a bounded sample of different texts. Labels come from the base patterns and are
carried over to all occurrences of the same entity in the text, so a plain repeat does not count against its clear twin. The skip
weight is the log odds that the base labels of one entity agree within a text; ``PRIOR_AGREE`` agreeing pairs are counted beforehand, so
consistency holds unless the texts speak against it.

Spans of the base patterns always stay; decoded tokens that no base span touches are added as kind ``model_<label>``. Offsets are code
points, ends exclusive. Null and empty texts have no spans. Rows are independent: repeated rows, null ids and empty tables are fine.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .secrets import SPANS, digest, hashed_sample, joined, redact
from .text import id_and_text, map_rows

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
TRAIN_TEXTS = 2000
MOST_CHAINS = 6000
ROUNDS = 8
DAMPING = 0.3
PRIOR_AGREE = 20000
EVIDENCE = 40.0  # log score of a certain label
MOST_DIGITS = 19  # of groups joined by spaces into one token; no kind has more

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its head only, so long runs are read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign, domain; each at sign is met once, so long runs stay linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append((m.start(), m.end(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2], x[1]))]


# A token starts at a digit, plus sign, bracket or word with an at sign and joins parts by single marks.
_SPOT = re.compile(r"[0-9@]")
_GROUP = re.compile(r"[0-9()]*")
_JOINERS = frozenset("@._%+-()")


def open_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of tokens that may be labelled otherwise than outside, in order; linear in the text.

    Groups of digits are joined over single spaces up to ``MOST_DIGITS`` digits, so a row of numbers becomes several tokens.
    """
    found, at, n = [], 0, len(text)
    for spot in _SPOT.finditer(text):
        if spot.start() < at:
            continue
        start = end = spot.start()
        while start > at and (text[start - 1].isalnum() or text[start - 1] in _JOINERS):
            start -= 1
        digits = 0
        while end < n:
            c = text[end]
            if c.isalnum() or c in _JOINERS:
                digits += c in "0123456789"
                end += 1
            elif c == " " and text[end - 1] in "0123456789)" and text[end + 1 : end + 2] in tuple("0123456789("):
                # The next group is looked at before it is joined; a longer one than any kind has ends the token.
                ahead = _GROUP.match(text, end + 1, end + 2 + MOST_DIGITS)
                if digits + sum(d in "0123456789" for d in ahead[0]) > MOST_DIGITS:
                    break
                end += 1
            else:
                break
        at = end
        while end > start and text[end - 1] in "._%+-(":
            end -= 1
        while start < end and text[start] in "._%-)":
            start += 1
        if end - start >= 6:
            found.append((start, end))
    return found


def _names() -> list[str]:
    names = ["always", "at sign", "dot after at sign", "letters", "only digits", "plus first", "brackets", "spaces"]
    names += [f"dots {k}" for k in range(5)] + [f"dashes {k}" for k in range(4)] + [f"digits {k}" for k in range(22)]
    names += ["small parts", "checksum", "capital before", "mark before", "contact word near"]
    return names


FEATURES = {name: k for k, name in enumerate(_names())}
_CONTACT = re.compile(r"mail|phone|tel|call|card|visa|host|addr|contact|ip\b", re.IGNORECASE)


def features(text: str, start: int, end: int) -> list[int]:
    token = text[start:end]
    digits = "".join(c for c in token if c in "0123456789")
    on = ["always", f"dots {min(4, token.count('.'))}", f"dashes {min(3, token.count('-'))}", f"digits {min(21, len(digits))}"]
    if "@" in token:
        on.append("at sign")
        if "." in token.rpartition("@")[2]:
            on.append("dot after at sign")
    if any(c.isalpha() for c in token):
        on.append("letters")
    elif token == digits:
        on.append("only digits")
    if token[0] == "+":
        on.append("plus first")
    if "(" in token:
        on.append("brackets")
    if " " in token:
        on.append("spaces")
    parts = token.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts):
        on.append("small parts")
    if 14 <= len(digits) <= 19 and luhn(digits):
        on.append("checksum")
    before = text[max(0, start - 24) : start]
    if before[-2:-1].isupper():
        on.append("capital before")
    if before.rstrip()[-1:] in ":=":
        on.append("mark before")
    if _CONTACT.search(before):
        on.append("contact word near")
    return [FEATURES[name] for name in on]


_TAIL = 9


def entity(token: str) -> str:
    """Equal for tokens that are one entity: they differ in separators, brackets or case only, or are numbers of the
    length of a phone that differ in their prefix only. Addresses of hosts are equal to such addresses only."""
    plain = "".join(c for c in token.lower() if c.isalnum() or c == "@")
    if plain.isascii() and plain.isdigit():
        parts = token.split(".")
        if len(parts) == 4 and all(parts) and all(p.isdigit() and _small(p) for p in parts):
            return ".".join(p.lstrip("0") for p in parts)
        if 10 <= len(plain) <= 15:
            return f"…{plain[-_TAIL:]}"
    return plain


def _known(text: str, spans: list[tuple[int, int]], base: list[tuple[int, int, str]]) -> tuple[list[str], list[int]]:
    """(entity, certain label or 0) of each token; a token that a base span meets is the entity of that span."""
    keys, labels, at = [], [], 0
    for start, end in spans:
        while at < len(base) and base[at][1] <= start:
            at += 1
        hit = next((b for b in base[at : at + 8] if b[0] < end and start < b[1]), None)
        keys.append(entity(text[hit[0] : hit[1]] if hit else text[start:end]))
        labels.append(LABELS.index(hit[2]) if hit else 0)
    return keys, labels


def _groups(keys: list[str]) -> list[list[int]]:
    same: dict[str, list[int]] = {}
    for k, key in enumerate(keys):
        same.setdefault(key, []).append(k)
    return [v for v in same.values() if len(v) > 1]


class Field:
    """A trained skip-chain field."""

    def __init__(self, chain: crf.Chain, skip: float):
        self.chain, self.skip = chain, skip

    def marginals(self, scores: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
        """Label probabilities of the tokens (tokens x labels) by damped loopy sum-product; ``groups`` hold repeats.

        Messages are normalised vectors; a star's message to a member leaves out what that member sent.
        """
        n, k = scores.shape
        unary = np.exp(scores - scores.max(axis=1, keepdims=True))
        step = np.exp(self.chain.step - self.chain.step.max())
        tie = np.ones((k, k)) + np.eye(k) * math.expm1(self.skip)
        right, left, skip = (np.full((n, k), 1.0 / k) for _ in range(3))
        if not groups and n < 2:
            return unary / unary.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            belief = unary * skip
            new_right, new_left = np.full((n, k), 1.0 / k), np.full((n, k), 1.0 / k)
            new_right[1:] = (belief[:-1] * right[:-1]) @ step
            new_left[:-1] = (belief[1:] * left[1:]) @ step.T
            new_skip = np.full((n, k), 1.0 / k)
            if groups:
                up = unary * right * left
                up = np.log((up / up.sum(axis=1, keepdims=True)) @ tie)
                for members in groups:
                    own = up[members]
                    others = own.sum(axis=0) - own
                    new_skip[members] = np.exp(others - others.max(axis=1, keepdims=True)) @ tie
            for old, new in ((right, new_right), (left, new_left), (skip, new_skip)):
                new /= new.sum(axis=1, keepdims=True)
                old *= DAMPING
                old += (1 - DAMPING) * new
        out = unary * right * left * skip
        return out / out.sum(axis=1, keepdims=True)

    def decode(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Tokens labelled otherwise than outside, given the certain spans."""
        spans = open_tokens(text)
        if not spans:
            return []
        scores = np.array([self.chain.unary[features(text, *s)].sum(axis=0) for s in spans])
        scores[0] += self.chain.first
        scores[-1] += self.chain.last
        keys, known = _known(text, spans, base)
        certain = np.flatnonzero(known)
        scores[certain, np.array(known)[certain]] += EVIDENCE
        best = self.marginals(scores, [np.array(g) for g in _groups(keys)]).argmax(axis=1)
        return [(s, e, f"model_{LABELS[b]}") for (s, e), b in zip(spans, best, strict=True) if b]


def _consistent(keys: list[str], known: list[int]) -> tuple[list[int], int, int]:
    """(labels carried over to all occurrences of an entity, pairs of base labels that agree, that differ)."""
    labels, agree, differ = list(known), 0, 0
    for members in _groups(keys):
        seen = [known[k] for k in members if known[k]]
        if len(set(seen)) == 1:
            agree += len(seen) - 1
            for k in members:
                labels[k] = seen[0]
        elif seen:
            differ += len(seen) - 1
    return labels, agree, differ


def train(docs: DataFrame, text_col: str = "text", most: int = TRAIN_TEXTS) -> Field:
    sample = hashed_sample(docs, text_col, "text rlike '[0-9@]'", most)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for (text,) in source:
            spans = open_tokens(text)
            labels, agree, differ = _consistent(*_known(text, spans, base_spans(text)))
            for at in range(0, len(spans), 32):
                yield [features(text, *s) for s in spans[at : at + 32]], labels[at : at + 32], agree, differ
                agree = differ = 0

    found = map_rows(sample, rows, "tokens array<array<int>>, labels array<int>, agree long, differ long")
    chains = found.orderBy(F.xxhash64("tokens", "labels")).limit(MOST_CHAINS).collect()
    chain = crf.train([(r.tokens, r.labels) for r in chains], len(FEATURES), len(LABELS))
    agree, differ = sum(r.agree for r in chains), sum(r.differ for r in chains)
    return Field(chain, max(0.5, math.log((agree + PRIOR_AGREE) / (differ + 1))))


def all_spans(text: str, field: Field) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans)."""
    base, found, at = base_spans(text), [], 0
    reach = sorted((s, e) for s, e, _ in base)
    for start, end, kind in field.decode(text, base):
        while at < len(reach) and reach[at][1] <= start:
            at += 1
        if not any(s < end and start < e for s, e in reach[max(0, at - 2) : at + 8]):
            found.append((start, end, kind))
    order = {k: i for i, k in enumerate((*KINDS, *(f"model_{k}" for k in KINDS)))}
    return base, sorted(base + found, key=lambda x: (x[0], order[x[2]], x[1]))


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans, redacted text or null) of every row."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text in source:
            base, spans = all_spans(text, field)
            yield doc, base, spans, redact(text, spans, "<private>") if spans else None

    return map_rows(id_and_text(docs, id_col, text_col), rows, f"id long, base {SPANS}, spans {SPANS}, redacted string", 512)


def report(docs: DataFrame, field: Field) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans as text."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text in source:
            base, spans = all_spans(text, field)
            yield doc, *(sum(k == kind for _, _, k in base) for kind in KINDS), digest(base), joined(spans)

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return map_rows(id_and_text(docs), rows, schema, 1024)
