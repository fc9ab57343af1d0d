"""Linear-chain conditional random fields over sparse binary features: training by likelihood, decoding by Viterbi.

A chain is a list of tokens; a token is a list of feature numbers; labels are numbers. Chains handled here are short runs of tokens
(see the callers for why that is exact), so scores are worked out in the log domain, all chains of one length at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """``unary``: features x labels; ``step``: labels x labels; ``first`` and ``last``: labels (the text's plain ground)."""

    unary: np.ndarray
    step: np.ndarray
    first: np.ndarray
    last: np.ndarray


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def viterbi(scores: np.ndarray, model: Chain) -> list[int]:
    """The best labelling of one chain of unary scores (tokens x labels); ties go to the lower label."""
    best, back = scores[0] + model.first, []
    for row in scores[1:]:
        paths = best[:, None] + model.step
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    label = int((best + model.last).argmax())
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return out[::-1]


def train(
    chains: list[tuple[list[list[int]], list[int]]],
    n_features: int,
    n_labels: int,
    forbidden: np.ndarray | None = None,
    rounds: int = 150,
    rate: float = 0.5,
    ridge: float = 1e-3,
) -> Chain:
    """Penalised maximum likelihood by AdaGrad with full gradients.

    ``forbidden`` (labels x labels) marks steps that never occur. No chain gives a model of zeros.
    """
    model = Chain(*(np.zeros(s) for s in ((n_features, n_labels), (n_labels, n_labels), (n_labels,), (n_labels,))))
    ban = np.zeros((n_labels, n_labels)) if forbidden is None else np.where(forbidden, -1e9, 0.0)
    by_length: dict[int, list] = {}
    for tokens, labels in chains:
        if tokens:
            by_length.setdefault(len(tokens), []).append((tokens, labels))
    groups = [_packed(length, group, n_labels) for length, group in sorted(by_length.items())]
    total = sum(len(g[2]) for g in groups)
    parts = (model.unary, model.step, model.first, model.last)
    squares = [np.full(p.shape, 1e-8) for p in parts]
    for _ in range(rounds if total else 0):
        grads = [-ridge * p for p in parts]
        for flat, owner, labels in groups:
            _add_gradient(model, ban, flat, owner, labels, grads, total)
        for p, g, s in zip(parts, grads, squares, strict=True):
            s += g * g
            p += rate * g / np.sqrt(s)
    model.step += ban
    return model


def _packed(length: int, group: list, n_labels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat, owner, labels = [], [], np.zeros((len(group), length), np.int64)
    for c, (tokens, marks) in enumerate(group):
        labels[c] = marks
        for t, features in enumerate(tokens):
            flat += features
            owner += [c * length + t] * len(features)
    return np.array(flat, np.int64), np.array(owner, np.int64), labels


def _add_gradient(model: Chain, ban, flat, owner, labels, grads, total) -> None:
    n, length = labels.shape
    k = len(model.first)
    scores = np.zeros((n * length, k))
    np.add.at(scores, owner, model.unary[flat])
    scores = scores.reshape(n, length, k)
    step = model.step + ban
    forward = np.empty_like(scores)
    forward[:, 0] = scores[:, 0] + model.first
    for t in range(1, length):
        forward[:, t] = scores[:, t] + log_sum(forward[:, t - 1, :, None] + step, 1)
    backward = np.empty_like(scores)
    backward[:, -1] = model.last
    for t in range(length - 2, -1, -1):
        backward[:, t] = log_sum(step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
    z = log_sum(forward[:, -1] + model.last, 1)
    expected = np.exp(forward + backward - z[:, None, None])
    seen = np.eye(k)[labels]
    gap = (seen - expected) / total
    np.add.at(grads[0], flat, gap.reshape(-1, k)[owner])
    for t in range(1, length):
        pairs = forward[:, t - 1, :, None] + step + (scores[:, t] + backward[:, t])[:, None, :] - z[:, None, None]
        grads[1] += (seen[:, t - 1, :, None] * seen[:, t, None, :] - np.exp(pairs)).sum(axis=0) / total
    grads[2] += gap[:, 0].sum(axis=0)
    grads[3] += gap[:, -1].sum(axis=0)
