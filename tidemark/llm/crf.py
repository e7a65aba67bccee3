"""Linear-chain conditional random field with two labels: numpy training, Viterbi decoding.

A sequence's score is the sum of its places' feature weights (for label 1; label 0 has none), of the weights
of neighbouring labels and of that of the first label. Training maximises the labels' log probability,
less a penalty on large weights, by full-batch steps over all sequences at once; it is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Weights of features, of (label before, label) and of the first label."""

    weights: np.ndarray
    steps: np.ndarray
    first: np.ndarray

    def viterbi(self, scores: Sequence[float]) -> list[int]:
        """The likeliest labels for the places' scores of label 1; label 0 wins ties."""
        if not len(scores):
            return []
        (s00, s01), (s10, s11) = self.steps.tolist()
        zero, one = float(self.first[0]), float(self.first[1]) + scores[0]
        back: list[tuple[int, int]] = []
        for score in scores[1:]:
            from_zero, from_one = (0, zero + s00) if zero + s00 >= one + s10 else (1, one + s10), (0, zero + s01) if zero + s01 >= one + s11 else (1, one + s11)
            back.append((from_zero[0], from_one[0]))
            zero, one = from_zero[1], from_one[1] + score
        label = int(one > zero)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit(features: Sequence[Sequence[Sequence[int]]], labels: Sequence[Sequence[int]], size: int, rounds: int = 120, rate: float = 0.1, penalty: float = 0.004) -> Chain:
    """Train on sequences of places; a place is the list of its features, numbers below ``size``."""
    n, longest = len(features), max(map(len, features))
    place = [(i, t) for i, s in enumerate(features) for t in range(len(s))]
    who, when = np.array(place).T
    flat = np.concatenate([np.asarray(f, dtype=np.int64) for s in features for f in s])
    owner = np.repeat(np.arange(len(place)), [len(f) for s in features for f in s])
    truth = np.concatenate([np.asarray(y, dtype=np.int64) for y in labels])
    length = np.array([len(s) for s in features])
    inside = np.arange(longest)[None, :] < length[:, None]
    y = np.zeros((n, longest), dtype=np.int64)
    y[who, when] = truth
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[:, :-1][inside[:, 1:]], y[:, 1:][inside[:, 1:]]), 1)
    starts = np.bincount(y[:, 0], minlength=2)

    values = np.zeros(size + 6)
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for k in range(1, rounds + 1):
        weights, steps, first = values[:size], values[size : size + 4].reshape(2, 2), values[size + 4 :]
        emit = np.zeros((n, longest))
        emit[who, when] = np.bincount(owner, weights=weights[flat], minlength=len(place))
        one, edge = _marginals(emit, inside, length, steps, first)
        gradient = np.empty_like(values)
        gradient[:size] = np.bincount(flat, weights=(truth - one[who, when])[owner], minlength=size)
        gradient[size : size + 4] = (pairs - edge).ravel()
        gradient[size + 4 :] = starts - [(1 - one[:, 0]).sum(), one[:, 0].sum()]
        gradient = gradient / n - penalty * values / np.sqrt(n)
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        values = values + rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return Chain(values[:size].copy(), values[size : size + 4].reshape(2, 2).copy(), values[size + 4 :].copy())


def _marginals(emit: np.ndarray, inside: np.ndarray, length: np.ndarray, steps: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 at each place, and expected counts of neighbouring labels, by forward and
    backward sums over all sequences at once."""
    n, longest = emit.shape
    score = np.stack([np.zeros_like(emit), emit], axis=2)
    forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    forward[:, 0] = first + score[:, 0]
    for t in range(1, longest):
        step = _log_sum(forward[:, t - 1][:, :, None] + steps[None], axis=1) + score[:, t]
        forward[:, t] = np.where(inside[:, t][:, None], step, forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        step = _log_sum(steps[None] + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where(inside[:, t + 1][:, None], step, 0.0)
    total = _log_sum(forward[np.arange(n), length - 1], axis=1)
    one = np.where(inside, np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None]), 0.0)
    joint = np.exp(forward[:, :-1, :, None] + steps + (score + backward)[:, 1:, None, :] - total[:, None, None, None])
    return one, (joint * inside[:, 1:, None, None]).sum(axis=(0, 1))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)
