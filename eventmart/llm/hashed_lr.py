"""Logistic regression over hashed word and character n-grams: features, fit, calibration, score.

A text's features are the counts of its hashed n-grams, damped (``1 + log`` of a count) and divided by the
root of the text's word count, so that a long text's neutral words do not outweigh a few telling ones.
Features are made by the same array code in training and scoring.  Training runs on a bounded sample of
labelled rows; scoring sees whole texts only, in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from eventmart.llm.textvec import SPACE, Slice, mix, slices, sums, windows


@dataclass(frozen=True)
class Features:
    """Which n-grams are hashed, and into how many slots."""
    bits: int = 18
    word_sizes: tuple[int, ...] = (1, 2)
    #: characters of n-grams at every position
    char_sizes: tuple[int, ...] = (4,)
    #: characters of n-grams at word starts only
    head_sizes: tuple[int, ...] = ()
    lower: bool = True

    def slots(self, s: Slice) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """(slot of each n-gram, n-grams before each text) by kind, and each text's number of words."""
        start, end = s.spans(~SPACE)
        words, out = s.bounds(start), []
        shift = np.uint64(64 - self.bits)
        h = s.hashes(start, end)
        for k in self.word_sizes:
            w, before = windows(h, words, k)
            out.append(((mix(w + np.uint64(k)) >> shift).astype(np.int32), before))
        if self.char_sizes or self.head_sizes:
            chars = np.flatnonzero((s.buf & 0xC0) != 0x80)
            chars = np.append(chars, len(s.buf))
            first = np.searchsorted(chars, s.offs)
            for k in self.char_sizes:
                n = np.maximum(np.diff(first) - k + 1, 0)
                before = np.r_[0, np.cumsum(n)]
                at = np.arange(before[-1]) + np.repeat(first[:-1] - before[:-1], n)
                g = s.hashes(chars[at], chars[at + k])
                out.append(((mix(g + np.uint64(100 + k)) >> shift).astype(np.int32), before))
            if self.head_sizes:
                head = np.searchsorted(chars, start)
                size = np.searchsorted(chars, end) - head
                for k in self.head_sizes:
                    use = np.flatnonzero(size >= k)
                    g = s.hashes(start[use], chars[head[use] + k])
                    out.append(((mix(g + np.uint64(200 + k)) >> shift).astype(np.int32), np.searchsorted(use, words)))
        return out, np.diff(words)

    def rows(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sparse row (slots, values) of each text."""
        out = []
        for s in slices(texts, self.lower):
            parts, n_words = self.slots(s)
            for i in range(s.n):
                own = np.concatenate([p[b[i]:b[i + 1]] for p, b in parts]) if parts else np.zeros(0, np.int32)
                slot, count = np.unique(own, return_counts=True)
                value = (1 + np.log(count)) / np.sqrt(max(n_words[i], 1))
                out.append((slot.astype(np.int32), value.astype(np.float32)))
        return out


@dataclass
class Model:
    """Weights, bias and the calibration ``p = sigmoid(a * margin + b)``."""
    features: Features
    weights: np.ndarray
    bias: float
    a: float = 1.0
    b: float = 0.0
    notes: dict = field(default_factory=dict)

    def margins(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for s in slices(texts, self.features.lower):
            parts, n_words = self.features.slots(s)
            owner, slot = [], []
            for p, before in parts:
                owner.append(np.repeat(np.arange(s.n, dtype=np.int64), np.diff(before)))
                slot.append(p)
            key = np.concatenate(owner) << self.features.bits | np.concatenate(slot)
            key.sort()
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            count = np.diff(np.r_[edge, len(key)])
            distinct = key[edge]
            value = (1 + np.log(count)) * self.weights[distinct & ((1 << self.features.bits) - 1)]
            total = np.bincount(distinct >> self.features.bits, value, s.n)
            out[s.first: s.first + s.n] = self.bias + total / np.sqrt(np.maximum(n_words, 1))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.a * self.margins(texts) + self.b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Rows:
    """Sparse rows laid end to end."""
    slot: np.ndarray
    value: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def parts(self, most: int = 400_000) -> list[tuple[int, int]]:
        """Ranges of rows with about so many entries each, which bound what a step of the fit holds at once."""
        out, first = [], 0
        for i in range(1, len(self) + 1):
            if i == len(self) or self.bounds[i + 1] - self.bounds[first] > most:
                out.append((first, i))
                first = i
        return out

    def margins(self, w: np.ndarray, b: float) -> np.ndarray:
        out = np.full(len(self), b)
        for i, j in self.parts():
            own = slice(self.bounds[i], self.bounds[j])
            out[i:j] += sums(self.value[own] * w[self.slot[own]], self.bounds[i:j + 1] - self.bounds[i])
        return out

    def pulled(self, pull: np.ndarray, size: int) -> np.ndarray:
        """Sum of all rows, each times its pull."""
        out = np.zeros(size)
        for i, j in self.parts():
            own = slice(self.bounds[i], self.bounds[j])
            each = np.repeat(pull[i:j], np.diff(self.bounds[i:j + 1]))
            out += np.bincount(self.slot[own], self.value[own] * each, size)
        return out


class Collected:
    """Rows on their way to the driver, held once: little-endian 32-bit slots and floats."""

    def __init__(self):
        self.slots, self.values, self.ends = bytearray(), bytearray(), [0]

    def add(self, slots: bytes, values: bytes) -> None:
        self.slots += slots
        self.values += values
        self.ends.append(len(self.slots) // 4)

    def rows(self) -> Rows:
        return Rows(np.frombuffer(self.slots, "<i4"), np.frombuffer(self.values, "<f4"), np.array(self.ends, np.int64))


def fit(rows: Rows, y: np.ndarray, bits: int, *, use: np.ndarray | None = None, changes: Rows | None = None,
        change_weight: float = 0.0, l2: float = 1e-4, steps: int = 100, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent (Adam) on log loss, both classes weighing the same; ``use`` marks the rows to fit.

    ``changes``: what swapped or added terms change in a text's row; ``change_weight`` times the mean squared
    change of margin is added to the loss."""
    size, use = 1 << bits, np.ones(len(y), bool) if use is None else use
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    weight = np.where(y == 1, 0.5 / max((use & (y == 1)).sum(), 1), 0.5 / max((use & (y == 0)).sum(), 1)) * use
    for t in range(1, steps + 1):
        margin = rows.margins(w, b)
        pull = weight * (sigmoid(margin) - y)
        g = np.append(l2 * w, pull.sum())
        if changes is not None and len(changes):
            g[:-1] += changes.pulled(2 * change_weight * changes.margins(w, 0.0) / len(changes), size)
        g[:-1] += rows.pulled(pull, size)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8) * min(1.0, 2 * (1 - t / (steps + 1)))
        w -= step[:-1]
        b -= step[-1]
    return w, float(b)


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset that make ``sigmoid(a * margin + b)`` a probability: Newton steps on log loss
    with the usual smoothed targets.  The slope stays positive, so the order of margins is kept."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.c_[margin, np.ones(len(margin))]
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ beta)
        g = x.T @ (p - target) + 1e-3 * (beta - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta = beta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])
