"""A linear-chain conditional random field with two states, for tagging spans.

Every token has an observation, 0 for almost all: a code of three levels of evidence, for the whole
word, its beginning and its end (``code``; a code below ``LEVELS`` is a word's level alone).  The
potential of a token in the marked state is its bias plus weights for its own three levels and
for the highest level of each neighbour; transitions have four weights.  Tokens out of reach of any evidence have one constant potential, so the chain between
two tokens with evidence is a matrix power, and inference costs what the evidence costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

LEVELS = 8
# Training works on windows of this many tokens, so many at once: its memory has this bound.
WINDOW, WINDOWS_AT_ONCE = 1024, 256

# The three levels and the highest of them, by code.
_CODES = np.arange(LEVELS**3)
_WORD, _BEGIN, _END = _CODES % LEVELS, _CODES // LEVELS % LEVELS, _CODES // LEVELS**2
_TOP = np.maximum(np.maximum(_WORD, _BEGIN), _END)


def code(word: int, begin: int = 0, end: int = 0) -> int:
    return word + LEVELS * begin + LEVELS**2 * end


def highest(observation: int) -> int:
    """The highest of a code's three levels."""
    return int(_TOP[observation])


@dataclass
class Crf:
    """bias, own[level], before[level], after[level], change[from, to], and own weights for the
    levels of the word's beginning and end; level 0 has weight 0."""

    bias: float
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    change: np.ndarray
    begin: np.ndarray = field(default_factory=lambda: np.zeros(LEVELS))
    end: np.ndarray = field(default_factory=lambda: np.zeros(LEVELS))

    def __post_init__(self):
        self.by_own = self.own[_WORD] + self.begin[_BEGIN] + self.end[_END]
        self.by_left, self.by_right = self.before[_TOP], self.after[_TOP]

    @staticmethod
    def start() -> Crf:
        return Crf(-4.0, np.zeros(LEVELS), np.zeros(LEVELS), np.zeros(LEVELS), np.zeros((2, 2)))

    def potentials(self, levels: np.ndarray) -> np.ndarray:
        """Log potential of the marked state at every token of (a batch of) sequences."""
        left = np.zeros_like(levels)
        right = np.zeros_like(levels)
        left[..., 1:], right[..., :-1] = levels[..., :-1], levels[..., 1:]
        return self.bias + self.by_own[levels] + self.by_left[left] + self.by_right[right]

    def marginals(self, places: np.ndarray, levels: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens in reach of evidence and the probability that each is marked.

        ``places`` (rising) and ``levels`` give the tokens with evidence in a text of ``length`` tokens.
        """
        if not len(places):
            return places, np.zeros(0)
        known = dict(zip(places.tolist(), levels.tolist()))
        active = sorted({t for p in known for t in (p - 1, p, p + 1) if 0 <= t < length})
        u = [
            self.bias + self.by_own[known.get(t, 0)] + self.by_left[known.get(t - 1, 0)] + self.by_right[known.get(t + 1, 0)]
            for t in active
        ]
        phi = [np.array([1.0, np.exp(min(x, 60.0))]) for x in u]
        step = np.exp(self.change)
        idle = step * np.array([1.0, np.exp(self.bias)])
        idle = idle / np.abs(np.linalg.eigvals(idle)).max()

        def run(vector, gap, matrix):
            if gap > 0:
                vector = vector @ np.linalg.matrix_power(matrix, gap)
            return vector / vector.sum()

        # Forward: after an idle run of g tokens, the next token's transition and potential.
        forward, before = [], -1
        for t, p in zip(active, phi):
            if before < 0:
                start = np.array([1.0, np.exp(self.bias)]) if t > 0 else None
                a = p if start is None else (run(start / start.sum(), t - 1, idle) @ step) * p
            else:
                a = (run(forward[-1], t - before - 1, idle) @ step) * p
            forward.append(a / a.sum())
            before = t
        backward = [None] * len(active)
        back = np.ones(2)
        last = length - 1
        tail = last - active[-1]
        if tail:
            back = np.linalg.matrix_power(idle, tail) @ back
        backward[-1] = back / back.sum()
        for i in range(len(active) - 2, -1, -1):
            b = step @ (phi[i + 1] * backward[i + 1])
            gap = active[i + 1] - active[i] - 1
            if gap:
                b = np.linalg.matrix_power(idle, gap) @ b
            backward[i] = b / b.sum()
        p = np.array([f * b for f, b in zip(forward, backward)])
        return np.array(active), p[:, 1] / p.sum(axis=1)


def _gradient(model: Crf, levels: np.ndarray, tags: np.ndarray, lengths: np.ndarray):
    """Log-likelihood gradient of padded sequences, sorted by falling length."""
    n, longest = levels.shape
    u = model.potentials(levels)
    phi = np.exp(np.minimum(u, 60.0))
    step = np.exp(model.change)
    alive = [int((lengths > t).sum()) for t in range(longest)] + [0]
    a = np.zeros((longest, n, 2))
    a[0, :, 0], a[0, :, 1] = 1, phi[:, 0]
    a[0] /= a[0].sum(axis=1, keepdims=True)
    for t in range(1, longest):
        k = alive[t]
        x = a[t - 1, :k] @ step
        x[:, 1] *= phi[:k, t]
        a[t, :k] = x / x.sum(axis=1, keepdims=True)
    b = np.ones((n, 2))
    marked = np.zeros((n, longest))
    pairs = np.zeros((2, 2))
    for t in range(longest - 1, -1, -1):
        k = alive[t]
        m = a[t, :k] * b[:k]
        marked[:k, t] = m[:, 1] / m.sum(axis=1)
        if t:
            right = b[:k].copy()
            right[:, 1] *= phi[:k, t]
            joint = a[t - 1, :k, :, None] * step * right[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            x = right @ step.T
            b[:k] = x / x.sum(axis=1, keepdims=True)
    inside = np.arange(longest) < lengths[:, None]
    diff = np.where(inside, tags - marked, 0.0)
    left, right = np.zeros_like(levels), np.zeros_like(levels)
    left[:, 1:], right[:, :-1] = levels[:, :-1], levels[:, 1:]
    by_code = lambda at: np.bincount(at.ravel(), diff.ravel(), len(_CODES))
    by = lambda at, part: np.bincount(part, by_code(at), LEVELS)
    both = inside[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    sides = by(left, _TOP), by(right, _TOP)
    return diff.sum(), by(levels, _WORD), *sides, seen - pairs, by(levels, _BEGIN), by(levels, _END)


def _windows(sequences: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(levels, tags, lengths) of windows of like length, padded; every token is in one window."""
    cut = [(x[i : i + WINDOW], y[i : i + WINDOW]) for x, y in sequences for i in range(0, len(x), WINDOW)]
    cut.sort(key=lambda s: -len(s[0]))
    for at in range(0, len(cut), WINDOWS_AT_ONCE):
        part = cut[at : at + WINDOWS_AT_ONCE]
        lengths = np.array([len(x) for x, _ in part])
        levels, tags = np.zeros((2, len(part), lengths[0]), dtype=np.int16)
        for i, (x, y) in enumerate(part):
            levels[i, : len(x)], tags[i, : len(y)] = x, y
        yield levels, tags, lengths


def trained(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 40, rate: float = 2.0, decay: float = 1e-3) -> Crf:
    """Fit by adaptive gradient ascent with L2 decay; ``sequences``: (levels, tags) per text."""
    model = Crf.start()
    sequences = [s for s in sequences if len(s[0])]
    if not sequences:
        return model
    batches = list(_windows(sequences))
    flat = lambda g: np.concatenate([np.ravel(x) for x in g])
    theta = flat((model.bias, model.own, model.before, model.after, model.change, model.begin, model.end))
    ends = np.cumsum([1, LEVELS, LEVELS, LEVELS, 4, LEVELS])
    fixed = np.zeros(len(theta), dtype=bool)
    fixed[ends[[0, 1, 2, 4, 5]]] = True
    squares = np.full(len(theta), 1e-6)
    for _ in range(rounds):
        total = sum(flat(_gradient(model, *batch)) for batch in batches)
        g = total / len(sequences) - decay * theta
        g[fixed] = 0
        squares += g * g
        theta = theta + rate * g / np.sqrt(squares)
        bias, own, before, after, change, begin, end = np.split(theta, ends)
        model = Crf(float(bias[0]), own, before, after, change.reshape(2, 2), begin, end)
    return model
