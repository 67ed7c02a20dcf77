"""A gated recurrent language model in numpy with a class-factored output.

Tokens are numbers: ``0 .. n_words-1`` are frequent words, the rest are groups of rarer words,
of which the model predicts only the group.  The output is factored: a softmax over classes
(blocks of ``BLOCK`` frequent words, then one class per group), and inside a block a softmax over
its words.  Both start at the corpus frequencies, so training begins at a unigram model.

Texts are laid end to end in streams that run side by side.  Each stream carries its state from
window to window and starts afresh with every text.  Gradients stop at window borders (truncated
backpropagation through time), and every window takes a gradient step.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np

BLOCK = 64
WINDOW = 16
STREAMS = 256
SCORE_STEPS = 128  # a multiple of WINDOW
HIDDEN = 8
LIMIT = 80.0  # logits beyond are clipped
SLICE = 1024  # tokens whose class scores stay in the processor's cache
PIECE = 1 << 14  # parameters updated at once
NAMES = ("embed", "cell", "classes", "class_bias", "words", "word_bias", "first")


class Room:
    """Arrays that every window fills anew; fresh ones would be memory to fetch from the system each time."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, kind: np.dtype, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        flat = self.held.get(name)
        if flat is None or len(flat) < size or flat.dtype != kind:
            flat = self.held[name] = np.empty(size, kind)
        return flat[:size].reshape(shape)


class Gru:
    def __init__(self, parts: dict[str, np.ndarray], n_words: int):
        self.p = parts
        self.room = Room()
        self.n_words = n_words
        self.n_blocks = n_words // BLOCK

    @staticmethod
    def start(word_counts: np.ndarray, group_counts: np.ndarray, seed: int, hidden: int = HIDDEN) -> Gru:
        """``word_counts``: frequent words, a multiple of ``BLOCK``; ``group_counts``: tokens per rare group."""
        rng = np.random.default_rng(seed)
        n, groups = len(word_counts), len(group_counts)
        counts = word_counts.reshape(-1, BLOCK) + 0.5
        classes = np.concatenate([counts.sum(axis=1), group_counts + 0.5])
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        parts = {
            "embed": draw(n + groups, 3 * hidden),
            "cell": draw(hidden, 3 * hidden),
            "classes": np.zeros((hidden, len(classes)), np.float32),
            "class_bias": np.log(classes / classes.sum()).astype(np.float32),
            "words": np.zeros((n // BLOCK, hidden, BLOCK), np.float32),
            "word_bias": np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32),
            "first": np.zeros(3 * hidden, np.float32),
        }
        # Update gates start half closed, so states last over several words.
        parts["embed"][:, :hidden] += 1
        parts["first"][:hidden] += 1
        return Gru(parts, n)

    @property
    def hidden(self) -> int:
        return self.p["cell"].shape[0]

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.n_words, ids // BLOCK, self.n_blocks + ids - self.n_words)

    def _states(self, given: np.ndarray, h: np.ndarray, tape: dict | None):
        """States (step, hidden, stream) before each token of a window; ``given``: the tokens
        before them, -1 at a text's start.  Streams are the last axis, so gates are whole rows.
        ``tape`` gets what the way back needs."""
        size, room = self.hidden, self.room
        steps, streams = given.shape
        cell = self.p["cell"].T.copy()
        inputs = self.p["embed"].take(given, axis=0)
        starts = given < 0
        inputs[starts] = self.p["first"]
        inputs = np.ascontiguousarray(inputs.transpose(0, 2, 1))
        # A gate is 1 / (1 + exp(-x)); the signs are turned once for the window.
        inputs[:, : 2 * size] *= -1
        cell[: 2 * size] *= -1
        resets = starts.any(axis=1).tolist()
        keep = (~starts).astype(np.float32)
        kind = np.result_type(cell, h)
        states = room("states", kind, steps + 1, size, streams)
        states[0] = h
        held = 1 if tape is None else steps
        backs = room("backs", kind, held, 3 * size, streams)
        gates = room("gates", kind, held, 2 * size, streams)
        inner = room("inner", kind, held, size, streams)
        with np.errstate(over="ignore"):  # a gate that is shut
            for t in range(steps):
                h, new, x, at = states[t], states[t + 1], inputs[t], t % held
                if resets[t]:
                    h = h * keep[t]
                back, gate, n = backs[at], gates[at], inner[at]
                np.matmul(cell, h, out=back)
                np.add(x[: 2 * size], back[: 2 * size], out=gate)
                np.exp(gate, out=gate)
                gate += 1
                np.reciprocal(gate, out=gate)
                np.multiply(gate[size:], back[2 * size :], out=n)
                n += x[2 * size :]
                np.tanh(n, out=n)
                np.subtract(h, n, out=new)
                new *= gate[:size]
                new += n
        if tape is not None:
            before = states[:-1] * keep[:, None] if any(resets) else states[:-1]
            tape.update(before=before, z=gates[:, :size], r=gates[:, size:], n=inner, back=backs[:, 2 * size :], resets=resets, keep=keep)
        return states[1:], states[-1].copy()

    def _outputs(self, states: np.ndarray, ids: np.ndarray, grads: dict | None):
        """Log-likelihood of each token from its state (tokens, hidden and a one for the bias), and
        with ``grads`` the gradient of the states (of the summed log-likelihood).

        Tokens are the first axis, so that products have long rows and whole blocks of tokens lie
        together.  Gradients by the logits are kept unscaled; their few factors are scaled instead."""
        p, size = self.p, self.hidden
        classes = self.class_of(ids)
        upper = np.concatenate([p["classes"], p["class_bias"][None]])
        lower = np.concatenate([p["words"], p["word_bias"][:, None]], axis=1)
        # States are means of hyperbolic tangents, so weights well inside the limit say that no logit is clipped.
        clip = not all(np.abs(w).sum(axis=-2).max(initial=0) < LIMIT / 2 for w in (upper, lower))
        kind = np.result_type(states, upper)
        loglik = np.empty(len(ids))
        room = self.room
        back = None if grads is None else room("back", kind, len(ids), size)
        by_class, by_word = np.zeros((upper.shape[1], size + 1), kind), np.zeros((self.n_blocks, BLOCK, size + 1), kind)
        logits = room("class logits", kind, SLICE, upper.shape[1])
        for start in range(0, len(ids), SLICE):
            at = slice(start, start + SLICE)
            weight = np.matmul(states[at], upper, out=logits[: len(ids) - start])
            loglik[at], scale = _softmax(weight, classes[at], clip, grads is not None)
            if grads is not None:
                by_class += weight.T @ (states[at] * scale)
                np.multiply(weight @ upper[:size].T, scale, out=back[at])
        sizes = np.bincount(classes[classes < self.n_blocks], minlength=self.n_blocks)
        ends = np.cumsum(sizes).tolist()
        # Tokens of one block side by side: a product per block, everything else for many blocks at once.
        order = np.argsort(np.minimum(classes, self.n_blocks).astype(np.int16), kind="stable")[: int(sizes.sum())]
        near, chosen = states.take(order, axis=0), ids[order] % BLOCK
        into = room("into", kind, 0 if grads is None else len(order), size)
        logits = room("word logits", kind, SLICE, BLOCK)
        block = 0
        for start in range(0, len(order), SLICE):
            end = min(start + SLICE, len(order))
            at, spans, begin = slice(start, end), [], start
            while begin < end:
                while ends[block] <= begin:
                    block += 1
                stop = min(ends[block], end)
                spans.append((block, slice(begin, stop), logits[begin - start : stop - start]))
                begin = stop
            for c, span, weight in spans:
                np.matmul(near[span], lower[c], out=weight)
            inner, scale = _softmax(logits[: end - start], chosen[at], clip, grads is not None)
            loglik[order[at]] += inner
            if grads is not None:
                scaled = near[at] * scale
                for c, span, weight in spans:
                    by_word[c] += weight.T @ scaled[span.start - start : span.stop - start]
                    np.matmul(weight, lower[c, :size].T, out=into[span])
                into[at] *= scale
        if grads is not None:
            back[order] += into
            grads["classes"] += by_class[:, :size].T
            grads["class_bias"] += by_class[:, size]
            grads["words"] += by_word[:, :, :size].transpose(0, 2, 1)
            grads["word_bias"] += by_word[:, :, size]
        return loglik, back

    def _backward(self, given: np.ndarray, tape: dict, back: np.ndarray, grads: dict) -> None:
        size = self.hidden
        cell = self.p["cell"]
        steps, streams = given.shape
        room, f4 = self.room, np.dtype(np.float32)
        z, r, n, inner, resets, keep = (tape[k] for k in ("z", "r", "n", "back", "resets", "keep"))
        # What does not depend on later steps, for the whole window: factors of the update gate and of the candidate.
        first, second, third = (room(k, z.dtype, steps, 2, size, streams) for k in ("first", "second", "third"))
        np.subtract(tape["before"], n, out=first[:, 0])
        np.subtract(1, z, out=first[:, 1])
        second[:, 0] = z
        np.multiply(n, n, out=second[:, 1])
        np.subtract(1, second[:, 1], out=second[:, 1])
        third[:, 0] = first[:, 1]
        third[:, 1] = r
        closed = 1 - r
        later = np.zeros((size, streams), np.float32)
        d = np.empty((size, streams), np.float32)
        both = room("both", f4, steps, 2, size, streams)
        through = room("through", f4, steps, 3, size, streams)
        for t in range(steps - 1, -1, -1):
            pair, out = both[t], through[t]
            np.add(later, back[t], out=d)
            np.multiply(d, first[t], out=pair)
            pair *= second[t]
            np.multiply(pair, third[t], out=out[::2])
            reset = out[1]
            np.multiply(pair[1], inner[t], out=reset)
            reset *= r[t]
            reset *= closed[t]
            np.multiply(d, z[t], out=later)
            later += cell @ out.reshape(3 * size, streams)
            if resets[t]:
                later *= keep[t]
        grads["cell"] += (through.reshape(steps, 3 * size, streams) @ tape["before"].transpose(0, 2, 1)).sum(axis=0).T
        through[:, 2] = both[:, 1]
        # Sums of each token's row, a text's start being row 0.
        width = 3 * size
        cells = room("cells", np.dtype(np.intp), steps, width, streams)
        np.add(((given + 1) * width)[:, None], np.arange(width)[:, None], out=cells)
        sums = np.bincount(cells.ravel(), through.ravel(), (len(grads["embed"]) + 1) * width).reshape(-1, width)
        grads["first"] += sums[0]
        grads["embed"] += sums[1:]

    def _carried(self, h: np.ndarray | None, streams: int) -> np.ndarray:
        return np.zeros((self.hidden, streams), np.float32) if h is None else np.ascontiguousarray(h[:, :streams])

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood (natural) of each complete text, the state carried over all its windows."""
        total = np.zeros(len(texts))
        h = None
        for targets, given, owner in _windows(texts, SCORE_STEPS):
            h = self._carried(h, targets.shape[1])
            states, h = self._states(given, h, None)
            real = targets >= 0
            loglik, _ = self._outputs(_picked(states, real), targets[real], None)
            total += np.bincount(owner[real], loglik, len(texts))
        return total

    def train(self, texts: list[np.ndarray], adam: Adam) -> int:
        """One pass over the texts; returns the tokens that took part in gradient steps."""
        used = 0
        h = None
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        cut = (tuple(x[i : i + WINDOW] for x in w[:2]) for w in _windows(texts, SCORE_STEPS, owners=False) for i in range(0, len(w[0]), WINDOW))
        for targets, given in cut:
            # Streams that ended inside the larger window only hold padding from here on.
            running = max(1, int((targets[0] >= 0).sum()))
            targets, given = targets[:, :running], given[:, :running]
            h = self._carried(h, targets.shape[1])
            for grad in grads.values():
                grad.fill(0)
            tape: dict = {}
            real = targets >= 0
            states, h = self._states(given, h, tape)
            _, into = self._outputs(_picked(states, real), targets[real], grads)
            if not real.all():
                spread = np.zeros((real.size, self.hidden), np.float32)
                spread[np.flatnonzero(real)] = into
                into = spread
            self._backward(given, tape, np.ascontiguousarray(into.reshape(*real.shape, -1).transpose(0, 2, 1)), grads)
            adam.step(self.p, grads, int(real.sum()))
            used += int(real.sum())
        return used


def _picked(states: np.ndarray, real: np.ndarray) -> np.ndarray:
    """(tokens, hidden and a one) of the real tokens, in the order of ``targets[real]``."""
    steps, size, streams = states.shape
    flat = np.ones((steps, streams, size + 1), states.dtype)
    flat[:, :, :size] = states.transpose(0, 2, 1)
    flat = flat.reshape(-1, size + 1)
    return flat if real.all() else flat.take(np.flatnonzero(real), axis=0)


def _softmax(logits: np.ndarray, chosen: np.ndarray, clip: bool, gradient: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of the chosen column of each row.  With ``gradient`` the logits become its
    gradient, once multiplied by the returned column."""
    if clip:
        np.clip(logits, -LIMIT, LIMIT, out=logits)
    flat, at = logits.reshape(-1), np.arange(0, logits.size, logits.shape[1]) + chosen
    loglik = flat.take(at).astype(np.float64)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    loglik -= np.log(total)
    if not gradient:
        return loglik, None
    flat[at] -= total
    return loglik, (-1 / total)[:, None]


def _windows(texts: list[np.ndarray], steps: int, owners: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
    """(targets, tokens before them, with ``owners`` text numbers) of windows (steps, streams); targets are -2 beyond a stream's end.

    Longest texts first, each to the stream that is shortest so far; streams end longest last,
    so the running ones are always the leading columns.
    """
    streams: list[list[int]] = [[] for _ in range(STREAMS)]
    heap = [(0, i) for i in range(STREAMS)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        length, at = heapq.heappop(heap)
        streams[at].append(i)
        heapq.heappush(heap, (length + len(texts[i]), at))
    lengths = {at: length for length, at in heap}
    running = [at for at in sorted(lengths, key=lambda s: -lengths[s]) if lengths[at]]
    if not running:
        return
    # All streams in one row, the longest first.
    own = [i for at in running for i in streams[at]]
    sizes = np.array([len(texts[i]) for i in own])
    laid = np.concatenate([texts[i] for i in own])
    before = np.concatenate([laid[:1], laid[:-1]])
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = -1
    rows = [laid, before]
    if owners:
        rows.append(np.repeat(np.array(own, np.int32), sizes))
    length = np.array([lengths[at] for at in running])
    first = np.cumsum(length) - length
    for start in range(0, int(length[0]), steps):
        n = int((length > start).sum())
        end = min(start + steps, int(length[0]))
        step = np.arange(start, end)[:, None]
        at = first[:n] + step
        window = [x.take(at, mode="clip") for x in rows]
        if length[n - 1] < end:
            beyond = step >= length[:n]
            for values, padding in zip(window, (-2, 0, 0)):
                values[beyond] = padding
        yield tuple(window)


class Adam:
    """Adaptive moments; windows with few tokens take smaller steps."""

    def __init__(self, rate: float, full: int = 1024):
        self.rate, self.full, self.steps = rate, full, 0
        self.mean: dict[str, np.ndarray] = {}
        self.square: dict[str, np.ndarray] = {}

    def step(self, parts: dict[str, np.ndarray], grads: dict[str, np.ndarray], tokens: int) -> None:
        """Gradients are those of the sum over ``tokens``, and are used up."""
        self.steps += 1
        b1, b2 = 0.9, 0.99
        # Both moments are kept of gradients times (1 - b2) ** 0.5, the mean without its factor 1 - b1.
        part, tokens = (1 - b2) ** 0.5, max(1, tokens)
        root = (1 - b2**self.steps) ** 0.5
        rate = self.rate * min(1.0, tokens / self.full) * root * (1 - b1) / part / (1 - b1**self.steps)
        for name, grad in grads.items():
            if name not in self.mean:
                self.mean[name], self.square[name] = np.zeros_like(grad), np.zeros_like(grad)
            own, grad, mean, square = (x.reshape(-1) for x in (parts[name], grad, self.mean[name], self.square[name]))
            # In pieces that stay in the processor's cache.
            for start in range(0, len(grad), PIECE):
                at = slice(start, start + PIECE)
                m, s, g = mean[at], square[at], grad[at]
                g *= part / tokens
                m *= b1
                m += g
                g *= g
                s *= b2
                s += g
                np.sqrt(s, out=g)
                g += 1e-7 * root
                np.divide(m, g, out=g)
                g *= rate
                own[at] += g
