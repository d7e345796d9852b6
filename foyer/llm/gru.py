"""A small gated recurrent language model in numpy: forward, truncated backpropagation, Adam.

Words are numbered by frequency and cut into classes of ``class_size``; one more class stands for all
words outside the vocabulary. The output is a softmax over classes and one within the class, so a
word costs (classes + class_size) outputs. Texts run through lanes: a lane is texts on end, its state
is carried from window to window and set to zero where a text begins.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

CLASS_SIZE, HIDDEN = 32, 24


def initial(words: int, hidden: int = HIDDEN, class_size: int = CLASS_SIZE, seed: int = 0) -> dict[str, np.ndarray]:
    """Parameters for words 0 to words-1; id ``words`` is any other word, ``words + 1`` a text's begin."""
    if words % class_size:
        raise ValueError("the vocabulary must fill its classes")
    rng = np.random.default_rng(seed)
    classes = words // class_size

    def normal(*shape):
        return rng.normal(0, 0.1, shape).astype(np.float32)

    bias = np.zeros(3 * hidden, np.float32)
    bias[:hidden] = 1.0
    return {
        "input": normal(words + 2, 3 * hidden) + bias, "state": normal(hidden, 3 * hidden),
        "classes": normal(hidden, classes + 1), "class_bias": np.zeros(classes + 1, np.float32),
        "words": normal(classes, hidden, class_size), "word_bias": np.zeros((classes, class_size), np.float32),
    }


def lanes(lengths: np.ndarray, n: int) -> list[list[int]]:
    """Texts dealt to lanes of near equal length, longest lanes first."""
    heap = [(0, lane) for lane in range(n)]
    dealt: list[list[int]] = [[] for _ in range(n)]
    total = [0] * n
    for text in np.argsort(-lengths, kind="stable").tolist():
        size, lane = heapq.heappop(heap)
        dealt[lane].append(text)
        total[lane] = size + int(lengths[text])
        heapq.heappush(heap, (total[lane], lane))
    return [dealt[lane] for lane in sorted(range(n), key=lambda i: -total[i]) if dealt[lane]]


def windows(ids: np.ndarray, bounds: np.ndarray, n: int, steps: int, begin: int) -> Iterator[tuple]:
    """Windows (inputs, targets, begins, text) of shape (steps, lanes); ended lanes are left out.

    ``text`` is -1 beyond a lane's end. A window is made from the lanes' places when it is due, so one
    long text costs its own tokens, not as many in every lane.
    """
    dealt = lanes(np.diff(bounds), n)
    if not dealt:
        return
    # The texts in the order of the lanes, and where each lane and each text of it begins.
    texts = np.concatenate(dealt)
    at = np.append(0, np.cumsum(np.diff(bounds)[texts]))
    edge = at[np.append(0, np.cumsum([len(lane) for lane in dealt]))]
    size = np.diff(edge)
    for low in range(0, int(size.max()), steps):
        live = int((size > low).sum())
        place = np.arange(low, min(low + steps, int(size.max())))[:, None]
        inside = place < size[:live]
        token = np.minimum(edge[:live] + place, at[-1] - 1)
        of = np.searchsorted(at, token, "right") - 1
        starts = inside & (token == at[of])
        own = bounds[texts[of]] + token - at[of]
        target = np.where(inside, ids[own], 0).astype(np.int32)
        source = np.where(starts | (own == 0), begin, ids[own - 1])
        # The step after a lane's end reads its last word; it counts for nothing.
        source = np.where(place <= size[:live], source, 0).astype(np.int32)
        yield source, target, starts, np.where(inside, texts[of], -1).astype(np.int32)


def _sigmoid(x):
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += 1
    x *= np.float32(0.5)
    return x


def run(p, source, starts, state):
    """States after each step, and what backpropagation needs; ``state`` is before the first step."""
    steps, n = source.shape
    h = p["state"].shape[0]
    inputs = p["input"][source]
    out = np.empty((steps, n, h), np.float32)
    kept = []
    resets = starts.any(1)
    for t in range(steps):
        if resets[t]:
            state = np.where(starts[t][:, None], np.float32(0), state)
        inner = state @ p["state"]
        gates = _sigmoid(inputs[t, :, : 2 * h] + inner[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        c = np.tanh(inputs[t, :, 2 * h :] + r * inner[:, 2 * h :])
        kept.append((state, z, r, c, inner[:, 2 * h :]))
        state = c + z * (state - c)
        out[t] = state
    return out, kept


def _log_softmax(x, at, gradient: bool):
    """Log probability at one output per row; with ``gradient``, its gradient in the outputs."""
    x -= x.max(1, keepdims=True)
    rows = np.arange(len(x))
    chosen = x[rows, at]
    np.exp(x, out=x)
    total = x.sum(1)
    logs = chosen - np.log(total)
    if not gradient:
        return logs, None
    x *= (-1 / total)[:, None]
    x[rows, at] += 1
    return logs, x


def outputs(p, states, target, gradient: bool):
    """Natural log probability of each target, and with ``gradient`` the gradients of their sum.

    A target beyond the vocabulary counts with its class alone.
    """
    size = p["words"].shape[2]
    last = p["classes"].shape[1] - 1
    of_class = np.minimum(target // size, last)
    logs, d = _log_softmax(states @ p["classes"] + p["class_bias"], of_class, gradient)
    logs = logs.astype(np.float64)
    grads, back = {}, None
    if gradient:
        grads["classes"], grads["class_bias"] = states.T @ d, d.sum(0)
        back = d @ p["classes"].T
        grads["words"], grads["word_bias"] = np.zeros_like(p["words"]), np.zeros_like(p["word_bias"])
    order = np.argsort(of_class.astype(np.uint8 if last < 256 else np.int32), kind="stable")
    edges = np.searchsorted(of_class[order], np.arange(last + 1))
    for c in range(last):
        rows = order[edges[c] : edges[c + 1]]
        if not len(rows):
            continue
        mine = states[rows]
        own, d = _log_softmax(mine @ p["words"][c] + p["word_bias"][c], target[rows] - c * size, gradient)
        logs[rows] += own
        if gradient:
            grads["words"][c], grads["word_bias"][c] = mine.T @ d, d.sum(0)
            back[rows] += d @ p["words"][c].T
    return logs, grads, back


def gradients(p, source, starts, target, valid, state):
    """Gradients of the summed log probability of a window; its last state."""
    steps, n = source.shape
    h = p["state"].shape[0]
    out, kept = run(p, source, starts, state)
    flat = valid.ravel()
    logs, grads, back = outputs(p, out.reshape(-1, h)[flat], target.ravel()[flat], True)
    d_out = np.zeros((steps * n, h), np.float32)
    d_out[flat] = back
    d_out = d_out.reshape(steps, n, h)
    d_inputs = np.empty((steps, n, 3 * h), np.float32)
    d_inner = np.empty((steps, n, 3 * h), np.float32)
    later = np.zeros((n, h), np.float32)
    weights = np.ascontiguousarray(p["state"].T)
    for t in range(steps - 1, -1, -1):
        state, z, r, c, inner = kept[t]
        d = d_out[t] + later
        d_c = d * (1 - z) * (1 - c * c)
        d_inputs[t, :, :h] = d * (state - c) * z * (1 - z)
        d_inputs[t, :, h : 2 * h] = d_c * inner * r * (1 - r)
        d_inputs[t, :, 2 * h :] = d_c
        d_inner[t] = d_inputs[t]
        d_inner[t, :, 2 * h :] *= r
        later = d * z + d_inner[t] @ weights
        if starts[t].any():
            later[starts[t]] = 0
    before = np.stack([k[0] for k in kept]).reshape(-1, h)
    grads["state"] = before.T @ d_inner.reshape(-1, 3 * h)
    grads["input"] = np.zeros_like(p["input"])
    order = np.argsort(source.ravel(), kind="stable")
    ids = source.ravel()[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    grads["input"][ids[first]] = np.add.reduceat(d_inputs.reshape(-1, 3 * h)[order], first)
    return logs, grads, out[-1]


class Adam:
    """Ascent steps on the mean log probability, gradients clipped by their norm."""

    def __init__(self, p, rate: float):
        self.p, self.rate, self.time = p, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in p.items()}
        self.square = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, grads, tokens: int) -> None:
        self.time += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / tokens
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-12)) / tokens)
        fix = np.sqrt(1 - 0.99**self.time) / (1 - 0.9**self.time)
        for k, g in grads.items():
            g = g * scale
            self.mean[k] += np.float32(0.1) * (g - self.mean[k])
            self.square[k] += np.float32(0.01) * (g * g - self.square[k])
            self.p[k] += np.float32(self.rate * fix) * self.mean[k] / (np.sqrt(self.square[k]) + np.float32(1e-8))


def train(p, ids, bounds, *, n: int, steps: int, optimizer: Adam) -> None:
    """One pass over texts: a step per window, states carried across windows."""
    words = p["input"].shape[0] - 2
    state = None
    for source, target, starts, text in windows(ids, bounds, n, steps, words + 1):
        live = source.shape[1]
        state = np.zeros((live, p["state"].shape[0]), np.float32) if state is None else state[:live]
        valid = text >= 0
        _, grads, state = gradients(p, source, starts, target, valid, state)
        optimizer.step(grads, int(valid.sum()))


def score(p, ids, bounds, *, n: int, steps: int) -> np.ndarray:
    """Natural log probability of each text; words beyond the vocabulary count with their class."""
    words = p["input"].shape[0] - 2
    total = np.zeros(len(bounds) - 1)
    state = None
    for source, target, starts, text in windows(ids, bounds, n, steps, words + 1):
        live = source.shape[1]
        state = np.zeros((live, p["state"].shape[0]), np.float32) if state is None else state[:live]
        out, _ = run(p, source, starts, state)
        state = out[-1]
        flat = text.ravel() >= 0
        logs, _, _ = outputs(p, out.reshape(-1, out.shape[2])[flat], target.ravel()[flat], False)
        total += np.bincount(text.ravel()[flat], logs, minlength=len(total))
    return total
