"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation, state carried along."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Shape:
    """Sizes of the model: ``frequent`` words in classes of ``width``, then ``tail`` classes of all other words."""

    def __init__(self, frequent: int, width: int, tail: int, hidden: int):
        self.width, self.tail, self.hidden = width, tail, hidden
        self.own = -(-frequent // width)  # classes of frequent words
        self.frequent = self.own * width
        self.classes = self.own + tail
        #: Input tokens: frequent words, tail classes, and the beginning of a text.
        self.inputs = self.frequent + tail + 1
        self.begin = self.inputs - 1


def initial(shape: Shape, class_share: np.ndarray, word_share: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights that start from the corpus counts: without any training the model is the unigram model."""
    rng = np.random.default_rng(seed)
    h = shape.hidden
    small = lambda *n, s=0.1: (rng.standard_normal(n) * s).astype(F32)
    return {
        "into": small(shape.inputs, 3 * h),
        "recur": small(h, 3 * h, s=1 / np.sqrt(h)),
        "bias": np.zeros(3 * h, F32),
        "to_class": small(h, shape.classes, s=0.01),
        "class_bias": np.log(class_share).astype(F32),
        "to_word": small(shape.own, h, shape.width, s=0.01),
        "word_bias": np.log(word_share).astype(F32).reshape(shape.own, shape.width),
    }


class Batch:
    """Texts side by side in lanes: [time, lane] arrays of inputs, beginnings of texts, and the place of each token."""

    def __init__(self, tokens: list[np.ndarray], lanes: int, shape: Shape):
        order = sorted(range(len(tokens)), key=lambda k: -len(tokens[k]))
        n = max(1, min(lanes, len(order)))
        load, dealt = np.zeros(n, dtype=np.int64), [[] for _ in range(n)]
        heap = [(0, k) for k in range(n)]
        for k in order:  # the longest first, each to the least loaded lane
            total, lane = heapq.heappop(heap)
            dealt[lane].append(k)
            heapq.heappush(heap, (total + len(tokens[k]), lane))
            load[lane] = total + len(tokens[k])
        by_load = np.argsort(-load, kind="stable")
        dealt, load = [dealt[k] for k in by_load], load[by_load]
        self.steps = int(load[0])
        self.live = np.searchsorted(-load, -np.arange(1, self.steps + 1), side="right")  # lanes still running at a step
        self.inputs = np.full((self.steps, n), shape.begin, dtype=np.int32)
        self.first = np.zeros((self.steps, n), dtype=bool)
        self.at = np.full((self.steps, n), -1, dtype=np.int64)
        start = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        for lane, texts in enumerate(dealt):
            p = 0
            for k in texts:
                m = len(tokens[k])
                self.inputs[p + 1 : p + m, lane] = tokens[k][:-1]
                self.first[p, lane] = True
                self.at[p : p + m, lane] = np.arange(start[k], start[k] + m)
                p += m


def run_forward(w: dict, batch: Batch, lo: int, hi: int, h: np.ndarray, keep: bool):
    """States after each step of a window, from state ``h``; with ``keep`` what the way back needs."""
    size = w["recur"].shape[0]
    into = w["into"] + w["bias"]
    out, tape = [], []
    for t in range(lo, hi):
        n = batch.live[t]
        h = h[:n]
        if (first := batch.first[t, :n]).any():
            h = np.where(first[:, None], F32(0), h)
        gx = into[batch.inputs[t, :n]]
        gh = h @ w["recur"]
        zr = sigmoid(gx[:, : 2 * size] + gh[:, : 2 * size])
        z, r = zr[:, :size], zr[:, size:]
        cand = np.tanh(gx[:, 2 * size :] + r * gh[:, 2 * size :])
        new = cand + z * (h - cand)
        if keep:
            tape.append((h, zr, cand, gh[:, 2 * size :], first))
        out.append(new)
        h = new
    return out, h, tape


def exponentials(x: np.ndarray) -> np.ndarray:
    """exp of ``x`` in place, and its row sums. One shift serves all rows: states are within -1 and 1, so rows differ little."""
    x -= x.max()
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def softmax_(x: np.ndarray) -> np.ndarray:
    x /= exponentials(x)[:, None]
    return x


def log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row in the given column."""
    totals = exponentials(x)
    return np.log(x[np.arange(len(x)), at] / totals)


def word_groups(cls: np.ndarray, own: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the tokens of each class of frequent words."""
    at = np.flatnonzero(cls < own)
    order = at[np.argsort(cls[at], kind="stable")]
    cuts = np.searchsorted(cls[order], np.arange(own + 1))
    for c in range(own):
        if cuts[c] < cuts[c + 1]:
            yield c, order[cuts[c] : cuts[c + 1]]


def score(w: dict, shape: Shape, tokens: list[np.ndarray], lanes: int = 256, window: int = 64) -> np.ndarray:
    """Natural-log probabilities of all tokens in order: of frequent words, and of the class for tail words.

    ``tokens`` holds input tokens; every text starts from an empty state, which is carried through all its windows.
    """
    flat = np.concatenate(tokens)
    batch = Batch(tokens, lanes, shape)
    out = np.zeros(len(flat))
    h = np.zeros((batch.inputs.shape[1], shape.hidden), F32)
    for lo in range(0, batch.steps, window):
        hi = min(lo + window, batch.steps)
        states, h, _ = run_forward(w, batch, lo, hi, h, False)
        x = np.concatenate(states)
        at = np.concatenate([batch.at[t, : batch.live[t]] for t in range(lo, hi)])
        token = flat[at]
        cls, word = classes_of(token, shape)
        got = log_softmax_at(x @ w["to_class"] + w["class_bias"], cls)
        for c, k in word_groups(cls, shape.own):
            got[k] += log_softmax_at(x[k] @ w["to_word"][c] + w["word_bias"][c], word[k])
        out[at] = got
    return out


def classes_of(token: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    frequent = token < shape.frequent
    return np.where(frequent, token // shape.width, token - shape.frequent + shape.own), token % shape.width


def gradient(w: dict, shape: Shape, batch: Batch, flat: np.ndarray, lo: int, hi: int, h: np.ndarray):
    """Gradients of the summed loss of a window, the state after it, that loss, and the number of tokens."""
    size = shape.hidden
    states, after, tape = run_forward(w, batch, lo, hi, h, True)
    x = np.concatenate(states)
    at = np.concatenate([batch.at[t, : batch.live[t]] for t in range(lo, hi)])
    n = len(at)
    cls, word = classes_of(flat[at], shape)
    p = softmax_(x @ w["to_class"] + w["class_bias"])
    rows = np.arange(n)
    loss = -float(np.log(p[rows, cls] + 1e-30).sum())
    p[rows, cls] -= 1
    g = {"to_class": x.T @ p, "class_bias": p.sum(0), "to_word": np.zeros_like(w["to_word"]), "word_bias": np.zeros_like(w["word_bias"])}
    dx = p @ w["to_class"].T
    for c, k in word_groups(cls, shape.own):
        xs = x[k]
        q = softmax_(xs @ w["to_word"][c] + w["word_bias"][c])
        own = np.arange(len(k))
        loss -= float(np.log(q[own, word[k]] + 1e-30).sum())
        q[own, word[k]] -= 1
        g["to_word"][c] = xs.T @ q
        g["word_bias"][c] = q.sum(0)
        dx[k] += q @ w["to_word"][c].T
    # Back through the window's steps; what came before it is taken as given. All that does not depend on later steps is
    # worked out for the whole window at once.
    before, zr, cand, from_state, first = (np.concatenate(part) for part in zip(*tape))
    z, r = zr[:, :size], zr[:, size:]
    by_cand = (1 - z) * (1 - cand * cand)
    by_z = (before - cand) * z * (1 - z)
    by_r = by_cand * from_state * r * (1 - r)
    fresh = np.where(first, F32(0), F32(1))[:, None]
    grads, state_grads = np.empty((n, 3 * size), F32), np.empty((n, 3 * size), F32)
    ends = np.concatenate([[0], np.cumsum([len(s) for s in states])])
    back_into, carry = w["recur"].T.copy(), np.zeros((0, size), F32)
    for k in range(hi - lo - 1, -1, -1):
        part = slice(ends[k], ends[k + 1])
        dh = dx[part]
        dh[: len(carry)] += carry
        d, ds = grads[part], state_grads[part]
        np.multiply(dh, by_z[part], out=d[:, :size])
        np.multiply(dh, by_r[part], out=d[:, size : 2 * size])
        np.multiply(dh, by_cand[part], out=d[:, 2 * size :])
        ds[:, : 2 * size] = d[:, : 2 * size]
        np.multiply(d[:, 2 * size :], r[part], out=ds[:, 2 * size :])
        carry = dh * z[part]
        carry += ds @ back_into
        carry *= fresh[part]
    g["recur"] = before.T @ state_grads
    g["bias"] = grads.sum(0)
    token = np.concatenate([batch.inputs[t, : batch.live[t]] for t in range(lo, hi)])
    order = np.argsort(token, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(token[order]) != 0]))
    g["into"] = np.zeros_like(w["into"])
    g["into"][token[order][heads]] = np.add.reduceat(grads[order], heads, axis=0)
    return g, after, loss, n


class Adam:
    def __init__(self, w: dict, rate: float):
        self.w, self.rate, self.step = w, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in w.items()}
        self.v = {k: np.zeros_like(v) for k, v in w.items()}

    def update(self, g: dict, part: float = 1.0) -> None:
        self.step += 1
        rate = F32(part * self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step))
        for name, grad in g.items():
            m, v = self.m[name], self.v[name]
            m += F32(0.1) * (grad - m)
            v += F32(0.001) * (grad * grad - v)
            self.w[name] -= rate * m / (np.sqrt(v) + F32(1e-8))


def train(w: dict, shape: Shape, chunks: Iterator[list[np.ndarray]], rate: float, lanes: int = 256, window: int = 32, step: int = 2048) -> tuple[int, float]:
    """Train ``w`` in place on every token of every chunk of texts by backpropagation truncated to windows; tokens and summed loss.

    Weights move when ``step`` tokens have been seen since, so that the end of a long text, when most lanes have run out,
    does not move them more than its tokens are worth; what is left at the end moves them in proportion.
    """
    adam, seen, total = Adam(w, rate), 0, 0.0
    since, held = 0, {k: np.zeros_like(v) for k, v in w.items()}

    def move(part: float) -> None:
        adam.update({k: v / F32(since) for k, v in held.items()}, part)
        for v in held.values():
            v[...] = 0

    for tokens in chunks:
        batch, flat = Batch(tokens, lanes, shape), np.concatenate(tokens)
        h = np.zeros((batch.inputs.shape[1], shape.hidden), F32)
        for lo in range(0, batch.steps, window):
            hi = min(lo + window, batch.steps)
            g, h, loss, n = gradient(w, shape, batch, flat, lo, hi, h[: batch.live[lo]])
            for k, v in g.items():
                held[k] += v
            since, seen, total = since + n, seen + n, total + loss
            if since >= step:
                move(1.0)
                since = 0
    if since:
        move(since / step)
    return seen, total
