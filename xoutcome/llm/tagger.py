"""A character-level bidirectional LSTM with a CRF on top, in numpy: training by Adam, marginals, constrained decoding.

Sequences are rows of small integers (character classes, 0 for padding) of one length. Tags are 0 for outside and, for
kind k, 1 + 2k at its first character and 2 + 2k at the others; transitions that this rules out have no weight.
"""

from __future__ import annotations

import numpy as np

TINY = 1e-30


def allowed(kinds: int) -> np.ndarray:
    """Which tag may follow which: an inner tag only its kind's first or inner one."""
    tags = 1 + 2 * kinds
    out = np.ones((tags, tags), bool)
    for k in range(kinds):
        out[:, 2 + 2 * k] = False
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(chars: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: bool):
    """States (time, row, unit) over ``chars`` (time, row), and what the way back needs."""
    n, size = chars.shape[1], wh.shape[0]
    h, c = np.zeros((n, size), wh.dtype), np.zeros((n, size), wh.dtype)
    states, past = np.empty((len(chars), n, size), wh.dtype), []
    for t, row in enumerate(chars):
        z = wx[row] + h @ wh
        gates = _sigmoid(z[:, :3 * size])
        new = np.tanh(z[:, 3 * size:])
        i, f, o = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
        before, c = c, f * c + i * new
        top = np.tanh(c)
        if keep:
            past.append((h, before, i, f, o, new, top))
        h = o * top
        states[t] = h
    return states, past


def _lstm_back(chars: np.ndarray, wx: np.ndarray, wh: np.ndarray, past: list, grad: np.ndarray):
    """Gradients of the input and state weights from those of the states."""
    size = wh.shape[0]
    d_wx, d_wh = np.zeros_like(wx), np.zeros_like(wh)
    dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t in range(len(chars) - 1, -1, -1):
        h, before, i, f, o, new, top = past[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - top * top)
        dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * top * o * (1 - o), dc * i * (1 - new * new)], axis=1)
        np.add.at(d_wx, chars[t], dz)
        d_wh += h.T @ dz
        dh, dc = dz @ wh.T, dc * f
    return d_wx, d_wh


class Tagger:
    """Weights by name; ``classes`` character classes, ``kinds`` kinds of spans, ``size`` units in each direction."""

    def __init__(self, classes: int, kinds: int, size: int = 16, seed: int = 1):
        draw = np.random.default_rng(seed)
        tags = 1 + 2 * kinds
        make = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0] if shape[0] < classes else 4), shape)
        self.kinds, self.rule = kinds, allowed(kinds)
        self.w = {"wx_f": make(classes, 4 * size), "wh_f": make(size, 4 * size), "wx_b": make(classes, 4 * size), "wh_b": make(size, 4 * size),
                  "out": make(2 * size, tags), "bias": np.zeros(tags), "trans": np.zeros((tags, tags)), "first": np.zeros(tags)}
        for d in "fb":
            self.w[f"wx_{d}"][:, size:2 * size] += 1  # remember at first

    def as_type(self, kind) -> "Tagger":
        """The same weights in another precision."""
        out = object.__new__(Tagger)
        out.kinds, out.rule, out.w = self.kinds, self.rule, {k: v.astype(kind) for k, v in self.w.items()}
        return out

    def emissions(self, rows: np.ndarray, keep: bool = False):
        """Scores (time, row, tag) of every character's tags."""
        chars = rows.T
        ahead, past_f = _lstm(chars, self.w["wx_f"], self.w["wh_f"], keep)
        back, past_b = _lstm(chars[::-1], self.w["wx_b"], self.w["wh_b"], keep)
        states = np.concatenate([ahead, back[::-1]], axis=2)
        return states @ self.w["out"] + self.w["bias"], (states, past_f, past_b)

    def _chain(self, e: np.ndarray):
        """Log sums over all tag sequences up to and from each place, and over all."""
        step = np.exp(self.w["trans"]) * self.rule
        up, down = np.empty_like(e), np.zeros_like(e)
        up[0] = self.w["first"] + e[0]
        for t in range(1, len(e)):
            top = up[t - 1].max(axis=1, keepdims=True)
            up[t] = top + np.log(np.exp(up[t - 1] - top) @ step + TINY) + e[t]
        for t in range(len(e) - 2, -1, -1):
            x = e[t + 1] + down[t + 1]
            top = x.max(axis=1, keepdims=True)
            down[t] = top + np.log(np.exp(x - top) @ step.T + TINY)
        top = up[-1].max(axis=1)
        return up, down, top + np.log(np.exp(up[-1] - top[:, None]).sum(axis=1)), step

    def log_marginals(self, rows: np.ndarray) -> np.ndarray:
        """Log probabilities (row, time, tag) of every character's tags."""
        e, _ = self.emissions(rows)
        up, down, total, _ = self._chain(e)
        return np.minimum(up + down - total[None, :, None], 0).transpose(1, 0, 2)

    def loss_and_gradients(self, rows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log probability of the tags, and its gradient by every weight."""
        e, (states, past_f, past_b) = self.emissions(rows, keep=True)
        up, down, total, step = self._chain(e)
        n, gold = len(rows), tags.T
        at = np.arange(n)
        score = self.w["first"][gold[0]] + sum(e[t, at, gold[t]] for t in range(len(e))) + sum(
            self.w["trans"][gold[t - 1], gold[t]] for t in range(1, len(e)))
        de = np.exp(up + down - total[None, :, None])
        d_first = de[0].sum(axis=0)
        np.subtract.at(d_first, gold[0], 1)
        d_trans = np.zeros_like(self.w["trans"])
        for t in range(1, len(e)):
            a, b = up[t - 1], e[t] + down[t]
            top_a, top_b = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
            scale = np.exp(top_a + top_b - total[:, None])
            d_trans += (np.exp(a - top_a) * scale).T @ np.exp(b - top_b) * step
            np.subtract.at(d_trans, (gold[t - 1], gold[t]), 1)
        for t in range(len(e)):
            de[t, at, gold[t]] -= 1
        g = {"first": d_first, "trans": d_trans, "bias": de.sum(axis=(0, 1)), "out": np.einsum("tnh,tnk->hk", states, de)}
        ds = de @ self.w["out"].T
        size = ds.shape[2] // 2
        chars = rows.T
        g["wx_f"], g["wh_f"] = _lstm_back(chars, self.w["wx_f"], self.w["wh_f"], past_f, ds[:, :, :size])
        g["wx_b"], g["wh_b"] = _lstm_back(chars[::-1], self.w["wx_b"], self.w["wh_b"], past_b, ds[::-1, :, size:])
        return float((total - score).sum() / n), {k: v / n for k, v in g.items()}

    def train(self, rows: np.ndarray, tags: np.ndarray, steps: int = 400, batch: int = 64, rate: float = 0.02, seed: int = 1) -> list[float]:
        """Adam over batches in a fixed shuffled order, the rate falling to a tenth; returns the losses."""
        draw = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        order, losses = np.empty(0, np.int64), []
        for s in range(1, steps + 1):
            while len(order) < batch:
                order = np.concatenate([order, draw.permutation(len(rows))])
            own, order = order[:batch], order[batch:]
            loss, g = self.loss_and_gradients(rows[own], tags[own])
            losses.append(loss)
            norm = np.sqrt(sum((v * v).sum() for v in g.values()))
            shrink = min(1.0, 5.0 / max(norm, 1e-12))
            now = rate * 0.1 ** (s / steps)
            for k, v in g.items():
                v = v * shrink
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                self.w[k] -= now * first[k] / (1 - 0.9 ** s) / (np.sqrt(second[k] / (1 - 0.999 ** s)) + 1e-8)
        return losses


def best_tags(scores: np.ndarray, rule: np.ndarray) -> np.ndarray:
    """The tags (row, time) of largest summed scores (row, time, tag) among the sequences that ``rule`` allows.

    Padding at a row's end should score 0 for outside and far less for the rest.
    """
    n, length, tags = scores.shape
    ban = np.where(rule, 0.0, -1e9)
    best = scores[:, 0] + np.where(rule[0], 0.0, -1e9)  # as after an outside character
    came = np.empty((length, n, tags), np.int16)
    for t in range(1, length):
        through = best[:, :, None] + ban
        came[t] = through.argmax(axis=1)
        best = through.max(axis=1) + scores[:, t]
    out = np.empty((n, length), np.int64)
    out[:, -1] = best.argmax(axis=1)
    for t in range(length - 1, 0, -1):
        out[:, t - 1] = came[t][np.arange(n), out[:, t]]
    return out
