"""Bidirectional LSTM, linear-chain CRF and Adam in numpy; time runs along the first axis."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def new_bilstm(rng: np.random.Generator, inputs: int, hidden: int, outputs: int) -> Params:
    scale = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b)).astype(np.float32)
    p: Params = {"out": scale(2 * hidden, outputs), "out_b": np.zeros(outputs, np.float32)}
    for d in ("f", "b"):
        p |= {f"x_{d}": scale(inputs, 4 * hidden), f"h_{d}": scale(hidden, 4 * hidden)}
        bias = np.zeros(4 * hidden, np.float32)
        bias[hidden : 2 * hidden] = 1  # remember at first
        p[f"bias_{d}"] = bias
    return p


def _run(p: Params, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    steps, batch = x.shape[:2]
    size = p[f"h_{d}"].shape[0]
    h, c = np.zeros((batch, size), np.float32), np.zeros((batch, size), np.float32)
    drive = x @ p[f"x_{d}"] + p[f"bias_{d}"]
    out, tape = np.zeros((steps, batch, size), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = drive[t] + h @ p[f"h_{d}"]
        gate = _sigmoid(z[:, : 3 * size])
        i, f, o = gate[:, :size], gate[:, size : 2 * size], gate[:, 2 * size :]
        g = np.tanh(z[:, 3 * size :])
        m = mask[t][:, None]
        new = f * c + i * g
        s = np.tanh(new)
        if keep:
            tape.append((t, h, c, i, f, o, g, s, m))
        h, c = m * (o * s) + (1 - m) * h, m * new + (1 - m) * c
        out[t] = m * h
    return out, tape


def forward(p: Params, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Scores (steps, batch, outputs) for inputs (steps, batch, width); masked steps change nothing."""
    fore, tape_f = _run(p, "f", x, mask, keep)
    back, tape_b = _run(p, "b", x, mask, keep)
    both = np.concatenate([fore, back], axis=2)
    return both @ p["out"] + p["out_b"], (x, both, tape_f, tape_b)


def backward(p: Params, memory: tuple, d_out: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the parameters and of the inputs."""
    x, both, *tapes = memory
    width = both.shape[2]
    grads = {"out": both.reshape(-1, width).T @ d_out.reshape(-1, d_out.shape[2]), "out_b": d_out.sum(axis=(0, 1))}
    d_both = d_out @ p["out"].T
    size = width // 2
    d_x = np.zeros_like(x)
    for d, tape, d_h_out in (("f", tapes[0], d_both[:, :, :size]), ("b", tapes[1], d_both[:, :, size:])):
        d_z_all = np.zeros((*x.shape[:2], 4 * size), np.float32)
        d_w = np.zeros_like(p[f"h_{d}"])
        d_h, d_c = np.zeros(x.shape[1:2] + (size,), np.float32), np.zeros(x.shape[1:2] + (size,), np.float32)
        for t, h_was, c_was, i, f, o, g, s, m in reversed(tape):
            d_h = d_h + m * d_h_out[t]
            d_new_h, d_new_c = m * d_h, m * d_c
            d_cell = d_new_c + d_new_h * o * (1 - s * s)
            d_z = np.concatenate(
                [d_cell * g * i * (1 - i), d_cell * c_was * f * (1 - f), d_new_h * s * o * (1 - o), d_cell * i * (1 - g * g)], axis=1
            )
            d_z_all[t] = d_z
            d_w += h_was.T @ d_z
            d_h = (1 - m) * d_h + d_z @ p[f"h_{d}"].T
            d_c = (1 - m) * d_c + d_cell * f
        flat = d_z_all.reshape(-1, 4 * size)
        grads |= {f"x_{d}": x.reshape(-1, x.shape[2]).T @ flat, f"h_{d}": d_w, f"bias_{d}": flat.sum(axis=0)}
        d_x += d_z_all @ p[f"x_{d}"].T
    return grads, d_x


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, p: Params, grads: Params) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = min(1.0, 5.0 / (norm + 1e-9))
        for k, g in grads.items():
            g = g * shrink
            self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g
            self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * g * g
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            p[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(p[k].dtype)


def _lse(z: np.ndarray, axis: int) -> np.ndarray:
    top = z.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(z - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores: np.ndarray, tags: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss, and its gradients by scores and by ``moves[from, to]``, by forward and backward sums.

    The first step of every sequence must be unmasked and masked steps are at the end.
    """
    steps, batch, k = scores.shape
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        new = _lse(alpha[t - 1][:, :, None] + moves[None], 1) + scores[t]
        alpha[t] = np.where(mask[t][:, None] > 0, new, alpha[t - 1])
    for t in range(steps - 2, -1, -1):
        new = _lse(moves[None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        beta[t] = np.where(mask[t + 1][:, None] > 0, new, beta[t + 1])
    total = _lse(alpha[-1], 1)
    d_scores = np.exp(alpha + beta - total[None, :, None]) * mask[:, :, None]
    line = np.arange(batch)
    d_moves, gold = np.zeros_like(moves), scores[0][line, tags[0]] * mask[0]
    d_scores[0][line, tags[0]] -= mask[0]
    for t in range(1, steps):
        m = mask[t]
        pair = alpha[t - 1][:, :, None] + moves[None] + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
        d_moves += (np.exp(np.minimum(pair, 0)) * m[:, None, None]).sum(axis=0)
        np.add.at(d_moves, (tags[t - 1], tags[t]), -m)
        gold = gold + m * (scores[t][line, tags[t]] + moves[tags[t - 1], tags[t]])
        d_scores[t][line, tags[t]] -= m
    return float((total - gold).mean()), (d_scores / batch).astype(np.float32), (d_moves / batch).astype(np.float32)


def crf_decode(scores: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The best tags (steps, batch); 0 at masked steps."""
    steps, batch, _ = scores.shape
    best, came = scores[0], np.zeros(scores.shape, np.int16)
    for t in range(1, steps):
        ways = best[:, :, None] + moves[None]
        came[t] = ways.argmax(axis=1)
        live = mask[t][:, None] > 0
        best = np.where(live, ways.max(axis=1) + scores[t], best)
        came[t] = np.where(live, came[t], np.arange(scores.shape[2])[None])
    tags = np.zeros((steps, batch), np.int16)
    at, line = best.argmax(axis=1), np.arange(batch)
    for t in range(steps - 1, -1, -1):
        tags[t] = np.where(mask[t] > 0, at, 0)
        at = came[t][line, at]
    return tags
