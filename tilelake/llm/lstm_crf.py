"""A small character-level bidirectional LSTM with a CRF on top, in numpy."""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN = 12, 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def new_parameters(symbols: int, tags: int, seed: int = 5) -> dict[str, np.ndarray]:
    """Both directions of the LSTM stand behind each other in ``w`` and ``b``."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape)
    p = {"embed": rng.normal(0, 0.3, (symbols, EMBED)), "out": draw(2 * HIDDEN, tags), "out_b": np.zeros(tags), "move": np.zeros((tags, tags)), "start": np.zeros(tags)}
    p["w"], p["b"] = draw(2, EMBED + HIDDEN, 4 * HIDDEN), np.zeros((2, 1, 4 * HIDDEN))
    p["b"][:, :, HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
    return p


def _lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray):
    """x: time, direction, batch, features. Hidden states and what the backward pass needs."""
    steps, _, batch, size = x.shape
    h = c = np.zeros((2, batch, HIDDEN), x.dtype)
    hs, kept = np.empty((steps, 2, batch, HIDDEN), x.dtype), []
    ahead, again = x @ w[:, :size] + b, w[:, size:]
    for t in range(steps):
        z = ahead[t] + h @ again
        gates = _sigmoid(z[..., : 3 * HIDDEN])
        i, f, o = gates[..., :HIDDEN], gates[..., HIDDEN : 2 * HIDDEN], gates[..., 2 * HIDDEN :]
        g = np.tanh(z[..., 3 * HIDDEN :])
        before = c
        c = f * c + i * g
        squashed = np.tanh(c)
        h = hs[t] = o * squashed
        kept.append((i, f, o, g, before, squashed))
    return hs, kept


def _lstm_back(x, w, hs, kept, d_hs):
    steps, _, batch, size = x.shape
    dz, again = np.empty((steps, 2, batch, 4 * HIDDEN), x.dtype), w[:, size:].swapaxes(1, 2)
    dh = dc = np.zeros((2, batch, HIDDEN), x.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, squashed = kept[t]
        dh = dh + d_hs[t]
        dc = dc + dh * o * (1 - squashed**2)
        dz[t] = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)), axis=2)
        dh, dc = dz[t] @ again, dc * f
    each = lambda y: y.swapaxes(0, 1).reshape(2, -1, y.shape[3])
    read = np.concatenate((x, np.concatenate((np.zeros_like(hs[:1]), hs[:-1]))), axis=3)
    return dz @ w[:, :size].swapaxes(1, 2), each(read).swapaxes(1, 2) @ each(dz), each(dz).sum(axis=1, keepdims=True)


def _scores(p: dict, symbols: np.ndarray):
    """symbols: batch, time. Tag scores: time, batch, tags."""
    x = p["embed"][symbols.T]
    x = np.stack((x, x[::-1]), axis=1)
    hs, kept = _lstm(x, p["w"], p["b"])
    h = np.concatenate((hs[:, 0], hs[::-1, 1]), axis=2)
    return h @ p["out"] + p["out_b"], (x, h, hs, kept)


def loss_and_gradients(p: dict, symbols: np.ndarray, tags: np.ndarray, barred: np.ndarray):
    """Mean negative log-likelihood of the tag paths; ``barred`` moves have no weight.

    Sums over paths are kept as probabilities, scaled to one at every step.
    """
    emit, (x, h, hs, kept) = _scores(p, symbols)
    steps, batch, n = emit.shape
    move = np.where(barred, 0, np.exp(p["move"]))
    top = emit.max(axis=2, keepdims=True)
    e, scale = np.exp(emit - top), np.empty((steps, batch, 1), emit.dtype)
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    for t in range(steps):
        a = e[t] * (alpha[t - 1] @ move if t else np.exp(p["start"]))
        scale[t] = a.sum(axis=1, keepdims=True)
        alpha[t] = a / scale[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = (beta[t + 1] * e[t + 1]) @ move.T / scale[t + 1]
    total = (np.log(scale) + top).sum(axis=(0, 2))
    y = tags.T
    gold = p["start"][y[0]] + np.take_along_axis(emit, y[:, :, None], 2).sum(axis=(0, 2)) + p["move"][y[:-1], y[1:]].sum(axis=0)
    d_emit = alpha * beta
    d_move = move * (alpha[:-1].reshape(-1, n).T @ (beta[1:] * e[1:] / scale[1:]).reshape(-1, n))
    np.subtract.at(d_move, (y[:-1], y[1:]), 1)
    np.put_along_axis(d_emit, y[:, :, None], np.take_along_axis(d_emit, y[:, :, None], 2) - 1, 2)
    g = {"out": h.reshape(-1, h.shape[2]).T @ d_emit.reshape(-1, n), "out_b": d_emit.sum(axis=(0, 1)), "move": np.where(barred, 0, d_move), "start": d_emit[0].sum(axis=0)}
    dh = d_emit @ p["out"].T
    dx, g["w"], g["b"] = _lstm_back(x, p["w"], hs, kept, np.stack((dh[:, :, :HIDDEN], dh[::-1, :, HIDDEN:]), axis=1))
    g["embed"] = np.zeros_like(p["embed"])
    np.add.at(g["embed"], symbols.T, dx[:, 0] + dx[::-1, 1])
    return (total - gold).mean(), {k: v / batch for k, v in g.items()}


def train(symbols: np.ndarray, tags: np.ndarray, n_symbols: int, barred: np.ndarray, rounds: int, batch: int = 96, rate: float = 0.015, seed: int = 5):
    """Adam on batches drawn by a fixed seed; the result depends on the rows alone."""
    p = {k: x.astype(np.float32) for k, x in new_parameters(n_symbols, len(barred), seed).items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    rng = np.random.default_rng(seed)
    for step in range(1, rounds + 1):
        some = rng.integers(0, len(symbols), min(batch, len(symbols)))
        _, g = loss_and_gradients(p, symbols[some], tags[some], barred)
        norm = np.sqrt(sum((x**2).sum() for x in g.values()))
        for k in p:
            d = g[k] * min(1.0, 5.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            p[k] -= rate * min(1, 0.02 + 1.6 * (1 - step / rounds)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    p["move"] = np.where(barred, -1e4, p["move"])
    return {k: x.astype(np.float32) for k, x in p.items()}


def decode(p: dict, symbols: np.ndarray) -> np.ndarray:
    """Best tag paths: batch, time."""
    emit, _ = _scores(p, symbols)
    steps, batch, n = emit.shape
    best, back = emit[0] + p["start"], np.empty((steps, batch, n), np.int8)
    for t in range(1, steps):
        paths = best[:, :, None] + p["move"]
        back[t] = paths.argmax(axis=1)
        best = paths.max(axis=1) + emit[t]
    out = np.empty((batch, steps), np.int8)
    out[:, -1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[t][np.arange(batch), out[:, t]]
    return out
