"""Attention-based multiple-instance learning: a document is a bag of passages with one label.

Each passage vector x is encoded, h = tanh(W x + b); gated attention gives it a weight,
softmax over the bag of w . (tanh(V h) * sigmoid(U h)); the document's vector is the
weighted sum of its h, and a logistic unit scores it. Only document labels are learned
from. The softmax is summed run by run, so a bag of any size is scored in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

HIDDEN, GATE = 16, 8


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start(n_features: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *s: rng.normal(0, s[0] ** -0.5, s)
    return {
        "W": draw(n_features, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE),
        "w": draw(GATE, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "c0": np.zeros(1),
    }


def gradients(p: dict, x: np.ndarray, bag: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean log loss over the bags and its gradient; rows of ``x`` come sorted by ``bag``."""
    heads = np.flatnonzero(np.r_[True, bag[1:] != bag[:-1]])
    total = lambda v: np.add.reduceat(v, heads, axis=0)
    h = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * s) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, heads)[bag])
    a = e / total(e)[bag]
    z = total(a[:, None] * h)
    y = _sigmoid(z @ p["c"] + p["c0"])
    loss = -np.mean(labels * np.log(y + 1e-9) + (1 - labels) * np.log(1 - y + 1e-9))
    d = (y - labels) / len(labels)
    g = {"c": z.T @ d, "c0": np.array([d.sum()])}
    dz = (d[:, None] * p["c"])[bag]
    da = (dz * h).sum(1)
    de = a * (da - total(a * da)[bag])
    g["w"] = (t * s).T @ de
    dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
    g["V"], g["U"] = h.T @ dt, h.T @ ds
    dh = a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T
    du = dh * (1 - h * h)
    g["W"], g["b"] = x.T @ du, du.sum(0)
    return float(loss), g


def fit(x: np.ndarray, bag: np.ndarray, labels: np.ndarray, steps: int = 250, rate: float = 0.02, seed: int = 7) -> dict:
    """Adam on all bags at once; the model carries the mean and spread of the features."""
    mean, spread = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / spread
    p = start(x.shape[1], seed)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        _, g = gradients(p, x, bag, labels)
        for k in p:
            grad = g[k] + 1e-4 * p[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad**2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return {k: a.astype(np.float32) for k, a in (p | {"mean": mean, "spread": spread}).items()}


def score(p: dict, runs: Iterable[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Scores of ``n`` bags from runs of (bag of each passage, features)."""
    top, weight, z = np.full(n, -np.inf), np.zeros(n), np.zeros((n, HIDDEN))
    for bag, x in runs:
        h = np.tanh((x - p["mean"]) / p["spread"] @ p["W"] + p["b"])
        e = (np.tanh(h @ p["V"]) * _sigmoid(h @ p["U"])) @ p["w"]
        before = top.copy()
        np.maximum.at(top, bag, e)
        shrink = np.where(np.isfinite(before), np.exp(before - np.where(np.isfinite(top), top, 0)), 0)
        e = np.exp(e - top[bag])
        weight = weight * shrink + np.bincount(bag, e, minlength=n)
        z *= shrink[:, None]
        np.add.at(z, bag, e[:, None] * h)
    return _sigmoid(z / np.maximum(weight, 1e-30)[:, None] @ p["c"] + p["c0"])
