"""A bidirectional gated recurrent network over bytes, in numpy.

Two GRUs read a window of bytes, one from each end; every position is labelled from both
states by a softmax. Training is backpropagation through time over windows whose document
gives the label of all positions. For scoring, windows of many texts step together, so the
work is a few matrix operations for each of the ``WINDOW`` positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HIDDEN = 8
WINDOW = 64
#: Windows that step together in scoring.
BATCH = 4096
PAD = 0


def start(n_classes: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {
        "E": rng.normal(0, 0.3, (2, 256, 3 * HIDDEN)),
        "U": rng.normal(0, HIDDEN**-0.5, (2, HIDDEN, 3 * HIDDEN)),
        "b": np.zeros((2, 1, 3 * HIDDEN)),
        "O": rng.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, n_classes)),
        "o": np.zeros(n_classes),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def states(p: dict, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (position, window, 2 * HIDDEN) of both directions for windows ``x`` (position, window) of bytes.

    Gates are update z, reset r and candidate n: h' = z * h + (1 - z) * n, n = tanh(E + r * (h U)).
    """
    steps, n = x.shape
    both = np.stack([x, x[::-1]])
    rows = both + np.array([0, 256])[:, None, None]
    h = np.zeros((2, n, HIDDEN), p["E"].dtype)
    out = np.empty((2, steps, n, HIDDEN), p["E"].dtype)
    table = (p["E"] + p["b"]).reshape(512, 3 * HIDDEN)
    for t in range(steps):
        given = np.take(table, rows[:, t], axis=0)
        told = h @ p["U"]
        zr = _sigmoid(given[..., : 2 * HIDDEN] + told[..., : 2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        c = np.tanh(given[..., 2 * HIDDEN :] + r * told[..., 2 * HIDDEN :])
        if keep is not None:
            keep.append((h, z, r, c, told[..., 2 * HIDDEN :]))
        h = c + z * (h - c)
        out[:, t] = h
    return np.concatenate([out[0], out[1, ::-1]], axis=2)


def position_probabilities(p: dict, s: np.ndarray) -> np.ndarray:
    logits = s @ p["O"] + p["o"]
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(p: dict, x: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean log loss over the positions that are not padding, and its gradient."""
    steps, n = x.shape
    kept: list = []
    s = states(p, x, kept)
    q = position_probabilities(p, s)
    mask = (x != PAD) / max(1, int((x != PAD).sum()))
    loss = -float((np.log(q[:, np.arange(n), label] + 1e-9) * mask).sum())
    d = q.copy()
    d[:, np.arange(n), label] -= 1
    d *= mask[..., None]
    g = {"O": np.einsum("tnh,tnk->hk", s, d), "o": d.sum((0, 1)), "E": np.zeros_like(p["E"]), "U": np.zeros_like(p["U"]), "b": np.zeros_like(p["b"])}
    ds = d @ p["O"].T
    ds = np.stack([ds[..., :HIDDEN], ds[::-1, :, HIDDEN:]])
    both = np.stack([x, x[::-1]])
    dh = np.zeros((2, n, HIDDEN))
    for t in reversed(range(steps)):
        h, z, r, c, told = kept[t]
        dh = dh + ds[:, t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * told * r * (1 - r)
        pre = np.concatenate([dz, dr, dc], axis=2)
        back = np.concatenate([dz, dr, dc * r], axis=2)
        for k in range(2):
            np.add.at(g["E"][k], both[k, t], pre[k])
        g["b"] += pre.sum(1, keepdims=True)
        g["U"] += h.transpose(0, 2, 1) @ back
        dh = dh * z + back @ p["U"].transpose(0, 2, 1)
    return loss, g


def windows(text: bytes, width: int = WINDOW) -> np.ndarray:
    """(window, position): the text cut into windows, the last one padded."""
    data = np.frombuffer(text, np.uint8)
    n = max(1, -(-len(data) // width))
    return np.pad(data, (0, n * width - len(data))).reshape(n, width)


def fit(texts: list[bytes], labels: np.ndarray, n_classes: int, steps: int = 300, batch: int = 192, rate: float = 0.02, seed: int = 7) -> dict:
    """Adam over random windows, classes drawn evenly."""
    cut = [windows(t) for t in texts]
    x = np.concatenate(cut)
    y = np.repeat(labels, [len(c) for c in cut])
    rng = np.random.default_rng(seed)
    groups = [np.flatnonzero(y == k) for k in range(n_classes)]
    p = start(n_classes, seed)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(groups[k]) for k in rng.integers(0, n_classes, batch)])
        _, g = gradients(p, x[pick].T.astype(np.int64), y[pick])
        norm = np.sqrt(sum((a * a).sum() for a in g.values()))
        for k in p:
            grad = g[k] * min(1.0, 1.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad**2
            p[k] = p[k] - rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return {k: a.astype(np.float32) for k, a in p.items()}


def _batches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text of each window, windows), ``BATCH`` at a time; a long text goes on in the next batch."""
    held, owner, count = [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text)), WINDOW * BATCH):
            part = windows(text[at : at + WINDOW * BATCH])
            held.append(part)
            owner.append(np.full(len(part), k))
            count += len(part)
            if count >= BATCH:
                yield np.concatenate(owner), np.concatenate(held)
                held, owner, count = [], [], 0
    if held:
        yield np.concatenate(owner), np.concatenate(held)


def document_probabilities(p: dict, texts: list[bytes]) -> np.ndarray:
    """Mean of the position probabilities of each text; a text without bytes has equal ones."""
    k = len(p["o"])
    total, count = np.zeros((len(texts), k)), np.zeros(len(texts))
    for owner, x in _batches(texts):
        x = np.ascontiguousarray(x.T)
        real = x != PAD
        q = position_probabilities(p, states(p, x)) * real[..., None]
        np.add.at(total, owner, q.sum(0))
        np.add.at(count, owner, real.sum(0))
    return np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], 1 / k)
