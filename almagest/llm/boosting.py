"""Gradient-boosted trees for a yes/no label, and isotonic calibration, in numpy.

They train on the driver, on a matrix whose rows the caller bounds.
"""

from __future__ import annotations

import numpy as np


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1).astype(np.int32)


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 2.0) -> dict:
    """Second-order boosting of log loss; leaves hold at least ``least`` of hessian / 0.25 rows."""
    n, m = x.shape
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    base = float(np.log(prior / (1 - prior)))
    out = {"base": base, "rate": rate, "trees": []}
    if not n or y.min() == y.max():
        return out
    edges = _edges(x, bins)
    b = _binned(x, edges)
    width = bins + 1
    raw = np.full(n, base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        feature, cut, value = np.full(2 ** (depth + 1) - 1, -1), np.zeros(2 ** (depth + 1) - 1), np.zeros(2 ** (depth + 1) - 1)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == k)
                if not len(rows):
                    continue
                gs, hs, best = g[rows].sum(), h[rows].sum(), (1e-6, -1, 0)
                for f in range(m):
                    gl = np.cumsum(np.bincount(b[rows, f], weights=g[rows], minlength=width))[:-1]
                    hl = np.cumsum(np.bincount(b[rows, f], weights=h[rows], minlength=width))[:-1]
                    gr, hr = gs - gl, hs - hl
                    gain = np.where((hl > least * 0.05) & (hr > least * 0.05), gl**2 / (hl + l2) + gr**2 / (hr + l2) - gs**2 / (hs + l2), 0)[: len(edges[f])]
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), f, int(gain.argmax()))
                if best[1] < 0:
                    continue
                feature[k], cut[k] = best[1], edges[best[1]][best[2]]
                node[rows] = 2 * k + 1 + (b[rows, best[1]] > best[2])
        for k in np.unique(node):
            rows = node == k
            value[k] = -g[rows].sum() / (h[rows].sum() + l2)
        raw += rate * value[node]
        out["trees"].append((feature, cut, value))
    return out


def raw_scores(model: dict, x: np.ndarray) -> np.ndarray:
    raw = np.full(len(x), model["base"])
    for feature, cut, value in model["trees"]:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        raw += model["rate"] * value[node]
    return raw


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising step function, to interpolate."""
    if not len(raw):
        return np.array([0.0]), np.array([0.5])
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of raw
    for r, v in zip(raw[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(r)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, t = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][2] += t
    return np.array([t / n for _, n, t in blocks]), np.array([s / n for s, n, _ in blocks])


def calibrated(knots: tuple[np.ndarray, np.ndarray], raw: np.ndarray) -> np.ndarray:
    """Isotonic value, and a hundredth of the plain logistic so that ties keep their order."""
    flat = np.interp(raw, knots[0], knots[1])
    return np.clip(0.99 * flat + 0.01 / (1 + np.exp(-np.clip(raw, -30, 30))), 0, 1)
