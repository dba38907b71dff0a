"""Byte n-grams of texts and small linear models, in NumPy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .arrays import U, mix

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def letters(data: np.ndarray) -> np.ndarray:
    """Lower-case letters; every other ASCII byte becomes a space, other bytes stay
    (capitals of the Latin-1 block become small)."""
    out = _LETTER[data]
    if len(out) > 1:
        big = np.zeros(len(out), bool)
        big[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[big] += 0x20
    return out


def grams(clean: np.ndarray, offsets: np.ndarray, n: int, log2: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of bytes that lie within one text: codes below 2**log2, and the range of each text."""
    m = len(clean) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    x = np.zeros(m, np.uint64)
    for j in range(n):
        x |= clean[j : j + m].astype(np.uint64) << U(8 * j)
    codes = (mix(x + U(n << 56)) >> U(64 - log2)).astype(np.int64)
    keep = np.ones(m, bool)
    for d in range(1, n):
        at = offsets[1:-1] - d
        keep[at[(at >= 0) & (at < m)]] = False
    at = np.flatnonzero(keep)
    return codes[at], np.searchsorted(at, offsets)


def minimize(f: Callable, w: np.ndarray, steps: int = 80, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``f`` gives value and gradient."""
    value, g = f(w)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, back = g.copy(), []
        for s, y, r in reversed(pairs):
            a = r * (s @ q)
            q -= a * y
            back.append(a)
        if pairs:
            s, y, r = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.abs(g).sum())
        for (s, y, r), a in zip(pairs, reversed(back), strict=True):
            q += s * (a - r * (y @ q))
        slope, t = g @ q, 1.0
        if slope <= 1e-12:
            break
        while True:
            new = w - t * q
            v, h = f(new)
            if v <= value - 1e-4 * t * slope or t < 1e-8:
                break
            t /= 2
        s, y = new - w, h - g
        done = value - v < 1e-8 * max(1.0, abs(value))
        w, value, g = new, v, h
        if done:
            break
        if s @ y > 1e-12:
            pairs = [*pairs[-(memory - 1) :], (s, y, 1 / (s @ y))]
    return w


def svm(x: np.ndarray, y: np.ndarray, cost: float = 20.0) -> np.ndarray:
    """Linear support vector machine (squared hinge); labels -1 and 1. The last weight is the bias."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)

    def f(w):
        gap = np.maximum(0.0, 1 - y * (x @ w[:-1] + w[-1]))
        pull = -2 * cost * share * y * gap
        return 0.5 * (w[:-1] @ w[:-1]) + cost * (share * gap * gap).sum(), np.r_[w[:-1] + x.T @ pull, pull.sum()]

    return minimize(f, np.zeros(x.shape[1] + 1))


def logistic(sets: list[np.ndarray], scale: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, block: int = 1 << 20) -> np.ndarray:
    """Logistic regression on sparse 0/1 features (positions, one array a row) times ``scale``; labels 0 and 1. The last weight is the bias.

    Rows are taken in blocks of about ``block`` positions, which bounds what is held beside them.
    """
    n, sizes = len(scale), np.array([len(s) for s in sets])
    starts = np.r_[0, np.cumsum(sizes)]
    cuts = np.unique(np.r_[np.searchsorted(starts, np.arange(0, starts[-1] + 1, block)), len(sets)])
    parts = [(lo, hi, np.concatenate(sets[lo:hi]).astype(np.int32), starts[lo:hi] - starts[lo], sizes[lo:hi]) for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    sets.clear()

    def f(w):
        scaled, loss, slope, bias = w[:-1] * scale, 0.0, np.zeros(n), 0.0
        for lo, hi, rows, at, size in parts:
            z, some = np.full(hi - lo, w[-1]), size > 0
            if len(rows):
                z[some] += np.add.reduceat(scaled[rows], at[some])
            loss += (weight[lo:hi] * (np.logaddexp(0, z) - y[lo:hi] * z)).sum()
            g = weight[lo:hi] * (1 / (1 + np.exp(-z)) - y[lo:hi])
            slope += np.bincount(rows, weights=np.repeat(g, size), minlength=n)
            bias += g.sum()
        return loss + 0.5 * l2 * (w[:-1] @ w[:-1]), np.r_[slope * scale + l2 * w[:-1], bias]

    return minimize(f, np.zeros(n + 1))
