"""Tables of a dish in a Pitman-Yor restaurant, drawn given all other dishes.

``n`` customers share ``t`` tables with a probability in proportion to
S(n, t) * prod over i < t of (strength + discount * i) * (word + i) / (root + i),
S: generalised Stirling numbers, which sum over all seatings of ``n`` customers
at ``t`` tables. A draw is therefore a Gibbs step that takes all customers of
the dish out and seats them again. Up to ``EXACT`` customers S comes from its
recursion. Above, S(n, t) is n! / (t! discount^t) times the chance that t
Sibuya variables sum to n, and this chance is an integral in the complex plane
through (near) its saddle point; its log is right to 1e-4 or better.
"""

from __future__ import annotations

import functools
import math

import numpy as np

EXACT = 1024
CELLS = 1 << 19  # numbers of tables weighed together
NODES = 32
_DROP = 35.0  # logs below the mode where a distribution is cut: e^-35
_lgamma = np.vectorize(math.lgamma, otypes=[float])


@functools.lru_cache(2)
def log_stirling(discount: float) -> np.ndarray:
    """log S(n, t) for n, t up to ``EXACT``."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    for n in range(EXACT):
        t = np.arange(1, n + 1)
        out[n + 1, 1:n + 1] = np.logaddexp(out[n, :n], np.log(n - discount * t) + out[n, 1:n + 1])
        out[n + 1, n + 1] = 0.0
    return out


def log_chance(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log of the chance that ``t`` Sibuya variables (generating function
    1 - (1 - s)^discount) sum to ``n``; with s = e^-p it is the integral of
    t d / n * e^(n p) q^(d - 1) e^-p (1 - q^d)^(t - 1) / (2 pi i), q = 1 - e^-p.
    Near the cut p <= 0 along a parabola around it, else along the vertical."""
    if len(n) > 4096:
        return np.concatenate([log_chance(n[a:a + 4096], t[a:a + 4096], discount) for a in range(0, len(n), 4096)])
    d, n, t = discount, n.astype(float), t.astype(float)
    lo, hi = np.log(1 / n), np.full(len(n), math.log(20.0))
    for _ in range(16):  # the saddle point: there the tilted sum has the mean n
        mid = (lo + hi) / 2
        q = -np.expm1(-np.exp(mid))
        above = t * d * q ** (d - 1) * (1 - q) > n * -np.expm1(d * np.log(q))
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    p = np.exp(lo)
    q = -np.expm1(-p)
    g = -np.expm1(d * np.log(q))
    g1, g2 = -d * q ** (d - 1) * (1 - q), d * (1 - d) * q ** (d - 2) * (1 - q) ** 2 + d * q ** (d - 1) * (1 - q)
    slope, bend = np.maximum(n + t * g1 / g, 0.0), t * (g2 / g - (g1 / g) ** 2)
    near = p < 0.5
    far = np.where(near, np.sqrt(80 / (4 * p * p * bend + 2 * p * slope)), np.minimum(np.sqrt(80 / np.maximum(bend, 1e-9)), math.pi))
    x = far[:, None] * np.arange(NODES + 1) / NODES
    z = np.where(near[:, None], p[:, None] * (1 + 1j * x) ** 2, p[:, None] + 1j * x)
    log_q = np.log(-np.expm1(-z))
    tops = n * p + (d - 1) * np.log(q) - p + (t - 1) * np.log(g)
    value = np.exp(n[:, None] * z + (d - 1) * log_q - z + (t - 1)[:, None] * np.log(-np.expm1(d * log_q)) - tops[:, None])
    value = (value * np.where(near[:, None], 2 * p[:, None] * (1 + 1j * x), 1.0)).real
    value[:, [0, -1]] /= 2
    return np.log(t * d / n) + tops + np.log(value.sum(axis=1) * far / NODES / math.pi)


def _draw_few(count, strength, word, root, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Every number of tables of every dish weighed, a cell each."""
    end = np.cumsum(count)
    start = end - count
    dish = np.repeat(np.arange(len(count)), count)
    i = np.arange(len(dish)) - start[dish]
    grown = np.cumsum(np.log((strength[dish] + discount * i) * (word[dish] + i) / (root[dish] + i)))
    weight = log_stirling(discount)[count[dish], i + 1] + grown - grown[start][dish]
    weight = np.exp(weight - np.maximum.reduceat(weight, start)[dish])
    upto = np.cumsum(weight)
    before = upto[start] - weight[start]
    pick = np.searchsorted(upto, before + rng.random(len(count)) * (upto[end - 1] - before), "right")
    return np.clip(pick, start, end - 1) - start + 1  # sums are rounded


def _draw_many(count, strength, word, root, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Brackets that hold all but e^-35 of the mode's weight, found by
    bisection, and the weights in them: all, or a polynomial of their logs."""

    def log_weight(t: np.ndarray, at=slice(None)) -> np.ndarray:
        n, a, w, r = count[at], strength[at] / discount, word[at], root[at]
        return log_chance(n, t, discount) - _lgamma(t + 1.0) + _lgamma(a + t) + _lgamma(w + t) - _lgamma(r + t)

    def first(true, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The smallest number from ``lo`` on that is true, or ``hi``."""
        while (lo < hi).any():
            mid = (lo + hi) // 2
            yes = true(mid) | (lo >= hi)
            lo, hi = np.where(yes, lo, mid + 1), np.where(yes, np.minimum(mid, hi), hi)
        return lo

    one = np.ones(len(count), np.int64)
    mode = first(lambda t: log_weight(np.minimum(t + 1, count)) <= log_weight(t), one, count)
    least = log_weight(mode) - _DROP
    lo = first(lambda t: log_weight(t) >= least, one, mode)
    hi = first(lambda t: log_weight(t) < least, mode, count)
    nodes = np.cos((np.arange(33) + 0.5) * math.pi / 33)
    signs = np.where(np.arange(33) % 2, -1, 1) * np.sin((np.arange(33) + 0.5) * math.pi / 33)
    # log weights between whole numbers: all their terms are smooth in t
    at = np.repeat(np.arange(len(count)), 33)
    level = log_weight(((lo + hi)[:, None] / 2 + (hi - lo)[:, None] / 2 * nodes).ravel(), at).reshape(-1, 33)
    out = np.empty(len(count), np.int64)
    for k, (a, b) in enumerate(zip(lo.tolist(), hi.tolist())):
        t = np.arange(a, b + 1)
        if len(t) <= 64:
            w = log_weight(t, np.full(len(t), k))
        else:
            away = (2 * t - a - b)[:, None] / (b - a) - nodes
            away[away == 0] = 1e-15
            w = (signs / away) @ level[k] / (signs / away).sum(axis=1)
        upto = np.cumsum(np.exp(w - w.max()))
        out[k] = a + min(np.searchsorted(upto, rng.random() * upto[-1], "right"), b - a)
    return out


def draw(count: np.ndarray, strength: np.ndarray, word: np.ndarray, root: np.ndarray, discount: float,
         rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables of dishes with ``count`` customers. ``strength``: with
    the discounts of the restaurant's other tables; ``word``, ``root``: customers
    of the word and of all words at the root without the dish, smoothed."""
    out = np.ones(len(count), np.int64)
    few, many = np.flatnonzero(count <= EXACT), np.flatnonzero(count > EXACT)
    parts = np.cumsum(count[few]) // CELLS
    for at in np.split(few, np.flatnonzero(np.diff(parts)) + 1) if len(few) else []:
        out[at] = _draw_few(count[at], strength[at], word[at], root[at], discount, rng)
    for a in range(0, len(many), 256):
        at = many[a:a + 256]
        out[at] = _draw_many(count[at], strength[at], word[at], root[at], discount, rng)
    return out
