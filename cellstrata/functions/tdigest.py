"""Kernels of the k1 t-digest (Dunning and Ertl 2019) on numpy arrays: centroids are (mean, weight), sorted by mean.

The scale k1 maps a share q of the weight to delta * (asin(2 q - 1) / pi + 1/2).
A centroid may span one unit of it; one member may span more. Where each
possible centroid would have to end is looked up for all members at once, from
the inverse of the scale; the centroids are then the chain of these jumps.
"""

from __future__ import annotations

import math

import numpy as np

EMPTY = np.empty((0, 2), np.float32)


def k1(q: np.ndarray, delta: float) -> np.ndarray:
    return delta * (np.arcsin(np.clip(2 * q - 1, -1, 1)) / math.pi + 0.5)


def k1_inverse(k: np.ndarray, delta: float) -> np.ndarray:
    """The share at which the scale has the value k; 1 for values past its end."""
    return (1 + np.sin(math.pi * (np.minimum(k / delta, 1.0) - 0.5))) / 2


def cuts(weights: np.ndarray, delta: float) -> np.ndarray:
    """First member of each centroid."""
    filled = np.cumsum(weights)
    before = np.append(0.0, filled[:-1])
    room = filled[-1] * k1_inverse(k1(before / filled[-1], delta) + 1, delta)
    room *= 1 + 1e-12  # sums and sines round; a member that ends where the room does is in
    jump = np.maximum(np.searchsorted(filled, room, side="right"), np.arange(len(weights)) + 1).tolist()
    chain, at = [], 0
    while at < len(jump):
        chain.append(at)
        at = jump[at]
    return np.array(chain, np.int64)


def compress(members: np.ndarray, delta: float) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of members (mean, weight) in order, weights above 0, and the first member of each centroid."""
    if not len(members):
        return EMPTY, np.empty(0, np.int64)
    first = cuts(members[:, 1], delta)
    sums = np.add.reduceat(np.stack([members[:, 0] * members[:, 1], members[:, 1]], axis=1), first)
    return np.stack([sums[:, 0] / sums[:, 1], sums[:, 1]], axis=1).astype(np.float32), first


def members(values, weights=None, ties=()) -> tuple[np.ndarray, np.ndarray]:
    """The finite values with positive finite weights, in order of value, weight and ties (further columns), and where they stood."""
    values = np.asarray(values, np.float64)
    weights = np.ones(len(values)) if weights is None else np.asarray(weights, np.float64)
    with np.errstate(invalid="ignore"):
        good = np.flatnonzero(np.isfinite(values) & np.isfinite(weights) & (weights > 0))
    good = good[np.lexsort((*[t[good] for t in reversed(ties)], weights[good], values[good]))]
    return np.stack([values[good], weights[good]], axis=1), good


def build(values, weights=None, delta: float = 512) -> np.ndarray:
    """Digest of the finite values; without loss for up to delta of them of equal weight."""
    return compress(members(values, weights)[0], delta)[0]


def _pairs(digest) -> np.ndarray:
    return np.asarray(digest, np.float64).reshape(-1, 2)


def merge_sorted(every: np.ndarray, delta: float = 512) -> np.ndarray:
    """The digest of the centroids of several, put in order of mean and weight."""
    every = _pairs(every)
    return compress(every[np.lexsort((every[:, 1], every[:, 0]))], delta)[0]


def merge(digests: list[np.ndarray], delta: float = 512) -> np.ndarray:
    """One digest of many at once, whatever their order; a single one stays as it is."""
    full = [_pairs(d) for d in digests if len(d)]
    if len(full) < 2:
        return full[0].astype(np.float32) if full else EMPTY
    return merge_sorted(np.concatenate(full), delta)


def merge_pair(a, b, delta: float = 512) -> np.ndarray:
    """One digest of two, equal means in the order given; an empty side leaves the other as it is."""
    a, b = _pairs(a), _pairs(b)
    if not len(a) or not len(b):
        return (b if len(b) else a).astype(np.float32)
    both = np.concatenate([a, b])
    return compress(both[np.argsort(both[:, 0], kind="stable")], delta)[0]


def quantiles(digest, qs) -> np.ndarray:
    """Values at ranks q * (W - 1): a centroid takes the ranks from the weight before it to one less than that after it, and runs from midpoint to midpoint of the means."""
    d, qs = _pairs(digest), np.asarray(qs, np.float64)
    if not len(d):
        return np.full(qs.shape, math.nan)
    means, last = d[:, 0], np.cumsum(d[:, 1]) - 1
    first = last + 1 - d[:, 1]
    first[1:] = last[:-1] + 1
    middle = (means[1:] + means[:-1]) / 2
    ranks = qs * last[-1]
    own = np.minimum(np.searchsorted(last, ranks), len(d) - 1)
    span = last[own] - first[own]
    share = np.divide(ranks - first[own], span, out=np.zeros(qs.shape), where=span > 0)
    low, high = np.append(means[:1], middle)[own], np.append(middle, means[-1:])[own]
    inside = low + share * (high - low)
    return np.where(ranks > last[-1], means[-1], np.where(span > 0, inside, means[own]))


def quantile(digest, q: float) -> float:
    return float(quantiles(digest, [q])[0])


def cdf(digest, x) -> np.ndarray:
    """Weight at or below x: linear between centroid centres, a step for one centroid; NaN for an empty digest."""
    d, x = _pairs(digest), np.asarray(x, np.float64)
    if not len(d):
        return np.full(x.shape, math.nan)
    total = d[:, 1].sum()
    if len(d) == 1:
        return np.where(x >= d[0, 0], total, 0.0)
    return np.interp(x, d[:, 0], np.cumsum(d[:, 1]) - d[:, 1] / 2, left=0.0, right=total)


def rasterize(digest, edges) -> np.ndarray:
    """Weight in each bin between edges; nothing in any bin for an empty digest."""
    if not len(digest):
        return np.zeros(len(edges) - 1)
    return np.maximum(np.diff(cdf(digest, edges)), 0.0)
