"""Isotonic calibration from weighted score bins."""

from __future__ import annotations

import numpy as np


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (score, probability) of the best non-decreasing fit, by pooling adjacent violators.

    Probabilities lie half a pseudo-count inside 0 and 1, so that scores beyond the knots' ends still differ from them.
    """
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of weights, of weighted labels, of weighted scores
    for xi, yi, wi in zip(x[order], y[order], weight[order]):
        pools.append([wi, wi * yi, wi * xi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    w, wy, wx = np.array(pools).T if pools else np.zeros((3, 0))
    return wx / w, (wy + 0.5) / (w + 1)


def calibrated(score: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Between knots linear; beyond the first and the last one towards 0 and 1, never reaching them."""
    x, p = knots
    if not len(x):
        return np.full(len(score), 0.5)
    p = np.maximum.accumulate(p)
    out = np.interp(score, x, p)
    low, high = score < x[0], score > x[-1]
    out[low] = p[0] * np.exp(score[low] - x[0]) if low.any() else out[low]
    out[high] = 1 - (1 - p[-1]) * np.exp(x[-1] - score[high]) if high.any() else out[high]
    return out
