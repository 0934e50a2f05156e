"""Likelihood of an editing fraction, its integral, and the two log Bayes factors.

Observations of a site enter as multiplicities by (class, base quality), at most
3 x 94 numbers whatever the depth, so cost and order of summation don't depend on reads.
Classes: 0 reference, 1 edited, 2 other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_X, _W = np.polynomial.legendre.leggauss(32)
NODES, WEIGHTS = (_X + 1) / 2, _W / 2
# Fixed value: the model was fitted with this weight at the 27th node.
WEIGHTS[26] = 0.02549902986561342
SMALL_DEPTH = 63
FLOOR = 1e-300


def _line(kind: np.ndarray, bq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a, b of the probability a + b p of each observation at editing fraction p."""
    e = np.power(10.0, -bq / 10.0)
    slope = 1 - 4 * e / 3
    a = np.where(kind == 0, 1 - e, e / 3)
    b = np.where(kind == 0, -slope, np.where(kind == 1, slope, 0.0))
    return a, b


def bayes_factors(kind: np.ndarray, bq: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Log Bayes factors of a uniform fraction against 0 (errors only) and against 1 (another allele)."""
    if not len(n):
        return 0.0, 0.0
    order = np.lexsort((bq, kind))
    a, b = _line(kind[order], bq[order].astype(float))
    n = n[order].astype(float)

    def ll(p):
        return np.log(np.maximum(a + b * np.asarray(p)[..., None], FLOOR)) @ n

    zero, one = float(ll(0.0)), float(ll(1.0))
    if n.sum() <= SMALL_DEPTH:
        values = ll(NODES) + np.log(WEIGHTS)
        total = float(np.log(np.exp(values).sum()))
        return total - zero, total - one

    def slope(p: float) -> float:
        return float((b / np.maximum(a + b * p, FLOOR)) @ n)

    at0, at1 = slope(0.0), slope(1.0)
    if at0 <= 0:
        mode = 0.0
    elif at1 >= 0:
        mode = 1.0
    else:
        low, high = 0.0, 1.0
        for _ in range(100):
            mid = (low + high) / 2
            low, high = (mid, high) if slope(mid) > 0 else (low, mid)
        mode = (low + high) / 2
    peak = float(ll(mode))
    if mode in (0.0, 1.0):
        scale = 1 / max(abs(at0), abs(at1), 1.0)
    else:
        scale = 1 / np.sqrt(max(float(((b / np.maximum(a + b * mode, FLOOR)) ** 2) @ n), 1.0))
    cuts = {0.0, 1.0}
    for k in (1.0, 4.0, 16.0, 64.0):
        cuts.update(p for p in (mode - k * scale, mode + k * scale) if 0 < p < 1)
    cuts = sorted(cuts)
    area = 0.0
    for low, high in zip(cuts, cuts[1:]):
        area += (high - low) * float(WEIGHTS @ np.exp(ll(low + (high - low) * NODES) - peak))
    found = peak + np.log(area)
    return float(found - zero), float(found - one)


def bayes_factors_col(counts: Column) -> Column:
    """counts: array<struct<kind int, bq int, n long>>."""

    def f(s: pd.Series) -> pd.DataFrame:
        out = []
        for rows in s:
            m = np.array([tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in rows], dtype=np.int64).reshape(-1, 3) if rows is not None else np.empty((0, 3), np.int64)
            out.append(bayes_factors(m[:, 0], m[:, 1], m[:, 2]))
        return pd.DataFrame(out, columns=["error", "homo"])

    return F.pandas_udf(f, "error double, homo double")(counts)
