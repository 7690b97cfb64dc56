"""Seasonal-trend decomposition by LOESS (TS3, the seasonal step of TS12).

The published procedure: an inner loop smooths each phase over the cycles, takes
its low-frequency part off, and smooths what is left to the trend; an outer loop
gives points with large residuals less weight. A series is one numpy array, all
phases of it are smoothed at once, and a local line through a window of fixed
length is a handful of running weighted sums, so no loop runs over the points.
Spark deals out the series; one has span / grain points whatever the raw volume.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# ---- fixed values (of the published procedure) -------------------------------
#: Weights are 1 below, and 0 above, these shares of a window's reach.
NEAR, FAR = 0.001, 0.999
#: A residual of so many median residuals has no weight.
ROBUST_REACH = 6.0
SEASONAL_SPAN = 7


def _tricube(distance: np.ndarray, reach: np.ndarray) -> np.ndarray:
    r = distance / reach
    w = (1 - np.minimum(r, 1.0) ** 3) ** 3
    return np.where(r <= NEAR, 1.0, np.where(r > FAR, 0.0, w))


def _line(w: np.ndarray, d: np.ndarray, y: np.ndarray, spread: float) -> np.ndarray:
    """Value at distance 0 of the weighted line through ``y`` at distances ``d``
    (first axis: the window); a level where the points are too close or weightless."""
    s0, s1, s2 = w.sum(0), (w * d).sum(0), (w * d * d).sum(0)
    t0, t1 = (w * y).sum(0), (w * d * y).sum(0)
    return _solve(s0, s1, s2, t0, t1, spread)


def _solve(s0, s1, s2, t0, t1, spread: float) -> np.ndarray:
    """Value at 0 of the line with the weighted sums of 1, d, d², y, dy; NaN without weight."""
    with np.errstate(divide="ignore", invalid="ignore"):
        mean, level = s1 / s0, t0 / s0
        var = s2 / s0 - mean * mean
        slope = (t1 / s0 - mean * level) / var
        return np.where(np.sqrt(np.maximum(var, 0.0)) > NEAR * spread, level - slope * mean, level)


def loess(y: np.ndarray, span: int, weights: np.ndarray | None = None, beyond: int = 0) -> np.ndarray:
    """Local lines through the ``span`` nearest points of each column of ``y``
    (points x columns, one apart), at every point and ``beyond`` further ones on
    either side. Where all weights of a window are 0 the value of the nearest
    point stands."""
    n, m = y.shape
    rw = np.ones_like(y) if weights is None else weights
    q = min(span, n)
    extra = (span - n) // 2 if span > n else 0  # a window wider than the series only flattens the weights
    spread = max(n - 1.0, 1.0)
    out = np.empty((n + 2 * beyond, m))
    half = (q - 1) // 2
    inner = range(half, n - (q - 1 - half))  # points whose window is centred
    if len(inner) and not extra:
        d = np.arange(q) - half
        k = _tricube(np.abs(d), float(max(half, q - 1 - half)) or 1.0)
        sums = [np.zeros((len(inner), m)) for _ in range(5)]
        wy = rw * y
        for j in range(q):
            if k[j]:
                a, b = rw[j : j + len(inner)], wy[j : j + len(inner)]
                for s, x in zip(sums, (k[j] * a, k[j] * d[j] * a, k[j] * d[j] ** 2 * a, k[j] * b, k[j] * d[j] * b)):
                    s += x
        out[beyond + half : beyond + half + len(inner)] = _solve(*sums, spread)
    edge = [x for x in range(-beyond, n + beyond) if extra or x not in inner]
    for x in edge:  # under a window's length of them
        left = min(max(x - half, 0), n - q)
        d = np.arange(left, left + q) - float(x)
        reach = max(abs(d[0]), abs(d[-1])) + extra
        w = _tricube(np.abs(d), np.float64(reach or 1.0))[:, None] * rw[left : left + q]
        out[x + beyond] = _line(w, d[:, None], y[left : left + q], spread)
    if weights is not None:
        bare = np.isnan(out)
        if bare.any():
            near = np.clip(np.arange(-beyond, n + beyond), 0, n - 1)
            out = np.where(bare, y[near], out)
    return out


def _average(x: np.ndarray, n: int) -> np.ndarray:
    """Running mean of ``n`` points."""
    total = np.cumsum(np.concatenate([[0.0], x]))
    return (total[n:] - total[:-n]) / n


def _phases(x: np.ndarray, weights: np.ndarray, period: int, span: int) -> np.ndarray:
    """Each phase smoothed over its cycles and carried one cycle on both sides."""
    n = len(x)
    cycles, rest = divmod(n, period)
    out = np.full((cycles + 3) * period, np.nan)
    for phases, k in ((slice(0, rest), cycles + 1), (slice(rest, period), cycles)):
        at = np.arange(k)[:, None] * period + np.arange(period)[phases]
        if at.size:
            smooth = loess(x[at], span, weights[at], beyond=1)
            out[np.arange(k + 2)[:, None] * period + np.arange(period)[phases]] = smooth
    return out[: n + 2 * period]


def _odd_above(x: float) -> int:
    n = int(np.ceil(x))
    return n if n % 2 else n + 1


def stl(y: np.ndarray, period: int, *, seasonal_span: int = SEASONAL_SPAN, robust: bool = False, periodic: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trend, seasonal, residual) of a series without gaps and of two periods at least.

    Spans of trend and low-pass smoothing follow from the period; ``robust``
    takes 2 inner and 15 outer rounds instead of 5 and none. ``periodic`` makes
    the seasonal part repeat exactly (its phases' means).
    """
    y = np.asarray(y, float)
    n = len(y)
    if period < 2 or n < 2 * period:
        raise ValueError(f"{n} points, fewer than two periods of {period}")
    if periodic:
        seasonal_span = 10 * n + 1
    trend_span = _odd_above(1.5 * period / (1 - 1.5 / seasonal_span))
    low_span = period + 1 if period % 2 == 0 else period + 2
    inner, outer = (2, 15) if robust else (5, 0)
    trend, seasonal, weights = np.zeros(n), np.zeros(n), np.ones(n)
    phase = np.arange(n) % period
    for turn in range(outer + 1):
        for _ in range(inner):
            cycle = _phases(y - trend, weights, period, seasonal_span)
            low = _average(_average(_average(cycle, period), period), 3)
            low = loess(low[:, None], low_span)[:, 0]
            seasonal = cycle[period : period + n] - low
            trend = loess((y - seasonal)[:, None], trend_span, weights[:, None])[:, 0]
        if turn < outer:
            left = np.abs(y - trend - seasonal)
            reach = ROBUST_REACH * np.median(left)
            if reach == 0:
                break
            r = left / reach
            weights = np.where(r <= NEAR, 1.0, np.where(r > FAR, 0.0, (1 - np.minimum(r, 1.0) ** 2) ** 2))
    if periodic:
        seasonal = (np.bincount(phase, seasonal, period) / np.bincount(phase, minlength=period))[phase]
    return trend, seasonal, y - trend - seasonal


def stl_decompose(df: DataFrame, keys: Sequence[str], ts: str, value: str, period: int, *, prefix: str = "", robust: bool = False, periodic: bool = False) -> DataFrame:
    """Columns ``trend``, ``seasonal``, ``resid`` (behind ``prefix``) of every series,
    in time order. A series that holds a null or is shorter than two periods is
    an error; other columns pass through."""
    names = [f"{prefix}{c}" for c in ("trend", "seasonal", "resid")]
    base = df.drop(*names)
    schema = ", ".join([*(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in base.columns), *(f"`{c}` double" for c in names)])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts, kind="mergesort")
        y = pdf[value].to_numpy(dtype=float)
        if np.isnan(y).any():
            raise ValueError(f"series {key} has a gap")
        return pdf.assign(**dict(zip(names, stl(y, period, robust=robust, periodic=periodic))))

    return base.groupBy(*keys).applyInPandas(run, schema)
