"""F4 forecasting operators on regular series (long form: keys, ts, value).

Everything is windows, grouped aggregates and joins over the regular grid,
and per-series tables (one row per series) are joined without a broadcast
hint: their size grows with the number of series, so AQE decides from the
measured size at run time (broadcast when small, sort-merge otherwise).
A series costs (span / grain) rows in one window partition at most; the
only Python is a per-series solve of tiny normal equations (one aggregated
row per series) in ``applyInPandas``.

Semantics follow the reference's library calls:
* Box-Cox with maximum-likelihood lambda (TS4): llf(l) = (l-1) sum ln x - n/2 ln var(x_l).
  Lambda is found by a coarse grid over [-2, 2], a fine grid around the best and, for
  the forecast, a golden-section search between its neighbours.
* Additive decomposition with period P (TS5): centred moving average trend
  (weights 1/2P at both ends for even P), ends extrapolated by least squares
  on the nearest P trend points, seasonal = centred phase means of the
  detrended series, residual = rest.
* Seasonal forecast (TS6): the seasonal component is exactly periodic, so an
  autoregression with P lags reproduces value[t - P]: the phase table.
* Trend forecast (TS7): polynomial of the index, then a degree-2 weighted
  polynomial of that curve with Gaussian weights exp(-d^2 / 2 tau^2).
* Residual forecast (TS8): simple exponential smoothing, alpha = 2/(span+1),
  initial level = first value; the forecast is flat.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.functions.scalar import exact_sum
from surgecast.session import materialize

Keys = Sequence[str]


def _win(keys: Keys, order: str = "_i"):
    return Window.partitionBy(*keys).orderBy(order)


def with_index(df: DataFrame, keys: Keys, ts: str = "ts") -> DataFrame:
    """0-based position ``_i`` and length ``_n`` of every series."""
    return df.withColumns(
        {"_i": F.row_number().over(Window.partitionBy(*keys).orderBy(ts)) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    )


# ---------------------------------------------------------------- TS4 --------

def boxcox_expr(x: Column, lam: Column) -> Column:
    return F.when(lam == 0, F.log(x)).otherwise((F.pow(x, lam) - 1) / lam)


def inv_boxcox_expr(y: Column, lam: Column) -> Column:
    """Inverse Box-Cox; null where the base is not positive (the reference gets NaN)."""
    base = lam * y + 1
    return F.when(lam == 0, F.exp(y)).when(base > 0, F.pow(base, 1 / lam))


def _likelihood(x: np.ndarray, lam: float) -> float:
    """Log-likelihood of a series of positive values under ``lam``; -inf where the transform is constant."""
    logs = np.log(x)
    y = logs if lam == 0 else (x**lam - 1) / lam
    var = y.var()
    return (lam - 1) * logs.sum() - len(x) / 2 * math.log(var) if var > 0 else -math.inf


def best_lambda(x: np.ndarray, coarse: float, fine: float, refine: bool) -> tuple[float, float]:
    """(lambda, likelihood): the best of a grid over [-2, 2], then of a finer one
    around it; with ``refine`` the maximum between its neighbours by golden
    section. Of equals the smallest lambda counts."""
    found = 0.0, 0.0
    steps, near = int(round(4 / coarse)), int(round(coarse / fine))
    grid = [round(k * coarse - 2, 6) for k in range(steps + 1)]
    for _ in range(2):
        found = max(((_likelihood(x, v), -v) for v in grid))
        grid = [round(-found[1] + k * fine, 9) for k in range(-near, near + 1)]
    lam, top = -found[1], found[0]
    if refine and math.isfinite(top):
        share = (math.sqrt(5) - 1) / 2
        lo, hi = lam - fine, lam + fine
        c, d = hi - share * (hi - lo), lo + share * (hi - lo)
        fc, fd = _likelihood(x, c), _likelihood(x, d)
        while hi - lo > 1e-7:
            if fc >= fd:
                hi, d, fd = d, c, fc
                c = hi - share * (hi - lo)
                fc = _likelihood(x, c)
            else:
                lo, c, fc = c, d, fd
                d = lo + share * (hi - lo)
                fd = _likelihood(x, d)
        top, lam = max((top, lam), (_likelihood(x, (lo + hi) / 2), (lo + hi) / 2))
    return lam, top


def boxcox_lambda(df: DataFrame, keys: Keys, value: str = "value", coarse: float = 0.05, fine: float = 0.001, refine: bool = False) -> DataFrame:
    """TS4 fit: per-series maximum-likelihood lambda (``lmbda``, ``llf``).

    Rows are shuffled once, whatever the number of candidates: a series, which
    has span / grain points, is one array, on which all candidates are tried.
    Values that aren't positive take no part; a series without others has no row."""
    kc = list(keys)
    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in kc), "lmbda double", "llf double"])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lam, top = best_lambda(np.sort(pdf["_x"].to_numpy(float)), coarse, fine, refine)
        return pd.DataFrame([(*key, lam, top if math.isfinite(top) else None)], columns=[*kc, "lmbda", "llf"])

    return df.select(*kc, F.col(value).cast("double").alias("_x")).where("_x > 0").groupBy(*kc).applyInPandas(run, schema)


def boxcox_transform(df: DataFrame, keys: Keys, value: str = "value", out: str = "box_cox") -> DataFrame:
    """TS4: Box-Cox transformed column with the per-series lambda (``lmbda``)."""
    lam = boxcox_lambda(df, keys, value, refine=True)
    j = df.join(lam.select(*keys, "lmbda"), list(keys))
    x = F.col(value).cast("double")
    return j.withColumn(out, F.when(x > 0, boxcox_expr(x, F.col("lmbda"))))


# ---------------------------------------------------------------- TS5 --------

def decompose(
    df: DataFrame, keys: Keys, value: str, period: int, *, prefix: str = "", indexed: bool = False, ts: str = "ts"
) -> tuple[DataFrame, DataFrame]:
    """TS5: additive decomposition. Returns (rows with ``trend, seasonal,
    resid``, phase table ``keys, phase, seasonal``). Rows must be complete
    (no nulls in ``value``) and each series needs two full periods."""
    d = df if indexed else with_index(df, keys, ts)
    w = _win(keys)
    h = period // 2
    v = F.col(value)
    if period % 2 == 0:
        s = exact_sum(v, w.rowsBetween(-h, h))
        raw = (s - 0.5 * F.lag(v, h).over(w) - 0.5 * F.lead(v, h).over(w)) / period
    else:
        raw = exact_sum(v, w.rowsBetween(-h, h)) / period
    inside = (F.col("_i") >= h) & (F.col("_i") <= F.col("_n") - 1 - h)
    d = d.withColumn("_tr", F.when(inside, raw))
    # least-squares lines through the first / last ``period`` trend points
    front, back = F.lit(h), F.col("_n") - 1 - h
    front_last = F.least(front + period, back)
    back_first = F.greatest(front, back - period)
    i = F.col("_i").cast("double")
    in_front = (F.col("_i") >= front) & (F.col("_i") < front_last)
    in_back = (F.col("_i") >= back_first) & (F.col("_i") < back)
    # line fits as window aggregates over the series: the rows are already
    # partitioned by series here, so this adds no shuffle and no join
    ws = Window.partitionBy(*keys)
    d = d.withColumns({
        "_k1": F.regr_slope(F.when(in_front, F.col("_tr")), F.when(in_front, i)).over(ws),
        "_c1": F.regr_intercept(F.when(in_front, F.col("_tr")), F.when(in_front, i)).over(ws),
        "_k2": F.regr_slope(F.when(in_back, F.col("_tr")), F.when(in_back, i)).over(ws),
        "_c2": F.regr_intercept(F.when(in_back, F.col("_tr")), F.when(in_back, i)).over(ws),
    })
    trend = (
        F.when(F.col("_i") < front, F.col("_k1") * i + F.col("_c1"))
        .when(F.col("_i") > back, F.col("_k2") * i + F.col("_c2"))
        .otherwise(F.col("_tr"))
    )
    d = d.withColumn(f"{prefix}trend", trend).withColumn("_phase", F.pmod(F.col("_i"), F.lit(period)))
    detr = v - F.col(f"{prefix}trend")
    phase = d.groupBy(*keys, "_phase").agg((exact_sum(detr) / F.count(detr)).alias("_pm"))
    phase = phase.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy(*keys))).drop("_pm")
    out = d.join(phase.withColumnRenamed("seasonal", f"{prefix}seasonal"), [*keys, "_phase"])
    out = out.withColumn(f"{prefix}resid", v - F.col(f"{prefix}trend") - F.col(f"{prefix}seasonal"))
    out = out.drop("_tr", "_k1", "_c1", "_k2", "_c2", "_phase")
    return out, phase.withColumnRenamed("_phase", "phase")


# ---------------------------------------------------------------- TS6 --------

def future_positions(last: DataFrame, keys: Keys, horizon: int, step_seconds: int, extra: int = 0) -> DataFrame:
    """Rows for positions n .. n + horizon - 1 (+ extra) after each series' last time.

    ``last`` holds ``keys, _n, last_ts``.
    """
    pos = F.explode(F.sequence(F.col("_n"), F.col("_n") + horizon - 1 + extra)).alias("_j")
    f = last.select(*keys, "_n", "last_ts", pos)
    ts = F.timestamp_seconds(F.unix_seconds(F.col("last_ts").cast("timestamp")) + (F.col("_j") - F.col("_n") + 1) * step_seconds)
    return f.withColumn("ts", ts)


def seasonal_forecast(future: DataFrame, phase: DataFrame, keys: Keys, period: int, out: str) -> DataFrame:
    """TS6: the periodic component continued: value at position j is the phase mean of j mod P."""
    f = future.withColumn("phase", F.pmod(F.col("_j"), F.lit(period)))
    return f.join(phase.withColumnRenamed("seasonal", out), [*keys, "phase"]).drop("phase")


# ---------------------------------------------------------------- TS7 --------

def _solve_groups(sums: DataFrame, keys: Keys, degree: int) -> DataFrame:
    """Solve the (degree+1) normal equations of every series (one row each)."""
    kcols = list(keys)
    schema = ", ".join([f"{k} {sums.schema[k].dataType.simpleString()}" for k in kcols] + [f"c{j} double" for j in range(degree + 1)])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            a = np.array([[r[f"s{p + q}"] for q in range(degree + 1)] for p in range(degree + 1)], dtype=float)
            b = np.array([r[f"t{p}"] for p in range(degree + 1)], dtype=float)
            coef = np.linalg.lstsq(a, b, rcond=None)[0]
            rows.append([r[k] for k in kcols] + list(coef))
        return pd.DataFrame(rows, columns=kcols + [f"c{j}" for j in range(degree + 1)])

    return sums.groupBy(*kcols).applyInPandas(solve, schema)


def weighted_polyfit(df: DataFrame, keys: Keys, x: Column, y: Column, degree: int, w: Column | None = None) -> DataFrame:
    """Least-squares polynomial per series on centred/scaled x; weights multiply
    residuals (numpy convention, so w^2 enters the normal equations).

    Returns ``keys, _xc, _xs, c0..c<degree>`` (coefficients of the scaled x).
    """
    base = df.select(*keys, x.alias("_x"), y.alias("_y"), (w if w is not None else F.lit(1.0)).alias("_w"))
    scale = base.groupBy(*keys).agg(
        ((F.max("_x") + F.min("_x")) / 2).alias("_xc"),
        F.greatest((F.max("_x") - F.min("_x")) / 2, F.lit(1e-12)).alias("_xs"),
    )
    b = base.join(scale, list(keys))
    u = (F.col("_x") - F.col("_xc")) / F.col("_xs")
    w2 = F.col("_w") * F.col("_w")
    sums = b.groupBy(*keys).agg(
        *[F.sum(w2 * F.pow(u, p)).alias(f"s{p}") for p in range(2 * degree + 1)],
        *[F.sum(w2 * F.pow(u, p) * F.col("_y")).alias(f"t{p}") for p in range(degree + 1)],
    )
    coefs = _solve_groups(sums, keys, degree)
    return coefs.join(scale, list(keys))


def polyval(x: Column, degree: int) -> Column:
    """Evaluate a fit from :func:`weighted_polyfit` (columns ``_xc, _xs, c*`` present)."""
    u = (x - F.col("_xc")) / F.col("_xs")
    acc = F.col(f"c{degree}")
    for j in range(degree - 1, -1, -1):
        acc = acc * u + F.col(f"c{j}")
    return acc


def trend_forecast(
    trend_rows: DataFrame, keys: Keys, trend: str, horizon: int, step_seconds: int, *, degree: int = 2, tau: float = -1.0,
    second_degree: int = 2, materialized: bool = True,
) -> DataFrame:
    """TS7: ``keys, ts, trend_forecast`` for the next ``horizon`` points.

    ``trend_rows`` carries ``_i, _n, ts`` and the trend column.
    """
    kc = list(keys)
    fit1 = weighted_polyfit(trend_rows, kc, F.col("_i").cast("double"), F.col(trend), degree)
    fit1 = fit1.select(*kc, *[F.col(f"c{j}").alias(f"a{j}") for j in range(degree + 1)],
                       F.col("_xc").alias("_ac"), F.col("_xs").alias("_as"))

    def curve(x: Column) -> Column:
        u = (x - F.col("_ac")) / F.col("_as")
        acc = F.col(f"a{degree}")
        for j in range(degree - 1, -1, -1):
            acc = acc * u + F.col(f"a{j}")
        return acc

    rows = trend_rows.join(fit1, kc).withColumn("_curve", curve(F.col("_i").cast("double")))
    if materialized:
        rows = materialize(rows)
    last_curve = rows.where(F.col("_i") == F.col("_n") - 1).select(*kc, F.col("_curve").alias("_clast"), F.col("ts").alias("last_ts"), "_n")
    rows = rows.join(last_curve.drop("last_ts", "_n"), kc)
    weight = None if tau == -1 else F.exp(-F.pow(F.col("_clast") - F.col("_curve"), 2) / (2 * tau * tau))
    fit2 = weighted_polyfit(rows, kc, F.col("_curve"), F.col(trend), second_degree, weight)
    fut = future_positions(last_curve, kc, horizon, step_seconds).join(fit1, kc)
    fut = fut.withColumn("_curve", curve(F.col("_j").cast("double"))).join(fit2, kc)
    return fut.select(*kc, "ts", "_j", polyval(F.col("_curve"), second_degree).alias("trend_forecast"))


# ---------------------------------------------------------------- TS8 --------

def ses_level(rows: DataFrame, keys: Keys, value: str, span: int = 12) -> DataFrame:
    """TS8: final level of simple exponential smoothing with alpha = 2/(span+1)
    and initial level = first value, as one closed-form aggregate:
    sum_i alpha (1-alpha)^(n-1-i) y_i + (1-alpha)^n y_0. Rows carry ``_i, _n``."""
    a = 2.0 / (span + 1)
    y = F.col(value)
    term = F.lit(a) * F.pow(F.lit(1 - a), F.col("_n") - 1 - F.col("_i")) * y
    return rows.groupBy(*keys).agg(
        (F.sum(term) + F.pow(F.lit(1 - a), F.first("_n")) * F.min_by(y, F.col("_i"))).alias("level")
    )
