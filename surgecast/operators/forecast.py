"""F4 near-real-time forecast: cleaning, transform and the composed forecast
for many series at once (one Spark job, partitioned by series)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.functions.scalar import clip_lower
from surgecast.operators import decompose as dc
from surgecast.operators import series as ser
from surgecast.operators.stl import stl_decompose
from surgecast.session import materialize

Keys = Sequence[str]


@dataclass(frozen=True)
class ForecastConfig:
    """Grain and periods as parameters (the reference: 5 min, 288 / 2016, 2 h)."""

    step_seconds: int = 300
    day_points: int = 288
    week_points: int = 2016
    horizon_points: int = 24
    smooth_points: int = 12  # centred max window (one hour of points)
    polyfit_degree: int = 2
    weights_tau: float = -1.0
    span: int = 12
    outlier_sigmas: float = 4.0


def residual_outliers(grid: DataFrame, keys: Keys, value: str, period: int, sigmas: float = 4.0,
                      out: str | None = None, method: str = "stl") -> DataFrame:
    """TS3: residuals of the daily decomposition outside mean +/- ``sigmas``
    sample standard deviations are set to null in ``out``.

    ``method``: ``stl``, or ``classical`` (moving averages, all window functions).
    ``grid`` is a complete regular series (``_i, _n`` indexed)."""
    out = out or f"{value}_cleaned"
    if method == "stl":
        d = stl_decompose(grid, keys, "_i", value, period, prefix="_ol_")
    else:
        d, _ = dc.decompose(grid, keys, value, period, prefix="_ol_", indexed=True)
    w = Window.partitionBy(*keys)
    mu, sd = F.avg("_ol_resid").over(w), F.stddev_samp("_ol_resid").over(w)
    bad = (F.col("_ol_resid") < mu - sigmas * sd) | (F.col("_ol_resid") > mu + sigmas * sd)
    return d.withColumn(out, F.when(bad, F.lit(None)).otherwise(F.col(value))).drop(
        "_ol_trend", "_ol_seasonal", "_ol_resid")


def prepare_series(raw: DataFrame, keys: Keys, ts: str, value: str, cfg: ForecastConfig) -> DataFrame:
    """GEN2 + TS1 + TS3 + TS1 + PRJ28 + WIN2: regular, cleaned, interpolated,
    clipped at 1 and smoothed (centred max) series with ``_i, _n``."""
    kc = list(keys)
    g = ser.regular_grid(raw.select(*kc, F.col(ts).alias("ts"), F.col(value).alias("value")), kc, "ts", cfg.step_seconds)
    g = ser.interpolate_linear(g, kc, "ts", "value", out="_filled")
    g = dc.with_index(g.withColumn("_filled", F.coalesce("_filled", F.lit(0.0))), kc, "ts")
    g = residual_outliers(g, kc, "_filled", cfg.day_points, cfg.outlier_sigmas, out="cleaned")
    g = ser.interpolate_linear(g, kc, "ts", "cleaned", out="interp")
    g = g.withColumn("interp", clip_lower("interp", 1.0))
    return ser.centred_max(g, kc, "ts", "interp", cfg.smooth_points, out="smoothed_max").drop("_filled")


def nrt_forecast(raw: DataFrame, keys: Keys, ts: str, value: str, cfg: ForecastConfig, checkpoint: bool = True) -> DataFrame:
    """TS9: composed forecast ``keys, ts, forecast`` for the next ``horizon_points``.

    Box-Cox, daily decomposition, weekly decomposition of the daily trend,
    seasonal (phase) forecasts, trend forecast, flat residual forecasts, sum,
    inverse Box-Cox. ``bad_inverse`` flags points whose inverse is undefined.
    """
    kc = list(keys)
    prep = materialize(prepare_series(raw, kc, ts, value, cfg).select(*kc, "ts", "smoothed_max"), checkpoint)
    bc = dc.boxcox_transform(prep, kc, "smoothed_max", out="bc").where(F.col("bc").isNotNull())
    bc = materialize(dc.with_index(bc, kc, "ts"), checkpoint)
    day, day_phase = dc.decompose(bc, kc, "bc", cfg.day_points, prefix="d_", indexed=True)
    day = materialize(day, checkpoint)  # read by the weekly decomposition and the residual level
    week, week_phase = dc.decompose(day.select(*kc, "ts", "_i", "_n", "d_trend"), kc, "d_trend", cfg.week_points,
                                    prefix="w_", indexed=True)
    week = materialize(week, checkpoint)
    last = bc.where(F.col("_i") == F.col("_n") - 1).select(*kc, "_n", F.col("ts").alias("last_ts"), "lmbda")
    fut = dc.future_positions(last.drop("lmbda"), kc, cfg.horizon_points, cfg.step_seconds)
    fut = dc.seasonal_forecast(fut, day_phase, kc, cfg.day_points, "s1")
    fut = dc.seasonal_forecast(fut, week_phase, kc, cfg.week_points, "s7")
    tr = dc.trend_forecast(week, kc, "w_trend", cfg.horizon_points, cfg.step_seconds, degree=cfg.polyfit_degree,
                           tau=cfg.weights_tau)
    r1 = dc.ses_level(day, kc, "d_resid", cfg.span).withColumnRenamed("level", "r1")
    r2 = dc.ses_level(week, kc, "w_resid", cfg.span).withColumnRenamed("level", "r2")
    comp = (
        fut.join(tr.drop("ts"), [*kc, "_j"])
        .join(r1, kc)
        .join(r2, kc)
        .join(last.select(*kc, "lmbda"), kc)
    )
    total = F.col("s1") + F.col("s7") + F.col("trend_forecast") + F.col("r1") + F.col("r2")
    inv = dc.inv_boxcox_expr(total, F.col("lmbda"))
    return comp.select(
        *kc, "ts", total.alias("forecast_bc"), inv.alias("forecast"), (inv.isNull() & total.isNotNull()).alias("bad_inverse")
    )
