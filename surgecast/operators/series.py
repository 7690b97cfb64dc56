"""Regular time series in long form: ``series keys..., ts, value``.

Windows here are partitioned by the series key and run on a regular grid, so a
partition holds at most (time span / grain) rows whatever the input volume;
raw rows are aggregated to the grid first (partial aggregation absorbs hot
keys). Nothing uses a window without ``partitionBy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.operators.metrics import exact_quantiles

Keys = Sequence[str]


def _w(keys: Keys, ts: str):
    return Window.partitionBy(*keys).orderBy(ts) if keys else Window.partitionBy(F.lit(0)).orderBy(ts)


def regular_grid(df: DataFrame, keys: Keys, ts: str = "ts", step_seconds: int = 300, value: str = "value") -> DataFrame:
    """GEN2: one row per step between each series' first and last time; missing values null."""
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    grid = bounds.select(
        *keys,
        F.explode(
            F.sequence(F.unix_seconds(F.col("_lo").cast("timestamp")), F.unix_seconds(F.col("_hi").cast("timestamp")),
                       F.lit(step_seconds).cast("bigint"))
        ).alias("_s"),
    ).select(*keys, F.timestamp_seconds("_s").alias(ts))
    vals = df.select(*keys, F.col(ts).cast("timestamp").alias(ts), value)
    return grid.join(vals, [*keys, ts], "left")


def interpolate_linear(df: DataFrame, keys: Keys, ts: str = "ts", value: str = "value", out: str | None = None) -> DataFrame:
    """TS1: linear interpolation between neighbours in time; leading nulls stay
    null, trailing nulls repeat the last value (pandas ``interpolate()`` on a
    regular grid)."""
    out = out or value
    w = _w(keys, ts)
    # Both neighbours come from running frames (unbounded preceding .. current
    # row), which Spark evaluates incrementally; the next value uses the
    # reversed order instead of an O(n^2) "current .. unbounded following" frame.
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    rev = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(F.col(ts).desc())
    after = rev.rowsBetween(Window.unboundedPreceding, 0)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    has = F.col(value).isNotNull()
    pv = F.last(F.col(value), ignorenulls=True).over(before)
    pt = F.last(F.when(has, t), ignorenulls=True).over(before)
    nv = F.last(F.col(value), ignorenulls=True).over(after)
    nt = F.last(F.when(has, t), ignorenulls=True).over(after)
    frac = F.try_divide((t - pt).cast("double"), (nt - pt).cast("double"))
    filled = (
        F.when(has, F.col(value))
        .when(pv.isNull(), F.lit(None))
        .when(nv.isNull(), pv)
        .otherwise(pv + (nv - pv) * frac)
    )
    return df.withColumn(out, filled)


def centred_max(df: DataFrame, keys: Keys, ts: str, value: str, window_rows: int = 12, out: str = "rolling_max") -> DataFrame:
    """WIN2: centred rolling max over ``window_rows`` rows, min one row
    (pandas ``rolling(w, center=True, min_periods=1)``: rows [i - w/2, i + w/2 - 1])."""
    half = window_rows // 2
    frame = _w(keys, ts).rowsBetween(-half, window_rows - half - 1)
    return df.withColumn(out, F.max(value).over(frame))


def with_lags(df: DataFrame, keys: Keys, ts: str, cols: Sequence[str], n_lags: int = 10, drop_null: bool = True) -> DataFrame:
    """WIN3: ``<col>_lag_<l>`` for l in 1..n over one window per series; rows
    with a missing lag dropped when ``drop_null``."""
    w = _w(keys, ts)
    lagged = {f"{c}_lag_{l}": F.lag(c, l).over(w) for c in cols for l in range(1, n_lags + 1)}
    out = df.withColumns(lagged)
    return out.dropna(subset=list(lagged)) if drop_null else out


def with_distribution_features(df: DataFrame, keys: Keys, cols: Sequence[str], q: float = 0.999) -> DataFrame:
    """PRJ25 + AGG9: ``<c>_diff_from_median``, ``<c>_more_quant_999`` (strictly
    above the exact ``q`` quantile, linear interpolation) and ``<c>_log``.

    Median and quantile are exact per-series statistics of all columns in one
    distributed pass, joined back to the rows (one row per series; AQE picks
    broadcast or sort-merge from its measured size).
    """
    points = F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in cols])).alias("_p")
    long = df.select(*keys, points).select(*keys, "_p.*")
    found = exact_quantiles(long, [*keys, "_col"], F.col("_x"), [0.5, q], out="_q")
    stats = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_col", "_q"))).alias("_s"))  # one entry a column
    if keys:
        joined, s = df.join(stats, list(keys), "left"), F.col("_s")
    else:
        joined, s = df, stats.scalar()  # one scalar subquery, read once
    med = {c: F.try_element_at(s, F.lit(c))[0] for c in cols}
    qq = {c: F.try_element_at(s, F.lit(c))[1] for c in cols}
    new = {}
    for c in cols:
        new[f"{c}_diff_from_median"] = F.col(c) - med[c]
        new[f"{c}_more_quant_999"] = (F.col(c) > qq[c]).cast("int")
        new[f"{c}_log"] = F.log1p(c)
    out = joined.withColumns(new)
    return out.drop("_s") if keys else out


def align_metrics(
    frames: dict[str, DataFrame], ts: str = "datetime", value: str = "count", *, lower_from: str | None = None,
    upper_from: str | None = None,
) -> DataFrame:
    """JON10 + FIL15: N metric series side by side at equal times.

    One long union and one ``groupBy(ts).pivot`` (a single shuffle) instead of
    N-1 joins; rows with any missing metric dropped; optionally limited to
    ``[min ts of lower_from, max ts of upper_from]``.
    """
    names = list(frames)
    long = None
    for n, f in frames.items():
        part = f.select(F.col(ts).alias(ts), F.lit(n).alias("_metric"), F.col(value).cast("double").alias("_v"))
        long = part if long is None else long.unionByName(part)
    wide = long.groupBy(ts).pivot("_metric", names).agg(F.first("_v")).dropna(subset=names)
    if lower_from:
        wide = wide.where(F.col(ts) >= frames[lower_from].agg(F.min(ts)).scalar())
    if upper_from:
        wide = wide.where(F.col(ts) <= frames[upper_from].agg(F.max(ts)).scalar())
    return wide


def group_max_rows(df: DataFrame, keys: Keys, value: str, ts: str, out: str = "group_max", out_ts: str = "time_of_max") -> DataFrame:
    """WIN6: group maximum on every row, and the (last) time it is reached."""
    w = Window.partitionBy(*keys)
    return df.withColumns(
        {out: F.max(value).over(w), out_ts: F.max_by(F.col(ts), F.struct(F.col(value), F.col(ts))).over(w)}
    )


def first_last_valid(df: DataFrame, keys: Keys, ts: str, value: str) -> DataFrame:
    """WIN9: first and last non-null value per series."""
    ok = df.where(F.col(value).isNotNull())
    return ok.groupBy(*keys).agg(F.min_by(value, ts).alias("first_value"), F.max_by(value, ts).alias("last_value"))


def slice_days(df: DataFrame, ts: str, day, back_days: int, *, whole_day: bool = True) -> DataFrame:
    """FIL14: ``[day - back_days, end of day]``; a date-only end covers the whole day."""
    d = F.lit(day).cast("timestamp")
    lo = d - F.make_dt_interval(days=F.lit(back_days))
    hi = d + F.make_dt_interval(days=F.lit(1)) if whole_day else d
    c = F.col(ts)
    return df.where((c >= lo) & ((c < hi) if whole_day else (c <= hi)))
