"""Time expressions: calendar parts, grain quantization, time fillers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_time_parts(df: DataFrame, ts: str = "starttime", drop_ts: bool = False) -> DataFrame:
    """PRJ1: year, month, day of month, hour and minute of ``ts``."""
    t = F.col(ts)
    out = df.withColumns(
        {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t), "minute": F.minute(t)}
    )
    return out.drop(ts) if drop_ts else out


def with_date_features(df: DataFrame, ts: str = "ds", add_day: bool = True, add_hour: bool = True) -> DataFrame:
    """PRJ2: weekday (Monday = 0) as ``day`` and hour of day as ``hour``."""
    cols = {}
    if add_day:
        cols["day"] = F.weekday(F.col(ts))
    if add_hour:
        cols["hour"] = F.hour(F.col(ts))
    return df.withColumns(cols)


def hour_class(ts: ColumnOrName) -> Column:
    """PRJ3: 17-21 h -> 1 (evening); 22-4 h -> 2 (night); else 0."""
    h = F.hour(_c(ts))
    return F.when(h.between(17, 21), 1).when((h >= 22) | (h < 5), 2).otherwise(0)


def to_utc_ts(ts: ColumnOrName) -> Column:
    """Timestamp (session zone, UTC) from a naive or zoned timestamp."""
    return _c(ts).cast("timestamp")


def quantize_next(ts: ColumnOrName, grain_seconds: int = 300) -> Column:
    """PRJ4: the strictly next grain mark, after rounding seconds >= 30 up a minute.

    10:05:10 -> 10:10, 10:04:30 -> 10:10, 10:58:10 -> 11:00. Sub-second parts
    are dropped. Null stays null.
    """
    t = to_utc_ts(ts)
    secs = F.unix_seconds(t) + F.when(F.second(t) >= 30, F.lit(60)).otherwise(F.lit(0))
    return F.timestamp_seconds(F.floor(secs / grain_seconds) * grain_seconds + grain_seconds)


def filler(start: ColumnOrName, end: ColumnOrName, step_seconds: int = 300, modulo_day: bool = False) -> Column:
    """GEN1: grid from start - 1 step to start + (end - start) + 2 steps.

    ``modulo_day=True`` reproduces the reference's use of the seconds part of
    the duration only (durations over a day wrap).
    """
    s, e = to_utc_ts(start), to_utc_ts(end)
    delta = F.unix_seconds(e) - F.unix_seconds(s)
    if modulo_day:
        delta = F.pmod(delta, F.lit(86400))
    lo = F.unix_seconds(s) - step_seconds
    hi = F.unix_seconds(s) + delta + 2 * step_seconds
    return F.transform(
        F.sequence(lo, hi, F.lit(step_seconds).cast("bigint")), lambda x: F.timestamp_seconds(x)
    )


def measurement_window(ts: ColumnOrName, lag_days: int = 7, span_days: int = 10) -> tuple[Column, Column]:
    """PRJ14: (start, end) with end = t - lag days and start = end - (lag + span) days."""
    t = to_utc_ts(ts)
    end = t - F.make_dt_interval(days=F.lit(lag_days))
    start = end - F.make_dt_interval(days=F.lit(lag_days + span_days))
    return start, end


def year_month(ts: ColumnOrName) -> Column:
    """PRJ22: ``yyyy-MM`` partition label."""
    return F.date_format(_c(ts), "yyyy-MM")


def iso_minute(ts: ColumnOrName) -> Column:
    """PRJ22: ``yyyy-MM-dd HH:mm`` text of a time."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm")
