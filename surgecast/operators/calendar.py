"""F1 calendar side: quantized event grid, per-event target, event filters.

The event grid (GEN1) is an explode of a per-event ``sequence``; joining the
exploded calendar to the attributed traffic on (sport, id, time) is the
bucketed form of the interval join "traffic time inside the event window"
(JON4). The calendar is small relative to traffic and the exploded rows per
event are bounded by the event duration over the grain.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.functions.timeparts import filler, quantize_next


def _ts(v) -> Column:
    return F.lit(v).cast("timestamp") if not isinstance(v, Column) else v


def quantize_calendar(
    cal: DataFrame,
    *,
    start: str = "date_utc",
    end: str = "end_with_avg_duration",
    grain_seconds: int = 300,
    modulo_day: bool = False,
) -> DataFrame:
    """PRJ4 + GEN1: quantized start/end and the grid of times the event covers."""
    return cal.withColumns(
        {
            "start_quantized": quantize_next(start, grain_seconds),
            "end_quantized": quantize_next(end, grain_seconds),
        }
    ).withColumn("filler", filler("start_quantized", "end_quantized", grain_seconds, modulo_day))


def event_targets(
    attributed: DataFrame,
    cal: DataFrame,
    *,
    target: str = "event_count_on_service_extra_traffic_scale",
    agg: str = "max",
    keys: Sequence[str] = ("sport",),
) -> DataFrame:
    """JON4 + AGG3 + JON5: per-event aggregate of target and service count
    over the event's grid, joined back to the calendar row.

    ``cal`` must carry ``filler`` (see :func:`quantize_calendar`).
    """
    fn = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum}[agg]
    grid = cal.select(*keys, "id", F.explode("filler").alias("event_time"))
    traffic = attributed.select(*keys, F.col("event_id").alias("id"), "event_time", target, "service_count")
    per_event = (
        traffic.join(grid, [*keys, "id", "event_time"])
        .groupBy(*keys, "id")
        .agg(fn(target).alias(target), fn("service_count").alias("service_count"))
    )
    return per_event.join(cal.drop("filler"), [*keys, "id"])


def within_horizon(df: DataFrame, prediction_date, days: float, ts: str = "date_utc") -> DataFrame:
    """FIL3: half-open ``[prediction_date, prediction_date + days)``."""
    p = _ts(prediction_date)
    return df.where((F.col(ts) >= p) & (F.col(ts) < p + F.make_dt_interval(secs=F.lit(days * 86400.0))))


def history_depth(df: DataFrame, days: int, ts: str = "date_utc") -> DataFrame:
    """FIL1: keep ``[max(ts) - days, max(ts)]``; a no-op when ``days <= 0``.

    The maximum is a scalar subquery, evaluated once.
    """
    if days <= 0:
        return df
    mx = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= mx - F.make_dt_interval(days=F.lit(days)))


def valid_periods(periods: Iterable[Sequence]) -> list[tuple]:
    """Periods with two ends and start <= end; malformed ones are ignored (FIL4)."""
    out = []
    for p in periods:
        if len(p) == 2 and p[0] <= p[1]:
            out.append((p[0], p[1]))
    return out


def exclude_periods(df: DataFrame, periods: Iterable[Sequence], ts: str = "date_utc") -> DataFrame:
    """FIL4/FIL5: drop rows inside any closed ``[a, b]`` period.

    Periods come from configuration (a handful); the predicate is a plain
    disjunction, so it reaches the scan as a pushed filter.
    """
    ps = valid_periods(periods)
    if not ps:
        return df
    inside = None
    for a, b in ps:
        cond = F.col(ts).between(_ts(a), _ts(b))
        inside = cond if inside is None else inside | cond
    return df.where(~F.coalesce(inside, F.lit(False)))


def keep_sports(df: DataFrame, sports: Sequence[str], col: str = "sport") -> DataFrame:
    """FIL2: sport membership."""
    return df.where(F.col(col).isin(list(sports)))


def exclude_teams(
    df: DataFrame, teams: Sequence[str], cols: Sequence[str] = ("team_0_display_name", "team_1_display_name")
) -> DataFrame:
    """FIL7: drop events where either team is excluded; null teams are kept."""
    hit = None
    for c in cols:
        h = F.coalesce(F.col(c).isin(list(teams)), F.lit(False))
        hit = h if hit is None else hit | h
    return df.where(~hit)


def filter_by_network(
    df: DataFrame, airings: DataFrame, excluded: Sequence[str], *, id_col: str = "id", event_col: str = "event_id"
) -> DataFrame:
    """FIL6 (+ JON8, WIN7): keep an event unless all of its airings are on excluded networks.

    An event with no airing, or with an airing on a null or non-excluded
    network, is kept once. Airings are reduced to one flag per event id before
    the join (pre-aggregation: a hot event id never fans out rows).
    """
    excl = list(excluded)
    all_excluded = (
        airings.groupBy(F.col(event_col).alias("_eid"))
        .agg(F.bool_and(F.coalesce(F.col("network_name").isin(excl), F.lit(False))).alias("_all_excl"))
        .where("_all_excl")
    )
    return df.join(all_excluded, F.col(id_col) == F.col("_eid"), "left_anti")


def repair_ids(df: DataFrame, col: str = "game_id") -> DataFrame:
    """PRJ11: id text from float text ("12.0" -> "12"); drop null, 'nan' and list-like ids."""
    c = F.col(col)
    fixed = c.try_cast("double").cast("bigint").cast("string")
    return (
        df.where(c.isNotNull() & (F.lower(c) != "nan") & ~c.contains("["))
        .withColumn(col, fixed)
        .where(F.col(col).isNotNull())
    )


def events_with_airing(df: DataFrame, airings: DataFrame, *, id_col: str = "id") -> DataFrame:
    """JON9: events that have at least one (repaired) airing id."""
    ids = repair_ids(airings.select("game_id")).select(F.col("game_id").alias("_gid")).distinct()
    return df.join(ids, F.col(id_col).cast("string") == F.col("_gid"), "left_semi")


def future_events(
    cal: DataFrame, prediction_date, days: float, *, ts: str = "date_utc", target: str = "y"
) -> DataFrame:
    """FIL3 + PRJ32: events in the horizon with sentinel target and service count -1."""
    return within_horizon(cal, prediction_date, days, ts).withColumns(
        {target: F.lit(-1.0), "service_count": F.lit(-1.0)}
    )


def fixed_gap(df: DataFrame, ts: str = "date_utc", gap: tuple = ("2020-03-13", "2021-01-01")) -> DataFrame:
    """FIL5: keep rows at or before ``gap[0]`` or at or after ``gap[1]``."""
    return df.where((F.col(ts) <= _ts(gap[0])) | (F.col(ts) >= _ts(gap[1])))


def guard(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """FIL16: the rows of ``df``; the job fails with ``message`` at the first row
    for which ``condition`` isn't true (a filter, which no projection can prune)."""
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
