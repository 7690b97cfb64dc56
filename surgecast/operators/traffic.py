"""F1 traffic attribution: how much service traffic each event causes.

Pipeline (reference semantics): per-event watch counts -> share of each event
in all watch traffic at the same time -> joined with service traffic and its
baseline at the same minute -> influence, service-scale count and the extra
traffic over the baseline (the model target), smoothed over six points.

Scale notes. The co-event total is a per-time aggregate joined back to the
events. It has one row per time point, so its size is set by the time span,
not the data volume; AQE turns the join into a broadcast at run time when the
aggregate is small and otherwise uses a sort-merge join with skew splitting.
No window is partitioned by time, so a hot time slot never lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.functions.scalar import exact_sum, extra_on_service_scale, influence, on_service_scale
from surgecast.functions.timeparts import with_time_parts


def aggregate_watch_traffic(
    watch: DataFrame, *, keys: Sequence[str] = ("id", "sport", "league", "starttime"), count_col: str = "cnt"
) -> DataFrame:
    """AGG1: total watch count per (id, sport, league, start)."""
    return watch.groupBy(*keys).agg(F.sum(count_col).alias(count_col))


def coevent_traffic(
    watch: DataFrame,
    *,
    sports: Sequence[str] | None = None,
    id_col: str = "id",
    sport_col: str = "sport",
    ts_col: str = "starttime",
    count_col: str = "cnt",
    method: str = "aggregate",
) -> DataFrame:
    """JON1 + AGG2: each event's count next to the total of all events at that time.

    Returns ``sport, event_id, starttime, event_count, coevent_count`` for the
    events of ``sports`` (all sports when None). The total includes every
    sport, as in the reference's self-join on time. ``method="aggregate"``
    (default) joins a per-time aggregate back; ``method="window"`` sums over a
    window partitioned by time (one task per time slot: only for inputs
    without hot time slots). The self-join form is not offered: it forms
    every pair of events in a time slot.
    """
    per_event = watch.groupBy(sport_col, id_col, ts_col).agg(F.sum(count_col).alias("event_count"))
    if method == "window":
        with_total = per_event.withColumn("coevent_count", F.sum("event_count").over(Window.partitionBy(ts_col)))
        events = with_total if sports is None else with_total.where(F.col(sport_col).isin(list(sports)))
        return events.select(
            F.col(sport_col).alias("sport"), F.col(id_col).alias("event_id"), F.col(ts_col).alias("starttime"),
            "event_count", "coevent_count")
    totals = watch.groupBy(ts_col).agg(F.sum(count_col).alias("coevent_count"))
    events = per_event if sports is None else per_event.where(F.col(sport_col).isin(list(sports)))
    return events.join(totals, ts_col).select(
        F.col(sport_col).alias("sport"),
        F.col(id_col).alias("event_id"),
        F.col(ts_col).alias("starttime"),
        "event_count",
        "coevent_count",
    )


def service_vs_baseline(
    service: DataFrame,
    baseline: DataFrame,
    *,
    service_ts: str = "datetime",
    service_col: str = "service_count",
    baseline_ts: str = "ds",
    baseline_col: str = "baseline_count",
) -> DataFrame:
    """JON2: service traffic and its baseline at the same minute."""
    s = service.select(F.date_trunc("minute", service_ts).alias("minute_ts"), F.col(service_col).alias("service_count"))
    b = baseline.select(
        F.date_trunc("minute", baseline_ts).alias("minute_ts"), F.col(baseline_col).alias("baseline_count")
    )
    return s.join(b, "minute_ts")


def attribute_traffic(
    coevents: DataFrame,
    service_baseline: DataFrame,
    *,
    smoothing_rows: int = 6,
) -> DataFrame:
    """JON3 + PRJ1 + PRJ5-7 + WIN1: event traffic on the service scale.

    The trailing mean runs within each event (the reference's frame runs on
    across consecutive events; a global frame would put every row in one task).
    """
    joined = coevents.withColumn("minute_ts", F.date_trunc("minute", "starttime")).join(
        service_baseline, "minute_ts"
    )
    infl = influence("event_count", "coevent_count")
    out = with_time_parts(joined, "starttime").withColumnRenamed("starttime", "event_time")
    out = out.withColumn("event_influence", infl)
    out = out.withColumns(
        {
            "event_count_on_service_scale": on_service_scale("service_count", "event_influence"),
            "event_count_on_service_extra_traffic_scale": extra_on_service_scale(
                "service_count", "baseline_count", "event_influence"
            ),
        }
    )
    w = Window.partitionBy("sport", "event_id").orderBy("event_time")
    frame = w.rowsBetween(-(smoothing_rows - 1), 0)
    target = F.col("event_count_on_service_extra_traffic_scale")
    out = out.withColumn(
        "event_count_on_service_extra_traffic_scale_smoothing_avg",
        F.when(F.count(target).over(frame) == smoothing_rows, exact_sum(target, frame) / smoothing_rows),
    )
    return out.drop("minute_ts")


def event_traffic_attribution(
    watch: DataFrame,
    service: DataFrame,
    baseline: DataFrame,
    *,
    sports: Sequence[str] | None = None,
    smoothing_rows: int = 6,
) -> DataFrame:
    """Slice 0: the whole attribution flow for the given sports (all when None)."""
    co = coevent_traffic(watch, sports=sports)
    return attribute_traffic(co, service_vs_baseline(service, baseline), smoothing_rows=smoothing_rows)
