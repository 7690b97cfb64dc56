"""F1 queries: event traffic attribution (slice 0) and its parts."""

from __future__ import annotations


from surgecast.operators import traffic
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.sources.tables import Tables

ATTRIBUTION_COLS = [
    "sport", "event_id", "event_time", "event_count", "coevent_count", "year", "month", "day", "hour", "minute",
    "service_count", "baseline_count", "event_influence", "event_count_on_service_scale",
    "event_count_on_service_extra_traffic_scale", "event_count_on_service_extra_traffic_scale_smoothing_avg",
]

ATTR_CTES = {
    "pe": "SELECT sport, id AS event_id, starttime, sum(cnt) AS event_count FROM watch_traffic GROUP BY sport, id, starttime",
    "tot": "SELECT starttime, sum(cnt) AS coevent_count FROM watch_traffic GROUP BY starttime",
    "sb": """SELECT date_trunc('minute', s.datetime) AS minute_ts, s.service_count, b.baseline_count
             FROM service_traffic s JOIN baseline b ON date_trunc('minute', s.datetime) = date_trunc('minute', b.ds)""",
    "j": """SELECT pe.sport, pe.event_id, pe.starttime AS event_time, pe.event_count, tot.coevent_count,
                   sb.service_count, sb.baseline_count,
                   cast(pe.event_count AS double) / tot.coevent_count AS event_influence
            FROM pe JOIN tot ON pe.starttime = tot.starttime
            JOIN sb ON sb.minute_ts = date_trunc('minute', pe.starttime)""",
    "k": """SELECT *, service_count * event_influence AS s1,
                   greatest(service_count - baseline_count, 0.0) * event_influence AS s2 FROM j""",
    "attributed": """SELECT k.*, CASE WHEN count(s2) OVER w = 6 THEN cast(sum(cast(s2 AS decimal(30,10))) OVER w AS double) / 6 END AS s2_avg
            FROM k WINDOW w AS (PARTITION BY sport, event_id ORDER BY event_time ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
}
ATTR_VIEWS = ("watch_traffic", "service_traffic", "baseline")

ATTRIBUTION_SQL = ctes(*ATTR_VIEWS, extra=ATTR_CTES) + """
SELECT sport, event_id, event_time, cast(event_count AS bigint) AS event_count,
       cast(coevent_count AS bigint) AS coevent_count,
       cast(year(event_time) AS bigint) AS year, cast(month(event_time) AS bigint) AS month,
       cast(day(event_time) AS bigint) AS day, cast(hour(event_time) AS bigint) AS hour,
       cast(minute(event_time) AS bigint) AS minute,
       round(service_count, 6) AS service_count, round(baseline_count, 6) AS baseline_count,
       round(event_influence, 6) AS event_influence, round(s1, 6) AS event_count_on_service_scale,
       round(s2, 6) AS event_count_on_service_extra_traffic_scale,
       round(s2_avg, 6) AS event_count_on_service_extra_traffic_scale_smoothing_avg
FROM attributed
"""


@query("attribution_extra_traffic", ops=("AGG1", "JON1", "AGG2", "JON2", "JON3", "PRJ1", "PRJ5", "PRJ6", "PRJ7", "WIN1", "SRT1"),
       sql=ATTRIBUTION_SQL)
def attribution_extra_traffic(spark, sf_dir):
    """Slice 0: extra service traffic attributable to each event, every sport."""
    t = Tables(spark, sf_dir)
    watch = traffic.aggregate_watch_traffic(t.watch_traffic)
    out = traffic.event_traffic_attribution(watch, t.service_traffic, t.baseline)
    return finish(out.select(*ATTRIBUTION_COLS))


COEVENT_SQL = ctes("watch_traffic", extra={k: ATTR_CTES[k] for k in ("pe", "tot")}) + """
SELECT pe.sport, pe.event_id, pe.starttime, cast(pe.event_count AS bigint) AS event_count,
       cast(tot.coevent_count AS bigint) AS coevent_count
FROM pe JOIN tot ON pe.starttime = tot.starttime"""


@query("coevent_window_form", ops=("JON1", "AGG2"), sql=COEVENT_SQL)
def coevent_window_form(spark, sf_dir):
    """Co-event totals as a window sum partitioned by time (the form SURVEY names for JON1)."""
    t = Tables(spark, sf_dir)
    return finish(traffic.coevent_traffic(traffic.aggregate_watch_traffic(t.watch_traffic), method="window"))


@query("coevent_aggregate_form", ops=("JON1", "AGG2"), sql=COEVENT_SQL)
def coevent_aggregate_form(spark, sf_dir):
    """Co-event totals as a per-time aggregate joined back (the default, skew-safe form)."""
    t = Tables(spark, sf_dir)
    return finish(traffic.coevent_traffic(traffic.aggregate_watch_traffic(t.watch_traffic)))
