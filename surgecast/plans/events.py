"""F1 queries: event grid, per-event target, event filters and future events."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.operators import calendar as cal_ops
from surgecast.operators import traffic
from surgecast.plans.attribution import ATTR_CTES, ATTR_VIEWS
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.sources.tables import Tables

GRAIN = 3600  # driver events hold ~14 rows per hour: hour grain in tests

# SQL for the quantized calendar at an hour grain (PRJ4) and its grid (GEN1).
QCAL = {
    "calq": f"""SELECT *,
        epoch_ms(cast(floor((epoch(date_utc) + CASE WHEN second(date_utc) >= 30 THEN 60 ELSE 0 END) / {GRAIN}) * {GRAIN} + {GRAIN} AS bigint) * 1000) AS start_quantized,
        epoch_ms(cast(floor((epoch(end_with_avg_duration) + CASE WHEN second(end_with_avg_duration) >= 30 THEN 60 ELSE 0 END) / {GRAIN}) * {GRAIN} + {GRAIN} AS bigint) * 1000) AS end_quantized
        FROM calendar""",
    "grid": f"""SELECT sport, id, epoch_ms(x * 1000) AS event_time FROM (
        SELECT sport, id, unnest(generate_series(cast(epoch(start_quantized) AS bigint) - {GRAIN},
                cast(epoch(end_quantized) AS bigint) + {2 * GRAIN}, {GRAIN})) AS x FROM calq) g""",
}


def _attributed(t: Tables):
    return traffic.event_traffic_attribution(traffic.aggregate_watch_traffic(t.watch_traffic), t.service_traffic, t.baseline)


@query(
    "event_target_max",
    ops=("PRJ4", "GEN1", "JON4", "AGG3", "JON5"),
    sql=ctes(*ATTR_VIEWS, "calendar", extra={**ATTR_CTES, **QCAL, "pe_max": """
        SELECT a.sport, a.event_id AS id, max(a.s2) AS tgt, max(a.service_count) AS svc
        FROM attributed a JOIN grid g ON a.sport = g.sport AND a.event_id = g.id AND a.event_time = g.event_time
        GROUP BY a.sport, a.event_id"""})
    + """SELECT c.sport, c.id, c.name, c.date_utc, c.start_quantized, c.end_quantized,
            round(p.tgt, 6) AS event_count_on_service_extra_traffic_scale, round(p.svc, 6) AS service_count
         FROM pe_max p JOIN calq c ON c.sport = p.sport AND c.id = p.id""",
)
def event_target_max(spark, sf_dir):
    """Per-event maximum of extra traffic over the event's quantized grid."""
    t = Tables(spark, sf_dir)
    calq = cal_ops.quantize_calendar(t.calendar, grain_seconds=GRAIN)
    out = cal_ops.event_targets(_attributed(t), calq)
    return finish(out.select("sport", "id", "name", "date_utc", "start_quantized", "end_quantized",
                             "event_count_on_service_extra_traffic_scale", "service_count"))


@query(
    "event_grid_size",
    ops=("PRJ4", "GEN1", "AGG10"),
    sql=ctes("calendar", extra={**QCAL}) + """
        SELECT g.sport, g.id, count(*) AS n_points, min(g.event_time) AS first_point, max(g.event_time) AS last_point
        FROM grid g GROUP BY g.sport, g.id""",
)
def event_grid_size(spark, sf_dir):
    """Size and span of each event's grid (checks the filler bounds)."""
    t = Tables(spark, sf_dir)
    calq = cal_ops.quantize_calendar(t.calendar, grain_seconds=GRAIN)
    g = calq.select("sport", "id", F.explode("filler").alias("event_time"))
    out = g.groupBy("sport", "id").agg(
        F.count(F.lit(1)).alias("n_points"), F.min("event_time").alias("first_point"), F.max("event_time").alias("last_point")
    )
    return finish(out)


EXCLUDED_PERIODS = [("2024-01-05 00:00:00", "2024-01-07 12:00:00"), ("2024-01-20", "2024-01-10"), ("2024-01-25",)]
EXCLUDED_TEAMS = ["NATION_3", "NATION_7"]
EXCLUDED_NETWORKS = ["AF", "RF"]
CAL_COLS = "sport, id, name, date_utc, team_0_display_name, team_1_display_name"


@query(
    "event_filters",
    ops=("FIL1", "FIL4", "FIL7", "FIL6", "JON8", "WIN7", "FIL2"),
    sql=ctes("calendar", "airings", extra={
        "bad": """SELECT event_id FROM airings GROUP BY event_id
                  HAVING bool_and(coalesce(network_name IN ('AF', 'RF'), false))""",
        "mx": "SELECT max(date_utc) AS m FROM calendar"})
    + f"""SELECT {CAL_COLS} FROM calendar, mx
         WHERE date_utc >= m - INTERVAL 20 DAY
           AND sport IN ('click', 'view', 'purchase')
           AND NOT coalesce(date_utc BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-07 12:00:00', false)
           AND NOT (coalesce(team_0_display_name IN ('NATION_3', 'NATION_7'), false)
                    OR coalesce(team_1_display_name IN ('NATION_3', 'NATION_7'), false))
           AND id NOT IN (SELECT event_id FROM bad)""",
)
def event_filters(spark, sf_dir):
    """History depth, excluded periods (one malformed, ignored), teams and networks."""
    t = Tables(spark, sf_dir)
    c = cal_ops.history_depth(t.calendar, 20)
    c = cal_ops.keep_sports(c, ["click", "view", "purchase"])
    c = cal_ops.exclude_periods(c, EXCLUDED_PERIODS)
    c = cal_ops.exclude_teams(c, EXCLUDED_TEAMS)
    c = cal_ops.filter_by_network(c, t.airings, EXCLUDED_NETWORKS)
    return finish(c.selectExpr(*CAL_COLS.split(", ")))


@query(
    "future_and_history_events",
    ops=("FIL3", "PRJ32", "JON9", "PRJ11", "SET1", "FIL5"),
    sql=ctes("calendar", "airings", extra={
        "ids": """SELECT DISTINCT cast(cast(try_cast(game_id AS double) AS bigint) AS varchar) AS gid FROM airings
                  WHERE game_id IS NOT NULL AND lower(game_id) <> 'nan' AND NOT contains(game_id, '[')"""})
    + f"""SELECT {CAL_COLS}, -1.0E0 AS y, -1.0E0 AS service_count, 'future' AS data_type FROM calendar
          WHERE date_utc >= TIMESTAMP '2024-01-20' AND date_utc < TIMESTAMP '2024-01-20' + INTERVAL 5 DAY
            AND cast(id AS varchar) IN (SELECT gid FROM ids WHERE gid IS NOT NULL)
          UNION ALL
          SELECT {CAL_COLS}, NULL AS y, NULL AS service_count, 'history' AS data_type FROM calendar
          WHERE date_utc < TIMESTAMP '2024-01-20'
            AND (date_utc <= TIMESTAMP '2024-01-08' OR date_utc >= TIMESTAMP '2024-01-10')""",
)
def future_and_history_events(spark, sf_dir):
    """Future events in a 5-day horizon that have an airing, plus earlier rows outside a fixed gap."""
    t = Tables(spark, sf_dir)
    fut = cal_ops.events_with_airing(cal_ops.future_events(t.calendar, "2024-01-20", 5), t.airings)
    fut = fut.select(*CAL_COLS.split(", "), "y", "service_count", F.lit("future").alias("data_type"))
    hist = cal_ops.fixed_gap(t.calendar.where(F.col("date_utc") < F.lit("2024-01-20").cast("timestamp")),
                             gap=("2024-01-08", "2024-01-10"))
    hist = hist.select(*CAL_COLS.split(", "), F.lit(None).cast("double").alias("y"),
                       F.lit(None).cast("double").alias("service_count"), F.lit("history").alias("data_type"))
    return finish(fut.unionByName(hist))
