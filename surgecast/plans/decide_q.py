"""F4 decision queries: intervals, adjustment, expansion, publishing, as-of scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.functions.timeparts import year_month
from surgecast.operators import decide as de
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.session import materialize
from surgecast.sinks.files import scratch_path, write_dated
from surgecast.sinks.tables import PublishedTable
from surgecast.sources import asof
from surgecast.sources.tables import Tables

PERIOD = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
SPORTS = {"click": "click", "view_": "view", "purchase": "purchase"}


def _intervals(t: Tables):
    tasks = t.scheduled_tasks.withColumnRenamed("datetime", "ds")
    return de.traffic_intervals(t.predictions_full, tasks, SPORTS, *PERIOD, min_gap_seconds=3600)


INTERVAL_CTES = {
    "tr": f"""SELECT * FROM predictions_full WHERE (click > 0 OR view_ > 0 OR purchase > 0)
              AND ds BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'""",
    "lg": """SELECT *, CASE WHEN epoch(ds) - epoch(lag(ds) OVER (ORDER BY ds)) > 3600 THEN 1 ELSE 0 END AS nw FROM tr""",
    "lb": """SELECT *, sum(nw) OVER (ORDER BY ds ROWS UNBOUNDED PRECEDING) AS interval FROM lg""",
    "m": f"""SELECT lb.*, t.n_tasks FROM lb JOIN scheduled_tasks t ON t.datetime = lb.ds
             WHERE t.datetime BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'""",
    "a": """SELECT interval, min(ds) AS start_ds, max(ds) AS end_ds, max(n_tasks) AS n_tasks,
                   arg_max(ds, (n_tasks, ds)) AS max_tasks_timestamp,
                   sum(click) AS click, sum(view_) AS view_, sum(purchase) AS purchase FROM m GROUP BY interval""",
    "sh": """SELECT interval, start_ds, end_ds, 'click' AS sport, click / (click + view_ + purchase) AS weight FROM a UNION ALL
             SELECT interval, start_ds, end_ds, 'view', view_ / (click + view_ + purchase) FROM a UNION ALL
             SELECT interval, start_ds, end_ds, 'purchase', purchase / (click + view_ + purchase) FROM a""",
    "iv": f"""SELECT * FROM a WHERE start_ds <> TIMESTAMP '{PERIOD[0]}' AND end_ds <> TIMESTAMP '{PERIOD[1]}'""",
    "ev": f"""SELECT CASE WHEN league = 'ufc' THEN 'ufc' ELSE sport END AS sport, date_utc AS start, end_with_avg_duration AS "end",
                     cast(id AS varchar) AS id FROM calendar
              WHERE date_utc <= TIMESTAMP '{PERIOD[1]}' AND end_with_avg_duration >= TIMESTAMP '{PERIOD[0]}'""",
}
INTERVALS_SQL = ctes("predictions_full", "scheduled_tasks", "calendar", extra=INTERVAL_CTES | {
    "se": """SELECT sh.interval, sh.sport, sh.weight, string_agg(ev.id, ',' ORDER BY ev.start, ev.id) AS ids
             FROM sh LEFT JOIN ev ON ev.sport = sh.sport AND ev.start <= sh.end_ds AND ev."end" >= sh.start_ds
             GROUP BY sh.interval, sh.sport, sh.weight"""}) + """
SELECT cast(iv.interval AS bigint) AS interval, iv.start_ds, iv.end_ds, cast(iv.n_tasks AS bigint) AS n_tasks, iv.max_tasks_timestamp,
       round(max(CASE WHEN se.sport = 'click' THEN se.weight END), 6) AS w_click,
       round(max(CASE WHEN se.sport = 'view' THEN se.weight END), 6) AS w_view,
       round(max(CASE WHEN se.sport = 'purchase' THEN se.weight END), 6) AS w_purchase,
       coalesce(max(CASE WHEN se.sport = 'click' THEN se.ids END), '') AS ev_click,
       coalesce(max(CASE WHEN se.sport = 'view' THEN se.ids END), '') AS ev_view,
       coalesce(max(CASE WHEN se.sport = 'purchase' THEN se.ids END), '') AS ev_purchase
FROM iv JOIN se ON se.interval = iv.interval
GROUP BY iv.interval, iv.start_ds, iv.end_ds, iv.n_tasks, iv.max_tasks_timestamp"""


@query("traffic_intervals", ops=("DEC3", "FIL9", "FIL20", "WIN5", "JON13", "AGG5", "AGG6", "JON11", "FIL11", "FIL10", "PRJ24"), sql=INTERVALS_SQL)
def traffic_intervals(spark, sf_dir):
    """Extra-traffic intervals with task peak, sport shares and overlapping events."""
    t = Tables(spark, sf_dir)
    iv = materialize(_intervals(t))  # an interval a row; read again for its events
    ids = de.event_ids(de.interval_events(iv, de.calendar_events(t.calendar, *PERIOD), list(SPORTS.values())))
    m, e = F.col("sport_weight_in_extra_traffic"), F.col("event_ids")
    cols = {f"w_{s}": m[s] for s in SPORTS.values()} | {f"ev_{s}": F.coalesce(F.try_element_at(e, F.lit(s)), F.lit("")) for s in SPORTS.values()}
    out = iv.join(ids, "interval", "left")
    return finish(out.select("interval", "start_ds", "end_ds", "n_tasks", "max_tasks_timestamp", *[v.alias(k) for k, v in cols.items()]))


@query("interval_events", ops=("AGG6", "JON11", "FIL10", "PRJ24", "DEC3"), sql=ctes("predictions_full", "scheduled_tasks", "calendar", extra=INTERVAL_CTES) + """
SELECT cast(iv.interval AS bigint) AS interval, ev.sport, ev.id,
       row_number() OVER (PARTITION BY iv.interval, ev.sport ORDER BY ev.start, ev.id) AS number
FROM iv JOIN ev ON ev.sport IN ('click', 'view', 'purchase') AND ev.start <= iv.end_ds AND ev."end" >= iv.start_ds""")
def interval_events(spark, sf_dir):
    """The calendar events behind each extra-traffic interval, numbered by sport."""
    t = Tables(spark, sf_dir)
    ev = de.calendar_events(t.calendar, *PERIOD)
    return finish(de.interval_events(_intervals(t), ev, list(SPORTS.values())).select("interval", "sport", "id", "number"))


@query("calendar_by_sport", ops=("AGG4", "PRJ24", "FIL10"), sql=ctes("calendar") + f"""
SELECT CASE WHEN league = 'ufc' THEN 'ufc' ELSE sport END AS sport, cast(id AS varchar) AS id, name, date_utc AS start,
       row_number() OVER (PARTITION BY CASE WHEN league = 'ufc' THEN 'ufc' ELSE sport END ORDER BY date_utc, cast(id AS varchar)) AS number
FROM calendar WHERE date_utc <= TIMESTAMP '{PERIOD[1]}' AND end_with_avg_duration >= TIMESTAMP '{PERIOD[0]}'""")
def calendar_by_sport(spark, sf_dir):
    """Events overlapping the period, numbered within their sport."""
    t = Tables(spark, sf_dir)
    g = de.events_by_sport(de.calendar_events(t.calendar, *PERIOD))
    return finish(g.select("sport", "id", "name", "start", "number"))


PT = "2024-01-20 17:00:00"
FACTOR = {"click": 1.6, "view": 0.5, "purchase": 1.5, "error": 1.0, "signup": 2.0}


def _recs(t: Tables):
    s = t.series.withColumn("n_tasks", F.ceil(F.col("value") / 10).cast("bigint"))
    win = s.where(F.hour("ts").between(18, 22))
    r = win.groupBy("series_id", F.to_date("ts").alias("d")).agg(
        F.max("n_tasks").alias("n_tasks"), F.max_by("ts", F.struct("n_tasks", "ts")).alias("max_tasks_timestamp"))
    r = r.select(
        "series_id", F.concat_ws("_", "series_id", F.date_format("d", "yyyy-MM-dd")).alias("interval_id"),
        F.unix_seconds(F.col("d").cast("timestamp")).alias("rec_order"),
        (F.col("d").cast("timestamp") + F.make_dt_interval(hours=F.lit(18))).alias("start_ds"),
        (F.col("d").cast("timestamp") + F.make_dt_interval(hours=F.lit(22))).alias("end_ds"),
        "n_tasks", "max_tasks_timestamp",
        F.lit(None).cast("timestamp").alias("original_start_ds"), F.lit(None).cast("timestamp").alias("original_end_ds"),
        F.lit(None).cast("bigint").alias("original_n_tasks"),
        F.create_map(F.lit("prediction_date"), F.date_format("d", "yyyy-MM-dd")).alias("metadata"),
    )
    adj = r.where(F.col("series_id").isin("purchase", "signup")).withColumns({
        "original_start_ds": F.col("start_ds"), "original_end_ds": F.col("end_ds"), "original_n_tasks": F.col("n_tasks"),
        "n_tasks": F.col("n_tasks") + 3,
        "metadata": F.when(F.col("series_id") == "signup", F.map_concat("metadata", F.create_map(
            F.lit("original_prediction_date"), F.lit("2024-01-01")))).otherwise(F.col("metadata")),
    })
    return r, adj


def _decision(t: Tables):
    s = t.series
    fac = F.create_map(*[F.lit(x) for kv in FACTOR.items() for x in kv])
    pt = F.lit(PT).cast("timestamp")
    fc = s.where((F.col("ts") > pt) & (F.col("ts") <= pt + F.make_dt_interval(hours=F.lit(24)))).select(
        "series_id", "ts", (F.col("value") * F.element_at(fac, F.col("series_id"))).alias("count"))
    pred = s.select("series_id", "ts", F.col("value").alias("count"))
    tasks = s.select("series_id", "ts", F.ceil(F.col("value") / 10).cast("bigint").alias("n_tasks"))
    orig, adj = _recs(t)
    return de.adjust_recommendations(fc, pred, tasks, orig.drop("d"), adj, PT, ["series_id"], service=F.col("series_id"), region=F.lit("eu"))


def _meta_text(m):
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


DEC_SQL = ctes("series", extra={
    "fac": " UNION ALL ".join(f"SELECT '{k}' AS series_id, {v} AS f" for k, v in FACTOR.items()),
    "fc": f"""SELECT s.series_id, s.ts, s.value * fac.f AS count FROM series s JOIN fac USING (series_id)
              WHERE s.ts > TIMESTAMP '{PT}' AND s.ts <= TIMESTAMP '{PT}' + INTERVAL 24 HOUR""",
    "cut": f"SELECT * FROM fc WHERE ts >= TIMESTAMP '{PT}' + INTERVAL 1800 SECOND",
    "fa": """SELECT series_id, min(ts) AS t0, max(ts) AS t1, max(count) AS fmax,
                    arg_min(count, ts) AS first_v, arg_max(count, ts) AS last_v FROM cut GROUP BY series_id""",
    "pm": """SELECT s.series_id, max(s.value) AS pmax FROM series s JOIN fa ON fa.series_id = s.series_id
             WHERE s.ts BETWEEN fa.t0 AND fa.t1 GROUP BY s.series_id""",
    "nt": """SELECT s.series_id, max(cast(ceil(s.value / 10) AS bigint)) AS ntmax FROM series s JOIN fa ON fa.series_id = s.series_id
             WHERE s.ts BETWEEN fa.t0 AND fa.t1 GROUP BY s.series_id""",
    "w": """SELECT series_id, cast(ts AS date) AS d, ts, cast(ceil(value / 10) AS bigint) AS n_tasks FROM series
            WHERE hour(ts) BETWEEN 18 AND 22""",
    "orig": """SELECT series_id, series_id || '_' || strftime(d, '%Y-%m-%d') AS interval_id, epoch(cast(d AS timestamp)) AS rec_order,
                      cast(d AS timestamp) + INTERVAL 18 HOUR AS start_ds, cast(d AS timestamp) + INTERVAL 22 HOUR AS end_ds,
                      max(n_tasks) AS n_tasks, arg_max(ts, (n_tasks, ts)) AS max_tasks_timestamp,
                      NULL::timestamp AS original_start_ds, NULL::timestamp AS original_end_ds, NULL::bigint AS original_n_tasks,
                      MAP {'prediction_date': strftime(d, '%Y-%m-%d')} AS metadata
               FROM w GROUP BY series_id, d""",
    "adj": """SELECT series_id, interval_id, rec_order, start_ds, end_ds, n_tasks + 3 AS n_tasks, max_tasks_timestamp,
                     start_ds AS original_start_ds, end_ds AS original_end_ds, n_tasks AS original_n_tasks,
                     CASE WHEN series_id = 'signup' THEN map_concat(metadata, MAP {'original_prediction_date': '2024-01-01'}) ELSE metadata END AS metadata
              FROM orig WHERE series_id IN ('purchase', 'signup')""",
    "aff": """SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY o.series_id ORDER BY rec_order, interval_id) AS rn
              FROM orig o JOIN fa ON fa.series_id = o.series_id
              WHERE (o.start_ds <= fa.t1 AND o.end_ds >= fa.t0)
                 OR (epoch(o.start_ds) - epoch(fa.t1) BETWEEN 0 AND 54000)) x WHERE rn = 1""",
    "adf": """SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY o.series_id ORDER BY rec_order, interval_id) AS rn
              FROM adj o JOIN fa ON fa.series_id = o.series_id WHERE o.start_ds <= fa.t1 AND o.end_ds >= fa.t0) x WHERE rn = 1""",
    "d0": """SELECT fa.*, pm.pmax, nt.ntmax,
                    af.interval_id AS aff_id, af.start_ds AS aff_start, af.end_ds AS aff_end, af.n_tasks AS aff_n, af.max_tasks_timestamp AS aff_mt, af.metadata AS aff_meta,
                    ad.interval_id AS adj_id, ad.end_ds AS adj_end, ad.n_tasks AS adj_n, ad.max_tasks_timestamp AS adj_mt,
                    ad.original_start_ds AS adj_os, ad.original_end_ds AS adj_oe, ad.original_n_tasks AS adj_on, ad.metadata AS adj_meta,
                    round_even(100.0 * (fa.fmax - pm.pmax) / pm.pmax, 0) AS diff,
                    degrees(1 - first_v / last_v) AS slope
             FROM fa LEFT JOIN pm USING (series_id) LEFT JOIN nt USING (series_id)
             LEFT JOIN aff af ON af.series_id = fa.series_id LEFT JOIN adf ad ON ad.series_id = fa.series_id""",
    "d1": """SELECT *, CASE WHEN adj_id IS NOT NULL THEN adj_n WHEN aff_id IS NOT NULL THEN aff_n ELSE ntmax END AS prev_n,
                    CASE WHEN adj_id IS NOT NULL THEN adj_mt WHEN aff_id IS NOT NULL THEN aff_mt ELSE t0 END AS max_end,
                    CASE WHEN aff_id IS NOT NULL AND t0 >= aff_start - INTERVAL 3600 SECOND AND t0 < aff_start THEN aff_start ELSE t0 END AS start_change,
                    cast(round_even(ntmax * (100 + diff) / 100, 0) AS bigint) AS new_n FROM d0""",
    "d2": """SELECT *, cast(new_n - prev_n AS double) / prev_n AS chg FROM d1""",
    "d3": """SELECT *, CASE WHEN NOT coalesce(diff > 25 OR diff < -30, false)
                            OR coalesce((slope < 5 AND chg >= 0 AND chg < 0.3) OR (chg > -0.4 AND chg <= 0) OR (t0 < max_end AND diff < -30), false)
                       THEN 'none' WHEN adj_id IS NOT NULL THEN 'readjust' WHEN aff_id IS NOT NULL THEN 'adjust'
                       WHEN new_n > ntmax THEN 'new' ELSE 'none' END AS action FROM d2""",
}) + f"""
SELECT series_id, action, t0, t1, round(diff, 6) AS diff, round(slope, 6) AS slope, cast(prev_n AS bigint) AS prev_n_tasks,
       cast(CASE WHEN action <> 'none' THEN new_n END AS double) AS n_tasks,
       CASE action WHEN 'readjust' THEN least(start_change, adj_os) WHEN 'adjust' THEN least(start_change, aff_start) WHEN 'new' THEN t0 END AS start_ds,
       CASE action WHEN 'readjust' THEN greatest(adj_end, adj_oe, t1) WHEN 'adjust' THEN greatest(aff_end, t1) WHEN 'new' THEN t1 END AS end_ds,
       CASE action WHEN 'readjust' THEN adj_id WHEN 'adjust' THEN aff_id
                   WHEN 'new' THEN strftime(t0, '%Y-%m-%d') || '_' || series_id || '_eu_nrt_generated' END AS interval_id,
       CASE action WHEN 'readjust' THEN adj_os WHEN 'adjust' THEN aff_start END AS original_start_ds,
       CASE action WHEN 'readjust' THEN adj_oe WHEN 'adjust' THEN aff_end END AS original_end_ds,
       cast(CASE action WHEN 'readjust' THEN adj_on WHEN 'adjust' THEN aff_n END AS double) AS original_n_tasks,
       CASE action
         WHEN 'readjust' THEN array_to_string(list_sort(list_transform(map_entries(map_concat(
              map_from_entries(list_filter(map_entries(adj_meta), lambda e: e.key <> 'prediction_date')),
              MAP {{'prediction_date': '{PT}'}},
              CASE WHEN NOT list_contains(map_keys(adj_meta), 'original_prediction_date') AND list_contains(map_keys(adj_meta), 'prediction_date')
                   THEN MAP {{'original_prediction_date': adj_meta['prediction_date']}} ELSE MAP {{}}::MAP(VARCHAR, VARCHAR) END)),
              lambda e: e.key || '=' || e.value)), ';')
         WHEN 'adjust' THEN array_to_string(list_sort(list_transform(map_entries(map_concat(
              map_from_entries(list_filter(map_entries(aff_meta), lambda e: e.key <> 'prediction_date')),
              MAP {{'prediction_date': '{PT}'}},
              CASE WHEN NOT list_contains(map_keys(aff_meta), 'original_prediction_date') AND list_contains(map_keys(aff_meta), 'prediction_date')
                   THEN MAP {{'original_prediction_date': aff_meta['prediction_date']}} ELSE MAP {{}}::MAP(VARCHAR, VARCHAR) END)),
              lambda e: e.key || '=' || e.value)), ';')
         WHEN 'new' THEN 'prediction_date=' || strftime(TIMESTAMP '{PT}' + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
       END AS metadata
FROM d3"""


@query("recommendation_adjustment", ops=("DEC1", "DEC2", "WIN10", "PRJ23", "PRJ26", "PRJ27", "FIL16"), sql=DEC_SQL)
def recommendation_adjustment(spark, sf_dir):
    """Per series (as service), adjust / re-adjust / create a scaling recommendation from a forecast."""
    t = Tables(spark, sf_dir)
    d = _decision(t)
    d = d.withColumns({"metadata": _meta_text(F.col("metadata")), "n_tasks": F.col("n_tasks").cast("double"),
                       "original_n_tasks": F.col("original_n_tasks").cast("double")})
    return finish(d)


EXPAND_SQL = ctes("series", extra={
    "w": """SELECT series_id, cast(ts AS date) AS d, cast(ceil(value / 10) AS bigint) AS n_tasks FROM series
            WHERE hour(ts) BETWEEN 18 AND 22""",
    "orig": """SELECT series_id, series_id || '_' || strftime(d, '%Y-%m-%d') AS interval_id,
                      cast(d AS timestamp) + INTERVAL 18 HOUR AS start_ds, cast(d AS timestamp) + INTERVAL 22 HOUR AS end_ds,
                      max(n_tasks) AS n_tasks FROM w GROUP BY series_id, d""",
    "adj": "SELECT interval_id, start_ds, end_ds, n_tasks + 3 AS n_tasks FROM orig WHERE series_id IN ('purchase', 'signup')",
    "ex": "SELECT interval_id, n_tasks AS count, unnest(generate_series(start_ds, end_ds, INTERVAL 1 HOUR)) AS ts FROM orig",
    "ei": "SELECT interval_id, n_tasks AS count, unnest(generate_series(start_ds, end_ds, INTERVAL 1 HOUR)) AS ts FROM adj",
    "r": "SELECT * FROM ex WHERE interval_id NOT IN (SELECT interval_id FROM adj) UNION ALL SELECT * FROM ei"}) + """
SELECT interval_id, cast(count AS bigint) AS count, ts, 'n_tasks' AS type,
       interval_id || '_n_tasks_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '_prod' AS id FROM r"""


@query("interval_expansion", ops=("GEN3", "SNK6", "SNK5", "PRJ21", "PRJ22"), sql=EXPAND_SQL)
def interval_expansion(spark, sf_dir):
    """Recommendations as hourly task rows, published by month; adjusted intervals replace theirs; keyed upsert."""
    t = Tables(spark, sf_dir)
    orig, adj = _recs(t)
    rows = lambda r: de.expand_intervals(r, 3600).withColumn("month", year_month("ts"))
    table = PublishedTable(spark, scratch_path(spark, "expansion"), ["id"])
    table.upsert(rows(orig))
    table.replace(rows(adj), ["interval_id", "type"])
    table.upsert(rows(adj))
    return finish(table.read().drop("month"))


@query("forecast_publish_tags", ops=("SNK7", "PRJ20", "PRJ21"), sql=ctes("series") + """
SELECT series_id, ts, round(value, 6) AS value, 'prod' AS env, 'eu' AS region, 'svc' AS service,
       min(ts) OVER (PARTITION BY series_id) AS series_start,
       strftime(min(ts) OVER (PARTITION BY series_id), '%Y-%m-%dT%H:%M:%S') || '_svc_eu_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '_prod' AS id
FROM series""")
def forecast_publish_tags(spark, sf_dir):
    """Series rows tagged for publishing with their series start and composite id."""
    t = Tables(spark, sf_dir)
    return finish(de.tag_forecast(t.series, env="prod", region="eu", service="svc", keys=["series_id"]))


@query("tiered_throughput", ops=("SET5", "SET1"), sql=ctes("series", extra={
    "t0": "SELECT series_id, ts, value, 0 AS tier FROM series WHERE ts < TIMESTAMP '2024-01-15'",
    "t1r": "SELECT series_id, ts, value, 1 AS tier FROM series WHERE ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-20'",
    "t1": """SELECT t.* FROM t1r t LEFT JOIN (SELECT series_id, max(ts) AS m FROM t0 GROUP BY 1) n USING (series_id)
             WHERE n.m IS NULL OR epoch(t.ts) - epoch(n.m) >= 1""",
    "u1": "SELECT * FROM t0 UNION ALL SELECT * FROM t1",
    "t2r": "SELECT series_id, ts, value, 2 AS tier FROM series WHERE ts >= TIMESTAMP '2024-01-19'",
    "t2": """SELECT t.* FROM t2r t LEFT JOIN (SELECT series_id, max(ts) AS m FROM u1 GROUP BY 1) n USING (series_id)
             WHERE n.m IS NULL OR epoch(t.ts) - epoch(n.m) >= 300"""}) + """
SELECT series_id, ts, round(value, 6) AS value, cast(tier AS bigint) AS tier FROM u1 UNION ALL
SELECT series_id, ts, round(value, 6), cast(tier AS bigint) FROM t2""")
def tiered_throughput(spark, sf_dir):
    """Cleansed history, then earlier gap loads after it, then new points at least 5 minutes later."""
    t = Tables(spark, sf_dir)
    s = t.series
    ts = lambda v: F.lit(v).cast("timestamp")
    tiers = [s.where(F.col("ts") < ts("2024-01-15")),
             s.where((F.col("ts") >= ts("2024-01-14")) & (F.col("ts") < ts("2024-01-20"))),
             s.where(F.col("ts") >= ts("2024-01-19"))]
    return finish(asof.tiered_union(tiers, ["series_id"], "ts", [0, 0, 300]))


@query("asof_daily_partition", ops=("SRC4", "SRC5", "SNK4"), sql="""
SELECT event_id, user_id, cast(cast(ts AS date) AS timestamp) AS day FROM events
WHERE cast(ts AS date) = (SELECT max(cast(ts AS date)) FROM events
                          WHERE cast(ts AS date) <= DATE '2024-01-17' AND cast(ts AS date) > DATE '2024-01-14')""")
def asof_daily_partition(spark, sf_dir):
    """Rows of the newest daily partition on or before a date (within a 3-day window)."""
    t = Tables(spark, sf_dir)
    ev = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    root = write_dated(ev, scratch_path(spark, "daily"), date_col="day")
    dated = spark.read.parquet(root)  # ``day`` is a partition column: the chosen folder alone is read
    return finish(asof.asof_partition(dated, "day", "2024-01-17", min_exclusive="2024-01-14"))


@query("gap_file_scan", ops=("SRC6", "WIN7"), sql=ctes("service_traffic", extra={
    "f": """SELECT strftime(date_trunc('day', datetime), '%Y-%m-%dT%H:%M:%S') || '_' ||
                   strftime(date_trunc('day', datetime) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS file_name, datetime, service_count
            FROM service_traffic"""}) + """
SELECT DISTINCT ON (datetime) file_name, datetime, round(service_count, 6) AS service_count FROM f
WHERE datetime > TIMESTAMP '2024-01-10 05:00:00' AND datetime <= TIMESTAMP '2024-01-12 07:00:00'
ORDER BY datetime, file_name DESC""")
def gap_file_scan(spark, sf_dir):
    """Daily gap files overlapping a range; rows inside it, one per time."""
    t = Tables(spark, sf_dir)
    st = t.service_traffic
    day = F.date_trunc("day", "datetime")
    f = st.withColumn("file_name", F.concat_ws("_", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
                                                F.date_format(day + F.make_dt_interval(days=F.lit(1)), "yyyy-MM-dd'T'HH:mm:ss")))
    out = asof.gap_files(f, "2024-01-10 05:00:00", "2024-01-12 07:00:00", ts="datetime")
    return finish(out.select("file_name", "datetime", "service_count"))
