"""F3 queries: z-score signals, ESD, forest scores, annotation, periods, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.functions.text import annotation_text
from surgecast.operators import anomaly as an
from surgecast.operators import calendar as cal_ops
from surgecast.plans.events import GRAIN, _attributed
from surgecast.operators import forest as fo
from surgecast.operators import islands as isl
from surgecast.operators import series as ser
from surgecast.plans.forecast_q import hourly_complete
from surgecast.plans.attribution import ATTR_VIEWS
from surgecast.plans.features_q import TARGET_CTES
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.plans.series_q import aligned_metrics
from surgecast.session import materialize
from surgecast.sinks.files import scratch_path
from surgecast.sinks.tables import PublishedTable
from surgecast.sources.tables import Tables

# The reference's (lag, threshold, influence) at 5-minute points, rescaled to the
# hour grain of the driver data: 288 points = 24 hours, 48 points = 4 hours.
HOURLY_ZSCORE = {"error_rate": (24, 5.0, 0.2), "cpu_util": (4, 4.0, 0.2), "response_time": (4, 6.0, 0.2)}


def zscore_long(t: Tables):
    al = aligned_metrics(t)
    points = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in HOURLY_ZSCORE]))
    long = al.select("datetime", points.alias("p")).select("p.metric", "datetime", "p.value")
    return an.smoothed_zscore(long, ["metric"], "datetime", "value", settings=HOURLY_ZSCORE)


def _zscore_sql() -> str:
    params = " UNION ALL ".join(f"SELECT '{m}' AS metric, {l} AS lg, {th} AS th, {i} AS infl" for m, (l, th, i) in HOURLY_ZSCORE.items())
    al = """SELECT m.datetime, m.cpu_util, m.error_rate, m.response_time FROM service_metrics m
            JOIN predictions_full p ON p.ds = m.datetime"""
    return ctes("service_metrics", "predictions_full", extra={
        "al": al,
        "prm": params,
        "lng": """SELECT 'error_rate' AS metric, datetime, error_rate AS y FROM al UNION ALL
                  SELECT 'cpu_util', datetime, cpu_util FROM al UNION ALL
                  SELECT 'response_time', datetime, response_time FROM al""",
        "base": """SELECT l.metric, l.datetime, l.y, p.lg, p.th, p.infl,
                          row_number() OVER (PARTITION BY l.metric ORDER BY l.datetime) - 1 AS i FROM lng l JOIN prm p USING (metric)""",
    }).replace("WITH ", "WITH RECURSIVE ", 1) + """,
r AS (
  SELECT b.metric, b.i, b.y, 0 AS signal, b.y AS filt, w.win,
         list_avg(w.win) AS avg_f, list_aggregate(w.win, 'stddev_pop') AS std_f
  FROM base b JOIN (SELECT metric, list(y ORDER BY i) AS win FROM base WHERE i < lg GROUP BY metric) w USING (metric)
  WHERE b.i = b.lg - 1
  UNION ALL
  SELECT metric, i, y, signal, filt, win, list_avg(win), list_aggregate(win, 'stddev_pop') FROM (
    SELECT metric, i, y, signal, filt, list_append(pwin[2:], filt) AS win FROM (
      SELECT b.metric, b.i, b.y, r.win AS pwin,
             CASE WHEN abs(b.y - r.avg_f) > b.th * r.std_f THEN CASE WHEN b.y > r.avg_f THEN 1 ELSE -1 END ELSE 0 END AS signal,
             CASE WHEN abs(b.y - r.avg_f) > b.th * r.std_f THEN b.infl * b.y + (1 - b.infl) * r.filt ELSE b.y END AS filt
      FROM r JOIN base b ON b.metric = r.metric AND b.i = r.i + 1) s1) s2
)
SELECT b.metric, b.datetime, round(b.y, 6) AS value, cast(coalesce(r.signal, 0) AS bigint) AS signal,
       round(coalesce(r.avg_f, 0.0), 6) AS avg_filter, round(coalesce(r.std_f, 0.0), 6) AS std_filter
FROM base b LEFT JOIN r ON r.metric = b.metric AND r.i = b.i"""


@query("smoothed_zscore_signals", ops=("TS10",), sql=_zscore_sql())
def smoothed_zscore_signals(spark, sf_dir):
    """Smoothed z-score signals of error rate, cpu and response time (hour grain)."""
    t = Tables(spark, sf_dir)
    return finish(zscore_long(t).withColumnRenamed("datetime", "datetime"))


@query("esd_anomalies", ops=("TS12",))
def esd_anomalies(spark, sf_dir):
    """Seasonal hybrid ESD (upper tail) on every hourly series; share cap 1%."""
    t = Tables(spark, sf_dir)
    return finish(an.seasonal_esd(hourly_complete(t), ["series_id"], "ts", "value", period=24, max_anoms=0.01))


PEAK_SQL = ctes(*ATTR_VIEWS, "calendar", extra={
    **TARGET_CTES,
    "ev": """SELECT c.sport, c.id, c.date_utc, p.tgt AS y FROM pe_max p JOIN calq c ON c.sport = p.sport AND c.id = p.id""",
    "tg": "SELECT sport, date_utc, bool_or(y >= 20.0) AS peak, list(y) AS ys FROM ev GROUP BY sport, date_utc",
    "tt": "SELECT *, row_number() OVER (PARTITION BY sport ORDER BY date_utc) AS k FROM tg",
}).replace("WITH ", "WITH RECURSIVE ", 1) + """,
r AS (
  SELECT sport, k, CAST(NULL AS double) AS med, CASE WHEN peak THEN CAST([] AS double[]) ELSE ys END AS hist
  FROM tt WHERE k = 1
  UNION ALL
  SELECT sport, k, med,
         CASE WHEN peak THEN list_concat(hist0, list_resize(CAST([] AS double[]), len(ys), med)) ELSE list_concat(hist0, ys) END
  FROM (
    SELECT t.sport, t.k, t.peak, t.ys, r.hist AS hist0,
           CASE WHEN t.peak THEN list_aggregate(r.hist, 'median') END AS med
    FROM r JOIN tt t ON t.sport = r.sport AND t.k = r.k + 1) s
)
SELECT ev.sport, ev.id, ev.date_utc,
       round(CASE WHEN t.peak THEN r.med ELSE ev.y END, 6) AS y
FROM ev JOIN tt t ON t.sport = ev.sport AND t.date_utc = ev.date_utc
JOIN r ON r.sport = t.sport AND r.k = t.k"""


@query("peak_replacement", ops=("TS2",), sql=PEAK_SQL)
def peak_replacement(spark, sf_dir):
    """Per sport, targets at or above the threshold replaced by the median of earlier targets."""
    t = Tables(spark, sf_dir)
    ev = cal_ops.event_targets(_attributed(t), cal_ops.quantize_calendar(t.calendar, grain_seconds=GRAIN))
    ev = ev.select("sport", "id", "date_utc", F.col("event_count_on_service_extra_traffic_scale").alias("y"))
    return finish(an.replace_peaks(ev, ["sport"], "date_utc", "y", threshold=20.0))


FOREST_FEATURES = ["traffic", "cpu_util", "error_rate", "response_time"]


def forest_frame(t: Tables):
    al = materialize(aligned_metrics(t).select("datetime", *FOREST_FEATURES))  # the whole-frame statistics read it, too
    f = ser.with_distribution_features(al, [], FOREST_FEATURES)
    f = ser.with_lags(f, [], "datetime", FOREST_FEATURES, 10).dropna()  # no log at -1 or below
    # read by the sampler, the scorer and the ESD detectors: computed once
    return materialize(f.withColumns({"hour": F.hour("datetime"), "weekday": F.weekday("datetime")}))


@query("forest_scores", ops=("ML9", "AGG9", "FIL14"))
def forest_scores(spark, sf_dir):
    """Random-cut-forest scores on lagged metric features; 0.95 / 0.99 quantile flags."""
    t = Tables(spark, sf_dir)
    f = forest_frame(t)
    feats = [c for c in f.columns if c != "datetime"]
    train = ser.slice_days(f, "datetime", "2024-01-20", 19)
    trees = fo.rcf_fit(train, feats, key=["datetime"])
    scored = fo.rcf_score(f, trees, feats)
    out = an.quantile_flags(scored, "score", [0.95, 0.99])
    return finish(out.select("datetime", "score", "`anomaly_0.95`", "`anomaly_0.99`"))


ESD_SIGNALS_SQL = ctes("service_metrics", "anomaly_points", extra={
    "esd": """SELECT date_trunc('hour', ts) AS datetime, sum(value) AS anomaly, list_sort(list(DISTINCT series_id)) AS esd_ann
              FROM anomaly_points GROUP BY 1""",
    "sc": """SELECT m.datetime, m.error_rate, m.cpu_util, m.error_rate > 0.35 AS flag,
                    CASE WHEN m.error_rate > 0.3 THEN 1 ELSE 0 END AS signal_er,
                    CASE WHEN m.cpu_util > 30 THEN 1 WHEN m.cpu_util < 12 THEN -1 ELSE 0 END AS signal_cu
             FROM service_metrics m""",
    "j": """SELECT sc.*, e.anomaly, e.esd_ann,
                   CASE WHEN e.anomaly IS NOT NULL THEN true ELSE sc.flag END AS flag2,
                   coalesce(e.esd_ann, list_filter([CASE WHEN signal_er IN (-1, 1) THEN 'error_rate' END,
                                                    CASE WHEN signal_cu IN (-1, 1) THEN 'cpu_util' END], lambda x: x IS NOT NULL)) AS ann
            FROM sc LEFT JOIN esd e ON e.datetime = sc.datetime"""}) + """
SELECT datetime, round(anomaly, 6) AS anomaly,
       cast(CASE WHEN len(ann) = 0 THEN false ELSE flag2 END AS bigint) AS flag,
       array_to_string(ann, ',') AS annotation,
       CASE WHEN anomaly IS NOT NULL THEN 'Twitter Anomaly Detection' ELSE 'Random Cut Forest' END AS algorithm
FROM j"""


def esd_merged(t: Tables):
    pts = t.anomaly_points.select(F.date_trunc("hour", "ts").alias("datetime"), "series_id", "value")
    dedup = pts.groupBy("datetime").agg(F.sum("value").alias("anomaly"),
                                        F.array_sort(F.collect_set("series_id")).alias("annotation"))
    return dedup


@query("anomaly_merge_annotate", ops=("AGG7", "JON14", "TS11", "FIL17"), sql=ESD_SIGNALS_SQL)
def anomaly_merge_annotate(spark, sf_dir):
    """High-value points merged per hour, joined onto hourly flags, annotated; baseless flags reset."""
    t = Tables(spark, sf_dir)
    sm = t.service_metrics
    sc = sm.select(
        "datetime", "error_rate", "cpu_util", (F.col("error_rate") > 0.35).alias("flag"),
        F.when(F.col("error_rate") > 0.3, 1).otherwise(0).alias("signal_er"),
        F.when(F.col("cpu_util") > 30, 1).when(F.col("cpu_util") < 12, -1).otherwise(0).alias("signal_cu"),
    )
    j = an.attach_anomalies(sc, esd_merged(t), "flag", ts="datetime")
    j = an.annotate(j, {"error_rate": "signal_er", "cpu_util": "signal_cu"}, esd_flag="anomaly")
    j = an.drop_baseless(j, ["flag"])
    return finish(j.select("datetime", "anomaly", "flag", F.array_join("annotation", ",").alias("annotation"), "algorithm"))


@query("anomaly_report_daily", ops=("DEC5", "FIL13", "PRJ30", "WIN4"), sql=ctes("anomaly_points", extra={
    "l": """SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY series_id ORDER BY ts) IS NULL
                       OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY series_id ORDER BY ts)) > 1800000000
                  THEN 1 ELSE 0 END AS nw FROM anomaly_points""",
    "i": "SELECT *, sum(nw) OVER (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS isl FROM l",
    "p": "SELECT series_id, min(ts) AS start_time, max(ts) AS end_time, 'based on ' || series_id AS annotation FROM i GROUP BY series_id, isl",
    "h": "SELECT * FROM p WHERE cast(start_time AS date) = DATE '2024-01-15' OR cast(end_time AS date) = DATE '2024-01-15'"}) + r"""
SELECT series_id, count(*) AS n_periods,
       array_to_string(list_sort(list('from ' || strftime(start_time, '%Y-%m-%d %H:%M:%S') || ' till ' ||
                                      strftime(end_time, '%Y-%m-%d %H:%M:%S') || ' ' || annotation)), chr(10)) AS message
FROM h GROUP BY series_id""")
def anomaly_report_daily(spark, sf_dir):
    """Per series, the anomalous periods touching 2024-01-15 as report lines."""
    t = Tables(spark, sf_dir)
    periods = isl.islands(t.anomaly_points, ["series_id"], "ts", gap_seconds=1800)
    periods = periods.withColumn("annotation", annotation_text(F.array("series_id")))
    return finish(an.anomaly_report(periods, "2024-01-15", ["series_id"]))


#: The reference's caps by sport, for the sports of the driver data.
CAPS = {"click": an.SPORT_CAPS["football"], "view": an.SPORT_CAPS["hockey"], "purchase": an.SPORT_CAPS["basketball"]}


def sport_periods(t: Tables):
    """Anomalous periods of each sport's hourly predictions, hours without extra traffic being 0."""
    cols = {"click": "click", "view": "view_", "purchase": "purchase"}
    points = F.explode(F.array(*[F.struct(F.lit(s).alias("sport"), F.col(c).alias("value")) for s, c in cols.items()]))
    long = t.predictions_full.select("ds", points.alias("p")).select("p.sport", "ds", "p.value")
    grid = ser.regular_grid(long.select("sport", F.col("ds").alias("ts"), "value"), ["sport"], "ts", 3600).fillna(0.0, ["value"])
    return an.group_anomalies(grid, "ts", period=24, caps=CAPS, gap_seconds=3600)


@query("sport_anomaly_periods", ops=("TS12", "WIN4", "PRJ30"))
def sport_anomaly_periods(spark, sf_dir):
    """Anomalous periods of the predictions by sport, each sport under its own cap."""
    return finish(sport_periods(Tables(spark, sf_dir)))


def metric_periods(t: Tables):
    """Forest flags, ESD per metric, z-score annotation, joined to periods."""
    f = forest_frame(t)
    feats = [c for c in f.columns if c != "datetime"]
    trees = fo.rcf_fit(ser.slice_days(f, "datetime", "2024-01-20", 19), feats, key=["datetime"])
    scored = an.quantile_flags(fo.rcf_score(f, trees, feats), "score", [0.95, 0.99])
    long = None
    for m in ["error_rate", "cpu_util"]:
        part = f.select(F.lit(m).alias("series_id"), F.col("datetime").alias("ts"), F.col(m).alias("value"))
        long = part if long is None else long.unionByName(part)
    esd = an.seasonal_esd(long, ["series_id"], "ts", "value", period=24, max_anoms=0.02)
    merged = an.merge_esd(esd, "ts", "value", "series_id").withColumnRenamed("ts", "datetime")
    j = an.attach_anomalies(scored, merged, "anomaly_0.99", ts="datetime")
    sig = (zscore_long(t).withColumn("metric", F.concat(F.lit("signal_"), "metric"))
           .groupBy("datetime").pivot("metric", [f"signal_{m}" for m in HOURLY_ZSCORE]).agg(F.first("signal")))
    j = j.join(sig, "datetime", "left")
    j = an.annotate(j, {m: f"signal_{m}" for m in HOURLY_ZSCORE}, esd_flag="anomaly")
    j = an.drop_baseless(j, ["anomaly_0.95", "anomaly_0.99"])
    flagged = j.where(F.col("`anomaly_0.99`"))
    periods = isl.islands(flagged.withColumn("ann_text", annotation_text("annotation")), [], "datetime",
                          gap_seconds=1800, annotation="ann_text", extra={"algorithm": F.min("algorithm")})
    return periods.withColumnRenamed("ann_text", "annotation")


@query("metric_anomaly_periods", ops=("ML10", "ML9", "TS10", "TS11", "TS12", "AGG7", "JON14", "FIL17", "WIN4", "PRJ30", "SET1"))
def metric_anomaly_periods(spark, sf_dir):
    """Full metric anomaly flow: forest flags, ESD per metric, z-score annotation, periods."""
    return finish(metric_periods(Tables(spark, sf_dir)))


@query("anomaly_table_published", ops=("SNK9", "SET1", "ML10", "TS12"))
def anomaly_table_published(spark, sf_dir):
    """Periods of both flows in one table, published for the ingest day and read back; a rerun changes nothing."""
    t = Tables(spark, sf_dir)
    cols = ["kind", "start_time", "end_time", "n_points", "annotation", "algorithm"]
    metric = metric_periods(t).withColumn("kind", F.lit("metric")).select(*cols)
    sport = sport_periods(t).withColumn("kind", F.concat(F.lit("sport "), "sport")).select(*cols)
    found = materialize(metric.unionByName(sport).withColumns({"service": F.lit("svc"), "region": F.lit("eu"), "ingest_date": F.lit("2024-01-30")}))
    table = PublishedTable(spark, scratch_path(spark, "anomalies"), ["service", "region", "kind", "start_time"], partition="ingest_date")
    first = table.upsert(found)
    if table.upsert(found) != first:
        raise RuntimeError("a repeated run changed the anomaly table")
    return finish(table.read())
