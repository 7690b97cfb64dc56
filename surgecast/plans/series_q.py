"""Series, islands and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.functions.scalar import clip_lower
from surgecast.operators import islands as isl
from surgecast.operators import metrics as met
from surgecast.operators import series as ser
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.session import materialize
from surgecast.sources.tables import Tables, money_sum

STEP = 600  # 10-minute grain: driver events leave natural gaps at this grain


def ten_minute_series(t: Tables):
    b = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / STEP) * STEP)
    return t.events.groupBy(F.col("event_type").alias("series_id"), b.alias("ts")).agg(money_sum("value").alias("value"))


S10_SQL = {
    "s10": f"""SELECT event_type AS series_id, epoch_ms(cast(floor(epoch(ts) / {STEP}) * {STEP} AS bigint) * 1000) AS ts,
                     cast(sum(cast(value AS decimal(12,2))) AS double) AS value
              FROM events GROUP BY 1, 2""",
    "bounds": "SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM s10 GROUP BY series_id",
    "grid": f"""SELECT series_id, unnest(generate_series(lo, hi, INTERVAL {STEP} SECOND)) AS ts FROM bounds""",
    "g": "SELECT g.series_id, g.ts, s.value FROM grid g LEFT JOIN s10 s ON s.series_id = g.series_id AND s.ts = g.ts",
    "nb": """SELECT *, epoch_us(ts) AS t,
        last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
        last_value(CASE WHEN value IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
        first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
        first_value(CASE WHEN value IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
        FROM g""",
    "interp": """SELECT series_id, ts, value,
        CASE WHEN value IS NOT NULL THEN value WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
             ELSE pv + (nv - pv) * (cast(t - pt AS double) / cast(nt - pt AS double)) END AS filled FROM nb""",
}


@query("series_grid_interpolate", ops=("GEN2", "TS1", "WIN2", "PRJ28"), sql="WITH " + ",\n".join(f"{k} AS ({v})" for k, v in S10_SQL.items()) + """
SELECT series_id, ts, round(value, 6) AS value, round(filled, 6) AS filled,
       round(max(filled) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING), 6) AS rolling_max,
       round(greatest(filled, 1.0), 6) AS clipped
FROM interp""")
def series_grid_interpolate(spark, sf_dir):
    """Regular 10-minute grid per series, linear fill, centred max, clip at 1."""
    t = Tables(spark, sf_dir)
    g = ser.regular_grid(ten_minute_series(t), ["series_id"], "ts", STEP)
    g = ser.interpolate_linear(g, ["series_id"], "ts", "value", out="filled")
    g = ser.centred_max(g, ["series_id"], "ts", "filled", 12, out="rolling_max")
    return finish(g.withColumn("clipped", clip_lower("filled", 1.0)))


METRICS = ["traffic", "predicted", "cpu_util", "error_rate", "running_ecs", "response_time"]
N_LAGS = 10


def aligned_metrics(t: Tables):
    sm = t.service_metrics
    frames = {m: sm.select("datetime", F.col(m).alias("count")) for m in METRICS if m != "predicted"}
    frames["predicted"] = t.predictions_full.select(F.col("ds").alias("datetime"), F.col("total").alias("count"))
    frames = {m: frames[m] for m in METRICS}
    return ser.align_metrics(frames, "datetime", "count", lower_from="cpu_util", upper_from="traffic")


def _lag_sql() -> str:
    cols = []
    for m in METRICS:
        cols.append(f"round({m}, 6) AS {m}")
        cols.append(f"round({m} - median({m}) OVER (), 6) AS {m}_diff_from_median")
        cols.append(f"cast({m} > quantile_cont({m}, 0.999) OVER () AS bigint) AS {m}_more_quant_999")
        cols.append(f"round(ln({m} + 1), 6) AS {m}_log")
        for l in range(1, N_LAGS + 1):
            cols.append(f"round(lag({m}, {l}) OVER (ORDER BY datetime), 6) AS {m}_lag_{l}")
    sel = ",\n       ".join(cols)
    lag_cols = " AND ".join(f"{m}_lag_{l} IS NOT NULL" for m in METRICS for l in range(1, N_LAGS + 1))
    return ctes("service_metrics", "predictions_full", extra={
        "al": """SELECT m.datetime, m.traffic, p.total AS predicted, m.cpu_util, m.error_rate,
                        cast(m.running_ecs AS double) AS running_ecs, m.response_time
                 FROM service_metrics m JOIN predictions_full p ON p.ds = m.datetime""",
        "f": f"SELECT datetime, {sel} FROM al",
    }) + f"""SELECT *, cast(hour(datetime) AS bigint) AS hour, cast(isodow(datetime) - 1 AS bigint) AS weekday
             FROM f WHERE {lag_cols}"""


@query("metric_alignment_lags", ops=("JON10", "FIL15", "PRJ25", "AGG9", "WIN3", "PRJ2"), sql=_lag_sql())
def metric_alignment_lags(spark, sf_dir):
    """Six metric series aligned by time, distribution features, 10 lags, hour and weekday."""
    t = Tables(spark, sf_dir)
    al = materialize(aligned_metrics(t))  # one row per hour; the 12 whole-frame statistics read it
    f = ser.with_distribution_features(al, [], METRICS)
    f = ser.with_lags(f, [], "datetime", METRICS, N_LAGS)
    f = f.withColumns({"hour": F.hour("datetime"), "weekday": F.weekday("datetime")})
    return finish(f)


ISLAND_SQL = ctes("anomaly_points", extra={
    "p": "SELECT *, cast(round(value * 100) AS bigint) AS mark FROM anomaly_points",
    "l": """SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY series_id ORDER BY ts) IS NULL
                       OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY series_id ORDER BY ts)) > 1800000000
                  THEN 1 ELSE 0 END AS nw FROM p""",
    "i": "SELECT *, sum(nw) OVER (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS isl FROM l",
}) + """SELECT series_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n_points, arg_min(mark, ts) AS mark
        FROM i GROUP BY series_id, isl"""


@query("anomaly_islands", ops=("WIN4", "WIN8", "AGG10", "SRT1"), sql=ISLAND_SQL)
def anomaly_islands(spark, sf_dir):
    """Periods of high values per series: a gap over 30 minutes starts a new period."""
    t = Tables(spark, sf_dir)
    p = t.anomaly_points.withColumn("mark", F.round(F.col("value") * 100).cast("bigint"))
    out = isl.islands(p, ["series_id"], "ts", gap_seconds=1800, annotation="mark")
    return finish(out.select("series_id", "start_time", "end_time", "n_points", "mark"))


@query("anomaly_islands_session", ops=("WIN4",), sql=ISLAND_SQL.replace(
    ", arg_min(mark, ts) AS mark", ""))
def anomaly_islands_session(spark, sf_dir):
    """The same periods from Spark's session windows."""
    t = Tables(spark, sf_dir)
    return finish(isl.session_islands(t.anomaly_points, ["series_id"], "ts", gap_seconds=1800))


@query("series_extremes", ops=("WIN6", "WIN9", "DEC4"), sql=ctes("series", extra={
    "w": """SELECT *, max(value) OVER (PARTITION BY series_id) AS group_max,
                   arg_max(ts, value) OVER (PARTITION BY series_id) AS tmax,
                   arg_min(value, ts) OVER (PARTITION BY series_id) AS first_value,
                   arg_max(value, ts) OVER (PARTITION BY series_id) AS last_value FROM series"""}) + """
SELECT series_id, ts, round(value, 6) AS value, round(group_max, 6) AS group_max, tmax AS time_of_max,
       round(first_value, 6) AS first_value, round(last_value, 6) AS last_value,
       round(CASE WHEN value = group_max THEN value * 2 END, 6) AS target
FROM w""")
def series_extremes(spark, sf_dir):
    """Group max and its time on every row, first/last values, target on the peak row."""
    t = Tables(spark, sf_dir)
    s = t.series
    s = ser.group_max_rows(s, ["series_id"], "value", "ts")
    s = s.join(ser.first_last_valid(t.series, ["series_id"], "ts", "value"), "series_id")
    s = met.mark_target(s.withColumn("_t", F.col("value") * 2), ["series_id"], "value", "_t").drop("_t")
    return finish(s.select("series_id", "ts", "value", "group_max", "time_of_max", "first_value", "last_value", "target"))


def _metric_sql(keys: str, src: str = "scored") -> str:
    return f"""SELECT {keys},
       round(round(cast(sum(cast(abs(y - yhat) AS decimal(30,10))) AS double) / count(*), 10), 6) AS mae,
       round(round(median(abs(y - yhat)), 10), 6) AS med_ae,
       round(round(avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END), 10), 6) AS mape,
       round(round(avg(CASE WHEN y > 0 THEN abs(yhat - y) / ((y + yhat) / 2) END), 10), 6) AS smape,
       round(round(median(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) WHEN abs(y - yhat) <> 0 THEN 'inf'::double END), 10), 6) AS med_ape,
       round(round(avg((y - yhat) * (y - yhat)), 10), 6) AS mse,
       round(round(stddev_pop(y - yhat), 10), 6) AS std,
       count(*) AS n
FROM {src} GROUP BY {keys}"""


@query("regression_metrics_by_model", ops=("AGG8", "SNK8"), sql=ctes("scored") + _metric_sql("model"))
def regression_metrics_by_model(spark, sf_dir):
    """MAE, median AE, MAPE, sMAPE, median APE, MSE and error std per model."""
    t = Tables(spark, sf_dir)
    return finish(met.regression_metrics(t.scored, ["model"]))


HIST_SRC = """(SELECT l_returnflag AS model, date_trunc('month', l_shipdate) AS created_at, l_extendedprice AS y,
                l_extendedprice * (1 - l_discount) * (1 + l_tax * 3 * (month(l_shipdate) % 4)) AS yhat FROM lineitem) h"""


def metric_history(t: Tables):
    li = t.lineitem
    yhat = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax") * 3 * (F.month("l_shipdate") % 4))
    h = li.select(F.col("l_returnflag").alias("model"), F.date_trunc("month", "l_shipdate").alias("created_at"),
                  F.col("l_extendedprice").alias("y"), yhat.alias("yhat"))
    return met.regression_metrics(h, ["model", "created_at"]).withColumn("approved", F.lit(True))


@query("metric_history_alerts", ops=("AGG11", "SRT2"), sql=f"""
WITH hist AS (SELECT model, created_at, round(avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END), 10) AS mape
              FROM {HIST_SRC} GROUP BY model, created_at),
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY created_at DESC) AS rn FROM hist),
cur AS (SELECT model, created_at AS last_update, mape AS current FROM r WHERE rn = 1),
prev AS (SELECT model, avg(mape) AS history_mean, count(*) AS history_n FROM r WHERE rn BETWEEN 2 AND 11 GROUP BY model)
SELECT c.model, c.last_update, round(c.current, 6) AS current, round(p.history_mean, 6) AS history_mean, p.history_n,
       cast(coalesce(p.history_mean < c.current AND c.current / p.history_mean > 2, false) AS bigint) AS accuracy_alert,
       cast(epoch(TIMESTAMP '1999-01-01') - epoch(c.last_update) > 2 * 86400 AS bigint) AS stale_alert
FROM cur c LEFT JOIN prev p ON p.model = c.model""")
def metric_history_alerts(spark, sf_dir):
    """Accuracy alert (newest MAPE vs mean of the last 10) and stale-model alert per model."""
    t = Tables(spark, sf_dir)
    out = met.accuracy_alerts(metric_history(t), ["model"], metric="mape", now="1999-01-01")
    return finish(out.select("model", "last_update", "current", "history_mean", "history_n", "accuracy_alert", "stale_alert"))


@query("model_choice", ops=("ML8",), sql="""
WITH m AS (SELECT l_linestatus AS grp, l_returnflag AS model,
                  round(avg(CASE WHEN l_extendedprice > 0 THEN abs(yhat - l_extendedprice) / ((l_extendedprice + yhat) / 2) END), 10) AS smape
           FROM (SELECT *, l_extendedprice * (1 - l_discount * (1 + (l_linenumber % 3))) AS yhat FROM lineitem) x
           GROUP BY l_linestatus, l_returnflag)
SELECT grp, arg_min(model, (smape, model)) AS chosen_model, round(min(smape), 6) AS chosen_smape
FROM m WHERE smape <= 0.33 GROUP BY grp""")
def model_choice(spark, sf_dir):
    """Per group, the model with the lowest sMAPE within the threshold."""
    t = Tables(spark, sf_dir)
    li = t.lineitem
    scored = li.select(F.col("l_linestatus").alias("grp"), F.col("l_returnflag").alias("model"),
                       F.col("l_extendedprice").alias("y"),
                       (F.col("l_extendedprice") * (1 - F.col("l_discount") * (1 + F.col("l_linenumber") % 3))).alias("yhat"))
    m = met.regression_metrics(scored, ["grp", "model"])
    return finish(met.choose_model(m, ["grp"], threshold=0.33))
