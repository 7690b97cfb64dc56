"""Streaming queries over the driver's events (file stream, availableNow)."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.plans.anomaly_q import HOURLY_ZSCORE, _zscore_sql
from surgecast.plans.registry import finish, query
from surgecast.plans.series_q import aligned_metrics
from surgecast.session import prepare_session
from surgecast.sinks.files import scratch_path
from surgecast.sources.tables import Tables
from surgecast.streaming import operators as st


def events_stream(spark, sf_dir):
    prepare_session(spark)  # UTC session clock: event times and window edges as in the batch queries
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir))


@query("stream_windowed_traffic", ops=("ST1",), sql="""
SELECT event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS n, round(cast(sum(cast(value AS decimal(12,2))) AS double), 6) AS total
FROM events GROUP BY 1, 2
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_windowed_traffic(spark, sf_dir):
    """Hourly traffic per event type from a file stream; windows closed by a 1-hour watermark."""
    s = events_stream(spark, sf_dir)
    out = st.run_to_table(spark, st.windowed_counts(s, ["event_type"], "ts", "value", window="1 hour", watermark="1 hour", exact="decimal(12,2)"),
                          "st1")
    return finish(out)


@query("stream_session_periods", ops=("ST2",), sql="""
WITH p AS (SELECT event_type AS series_id, ts FROM events WHERE value > 40),
l AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY series_id ORDER BY ts) IS NULL
                     OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY series_id ORDER BY ts)) >= 1800000000 THEN 1 ELSE 0 END AS nw FROM p),
i AS (SELECT *, sum(nw) OVER (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS isl FROM l),
g AS (SELECT series_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n_points FROM i GROUP BY series_id, isl)
SELECT * FROM g WHERE end_time + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events WHERE value > 40) - INTERVAL 1 HOUR""")
def stream_session_periods(spark, sf_dir):
    """High-value periods per type as session windows (30-minute gap) from a file stream."""
    s = events_stream(spark, sf_dir).where(F.col("value") > 40).select(F.col("event_type").alias("series_id"), "ts")
    return finish(st.run_to_table(spark, st.online_periods(s, ["series_id"], "ts", gap="30 minutes", watermark="1 hour"), "st2"))


@query("stream_dedupe_points", ops=("ST4",), sql="""
SELECT DISTINCT event_type, date_trunc('hour', ts) AS hour_ts FROM events""")
def stream_dedupe_points(spark, sf_dir):
    """One row per (type, hour) from a file stream, duplicates dropped within the watermark."""
    s = events_stream(spark, sf_dir).select("event_type", F.date_trunc("hour", "ts").alias("hour_ts"))
    out = st.run_to_table(spark, st.dedupe_points(s, ["event_type"], "hour_ts", watermark="2 hours"), "st4")
    return finish(out)


@query("stream_zscore_signals", ops=("ST3",), sql=f"""WITH whole AS ({_zscore_sql()})
SELECT * FROM whole WHERE datetime <= (SELECT max(datetime) FROM whole) - INTERVAL 1 HOUR""")
def stream_zscore_signals(spark, sf_dir):
    """The smoothed z-score as stateful stream processing over hourly metric files, up to the watermark."""
    t = Tables(spark, sf_dir)
    al = aligned_metrics(t)
    long = None
    for m in HOURLY_ZSCORE:
        part = al.select(F.lit(m).alias("metric"), "datetime", F.col(m).cast("double").alias("value"))
        long = part if long is None else long.unionByName(part)
    src = scratch_path(spark, "metrics-in")
    long.write.mode("overwrite").parquet(src)
    outs = None
    for m, (lag, th, infl) in HOURLY_ZSCORE.items():
        s = spark.readStream.schema(long.schema).parquet(src).where(F.col("metric") == m)
        o = st.run_to_table(spark, st.zscore_stream(s, "metric", "datetime", "value", lag=lag, threshold=th, influence=infl), f"st3-{m}")
        outs = o if outs is None else outs.unionByName(o)
    return finish(outs)
