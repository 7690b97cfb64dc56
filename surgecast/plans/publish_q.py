"""Queries that publish and read back: keyed upserts, replaced series, the forecast
index, metric history, dated files, JSON recommendations, model versions, anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.functions.timeparts import iso_minute, year_month
from surgecast.operators import calendar as cal_ops
from surgecast.operators import decide as de
from surgecast.operators import metrics as met
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.sinks import history as hi
from surgecast.sinks.files import scratch_path, write_dated
from surgecast.sinks.tables import PublishedTable
from surgecast.sources import asof
from surgecast.sources import files as src
from surgecast.sources.tables import Tables

ENV = "prod"
#: The second run covers what was ordered from here on; the first one ended after it.
SECOND_FROM, FIRST_TO = "1999-06-01", "2000-01-01"


def customer_intervals(t: Tables):
    """One scaling recommendation a customer and order day: 18:00 to 22:00, a task an order and one more."""
    day = F.date_trunc("day", "o_orderdate")
    g = t.orders.groupBy("o_custkey", day.alias("d")).agg((F.count(F.lit(1)) + 1).alias("n_tasks"))
    start = F.col("d") + F.make_dt_interval(hours=F.lit(18))
    service = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    return g.select(
        de.new_recommendation_id(start, service, F.lit("eu")).alias("interval_id"), service.alias("service"),
        start.alias("start_ds"), (F.col("d") + F.make_dt_interval(hours=F.lit(22))).alias("end_ds"), "n_tasks", "o_custkey")


def plain_rows(recs, kind: str = "predicted"):
    """Rows of the plain index: keyed ``<interval>_<type>_<env>``, by month of their start."""
    return recs.select(
        F.concat_ws("_", "interval_id", F.lit(kind), F.lit(ENV)).alias("id"), year_month("start_ds").alias("month"), "interval_id", "service",
        "start_ds", iso_minute("end_ds").alias("end_text"), "n_tasks")


_INTERVALS_SQL = """
WITH g AS (SELECT o_custkey, date_trunc('day', o_orderdate) AS d, count(*) + 1 AS n FROM orders GROUP BY 1, 2),
r AS (SELECT o_custkey, strftime(d, '%Y-%m-%d') || '_c' || o_custkey || '_eu_nrt_generated' AS interval_id, 'c' || o_custkey AS service,
             cast(d AS timestamp) + INTERVAL 18 HOUR AS start_ds, cast(d AS timestamp) + INTERVAL 22 HOUR AS end_ds, d, n FROM g)"""


@query("recommendation_index_upsert", ops=("SNK5", "PRJ21", "PRJ22"), sql=_INTERVALS_SQL + f"""
SELECT interval_id || '_predicted_{ENV}' AS id, strftime(start_ds, '%Y-%m') AS month, interval_id, service, start_ds,
       strftime(end_ds, '%Y-%m-%d %H:%M') AS end_text, cast(CASE WHEN d >= DATE '{SECOND_FROM}' THEN n + 3 ELSE n END AS bigint) AS n_tasks
FROM r""")
def recommendation_index_upsert(spark, sf_dir):
    """Recommendations published by month in two overlapping runs, the second repeated; read back."""
    t = Tables(spark, sf_dir)
    recs = customer_intervals(t)
    table = PublishedTable(spark, scratch_path(spark, "recommendations"), ["id"])
    table.upsert(plain_rows(recs.where(F.col("start_ds") < F.lit(FIRST_TO).cast("timestamp"))))
    later = recs.where(F.col("start_ds") >= F.lit(SECOND_FROM).cast("timestamp")).withColumn("n_tasks", F.col("n_tasks") + 3)
    done = table.upsert(plain_rows(later))
    again = table.upsert(plain_rows(later))
    if again != done:
        raise RuntimeError("a repeated run changed the index")
    return finish(table.read())


@query("timeseries_index_replace", ops=("SNK6", "GEN3", "PRJ21"), sql=_INTERVALS_SQL + f""",
k AS (SELECT interval_id, CASE WHEN o_custkey % 3 = 0 THEN n + 1 ELSE n END AS n, start_ds,
             CASE WHEN o_custkey % 3 = 0 THEN start_ds + INTERVAL 2 HOUR ELSE end_ds END AS end_ds FROM r),
e AS (SELECT interval_id, n, unnest(generate_series(start_ds, end_ds, INTERVAL 1 HOUR)) AS ts FROM k)
SELECT interval_id, cast(n AS bigint) AS count, ts, 'adjusted' AS type, strftime(ts, '%Y-%m') AS month,
       interval_id || '_adjusted_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '_{ENV}' AS id FROM e""")
def timeseries_index_replace(spark, sf_dir):
    """Intervals as hourly rows; a later run's shorter intervals replace all rows of theirs in one commit."""
    t = Tables(spark, sf_dir)
    recs = customer_intervals(t)
    rows = lambda r: de.expand_intervals(r, 3600, kind="adjusted", env=ENV).withColumn("month", year_month("ts"))
    table = PublishedTable(spark, scratch_path(spark, "timeseries"), ["id"])
    table.replace(rows(recs), ["interval_id", "type"])
    shorter = recs.where(F.col("o_custkey") % 3 == 0).withColumns(
        {"n_tasks": F.col("n_tasks") + 1, "end_ds": F.col("start_ds") + F.make_dt_interval(hours=F.lit(2))})
    table.replace(rows(shorter), ["interval_id", "type"])
    return finish(table.read())


@query("forecast_index_published", ops=("SNK7", "PRJ20", "FIL16"), sql=ctes("series", extra={
    "a": "SELECT *, 1 AS run FROM series WHERE ts < TIMESTAMP '2024-01-25'",
    "b": "SELECT *, 2 AS run FROM series WHERE ts >= TIMESTAMP '2024-01-20'",
    "u": """SELECT *, min(ts) OVER (PARTITION BY series_id, run) AS series_start FROM (SELECT * FROM a UNION ALL SELECT * FROM b) x"""}) + f"""
SELECT series_id, ts, round(value * run, 6) AS value, '{ENV}' AS env, 'eu' AS region, 'svc' AS service, series_start,
       strftime(series_start, '%Y-%m-%dT%H:%M:%S') || '_svc_eu_' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '_{ENV}' AS id, '2024-01' AS month
FROM u""")
def forecast_index_published(spark, sf_dir):
    """Two forecast runs tagged and upserted into the processing month; a run keeps its own series start."""
    t = Tables(spark, sf_dir)
    s = cal_ops.guard(t.series, t.series.agg(F.max("ts")).scalar() >= F.lit("2024-01-27").cast("timestamp"), "the throughput history is stale")
    table = PublishedTable(spark, scratch_path(spark, "forecasts"), ["series_id", "id"])
    for run, part in ((1, s.where("ts < '2024-01-25'")), (2, s.where("ts >= '2024-01-20'"))):
        tagged = de.tag_forecast(part.withColumn("value", F.col("value") * run), env=ENV, region="eu", service="svc", keys=["series_id"])
        table.upsert(tagged.withColumn("month", F.lit("2024-01")))
    return finish(table.read())


#: Runs: name, time, approved, how far predictions are off.
RUNS = (("r1", "2024-01-01", True, 1), ("r2", "2024-01-02", True, 2), ("r3", "2024-01-03", False, 8), ("r2", "2024-01-02", True, 2))
_RUNS_SQL = """
WITH runs AS (SELECT * FROM (VALUES ('r1', TIMESTAMP '2024-01-01', true, 1), ('r2', TIMESTAMP '2024-01-02', true, 2),
                                    ('r3', TIMESTAMP '2024-01-03', false, 8)) x(run_id, created_at, approved, k)),
s AS (SELECT run_id, created_at, approved, l_returnflag AS model, l_extendedprice AS y, l_extendedprice * (1 - l_discount * k / 8) AS yhat
      FROM lineitem, runs),
h AS (SELECT run_id, created_at, approved, model, round(avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END), 10) AS mape,
             round(avg(CASE WHEN y > 0 THEN abs(yhat - y) / ((y + yhat) / 2) END), 10) AS smape FROM s GROUP BY 1, 2, 3, 4)"""


def published_history(t: Tables):
    """Three evaluation runs, one repeated, reported and appended to a metrics history."""
    root = scratch_path(t.spark, "metrics-history")
    table = hi.metrics_history(t.spark, f"{root}/history")
    versions = []
    for i, (run, at, approved, k) in enumerate(RUNS):
        li = t.lineitem
        scored = li.select(F.col("l_returnflag").alias("model"), F.col("l_extendedprice").alias("y"),
                           (F.col("l_extendedprice") * (1 - F.col("l_discount") * k / 8)).alias("yhat"))
        versions.append(hi.append_run(table, met.regression_metrics(scored, ["model"]), run, at, approved, f"{root}/report-{i}"))
    if versions[-1] != versions[-2]:
        raise RuntimeError("a repeated run changed the history")
    return table.read()


@query("metric_runs_alerts", ops=("SNK8", "AGG11", "AGG8"), sql=_RUNS_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY created_at DESC) AS rn FROM h),
p AS (SELECT model, avg(mape) AS history_mean, count(*) AS history_n FROM r WHERE rn > 1 AND approved GROUP BY model)
SELECT r.model, r.created_at AS last_update, round(r.mape, 6) AS current, round(p.history_mean, 6) AS history_mean, p.history_n,
       cast(p.history_mean < r.mape AND r.mape / p.history_mean > 2 AS bigint) AS accuracy_alert,
       cast(epoch(TIMESTAMP '2024-01-04') - epoch(r.created_at) > 2 * 86400 AS bigint) AS stale_alert
FROM r JOIN p USING (model) WHERE rn = 1""")
def metric_runs_alerts(spark, sf_dir):
    """Alerts from the published metrics history: the newest run against the approved ones before it."""
    t = Tables(spark, sf_dir)
    return finish(met.accuracy_alerts(published_history(t), ["model"], now="2024-01-04"))


@query("metric_runs_choice", ops=("ML8", "SNK8"), sql=_RUNS_SQL + """
SELECT run_id, arg_min(model, (smape, model)) AS chosen_model, round(min(smape), 6) AS chosen_smape FROM h WHERE smape <= 0.0131 GROUP BY run_id""")
def metric_runs_choice(spark, sf_dir):
    """Per published run, the model of lowest sMAPE within the threshold; runs without one drop out."""
    t = Tables(spark, sf_dir)
    return finish(met.choose_model(published_history(t), ["run_id"], threshold=0.0131))


@query("dated_files_latest", ops=("SRC8",), sql="""
SELECT o_orderkey AS id, o_orderpriority AS priority,
       round(cast(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 2 WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS double), 6) AS price
FROM orders""")
def dated_files_latest(spark, sf_dir):
    """Three dated folders with overlapping keys; the newest file's row counts."""
    t = Tables(spark, sf_dir)
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"))
    root = scratch_path(spark, "dated-files")
    for i, part in enumerate((o, o.where("id % 2 = 0"), o.where("id % 3 = 0"))):
        part.withColumn("price", F.col("price") + i).write.parquet(f"{root}/2024/01/{i + 1:02d}")
    files = spark.read.schema(o.schema).option("recursiveFileLookup", "true").parquet(root)
    return finish(src.latest_per_file_key(files, "id"))


@query("model_dictionary_lookup", ops=("SRC9",), sql="""
SELECT o_orderkey AS id, 'svc' || (o_custkey % 7) AS service, o_orderpriority AS kind,
       CASE WHEN o_custkey % 7 < 5 THEN CASE WHEN o_orderpriority LIKE '1-%' THEN 'm' || (o_custkey % 7) || '-urgent' ELSE 'm' || (o_custkey % 7) END
            WHEN o_orderpriority LIKE '1-%' THEN 'any-urgent' ELSE 'any' END AS model
FROM orders""")
def model_dictionary_lookup(spark, sf_dir):
    """A JSON dictionary service -> kind -> model; unknown kinds and services take their defaults."""
    t = Tables(spark, sf_dir)
    urgent = t.orders.where(F.col("o_orderpriority").startswith("1-")).select("o_orderpriority").distinct()
    k = F.col("r_regionkey").cast("string")
    own = t.region.select(F.concat(F.lit("svc"), k).alias("service"), F.concat(F.lit("m"), k).alias("base"))
    own = own.unionByName(spark.range(1).select(F.lit("default").alias("service"), F.lit("any").alias("base")))
    models = F.map_from_arrays(F.array("o_orderpriority", F.lit("default")), F.array(F.concat("base", F.lit("-urgent")), "base"))
    path = scratch_path(spark, "dictionary")
    own.join(urgent, F.lit(True), "left").select("service", models.alias("models")).write.json(path)
    said = src.read_json_dictionary(spark, path, "service string, models map<string,string>")
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("svc"), (F.col("o_custkey") % 7).cast("string")).alias("service"),
                        F.col("o_orderpriority").alias("kind"))
    return finish(src.nested_lookup(o, said, "service", "kind", "model"))


@query("asof_recommendations_json", ops=("SRC5", "SRC4"), sql=_INTERVALS_SQL + """,
b AS (SELECT max(d) AS d FROM r WHERE d <= DATE '1999-03-17' AND d > DATE '1999-03-10')
SELECT interval_id, service, start_ds, end_ds, cast(n AS bigint) AS n_tasks, r.d AS day FROM r, b WHERE r.d = b.d""")
def asof_recommendations_json(spark, sf_dir):
    """JSON recommendations in dated folders: those of the newest day up to a date, a week back at most."""
    t = Tables(spark, sf_dir)
    recs = customer_intervals(t).drop("o_custkey").withColumn("day", F.to_date("start_ds"))
    root = write_dated(recs, scratch_path(spark, "json-recommendations"), date_col="day", fmt="json")
    dated = src.read_recommendations(spark, root, "day")
    return finish(asof.asof_partition(dated, "day", "1999-03-17", min_exclusive="1999-03-10"))
