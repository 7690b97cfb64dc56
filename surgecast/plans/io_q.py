"""Read / write round trips and small projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.functions import text as tx
from surgecast.operators import boosting as bo
from surgecast.operators import enrich
from surgecast.operators import features as fe
from surgecast.operators import models as mdl
from surgecast.operators import registry as reg
from surgecast.plans.decide_q import _recs
from surgecast.plans.features_q import feature_frame
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.operators.metrics import regression_metrics
from surgecast.plans.features_q import ENC_COLS, PRED_DATE
from surgecast.session import materialize
from surgecast.sinks import files as sk
from surgecast.sources import files as src
from surgecast.sources.tables import Tables


@query("partitioned_watch_scan", ops=("SRC1", "SNK4"), sql=ctes("watch_traffic") + """
SELECT id, sport, league, starttime, cast(cnt AS bigint) AS cnt, cast(2024 AS bigint) AS year, sport || '/' || league AS sport_league
FROM watch_traffic WHERE sport = 'click' AND league = 'L1'""")
def partitioned_watch_scan(spark, sf_dir):
    """Watch traffic written partitioned by year/sport/league, read back with partition pruning."""
    t = Tables(spark, sf_dir)
    wt = t.watch_traffic.withColumns({"year": F.year("starttime"), "sport_partition": F.col("sport"),
                                      "league_partition": F.col("league"), "client_app": F.lit("web")})
    root = sk.scratch_path(spark, "watch")
    wt.write.mode("overwrite").partitionBy("year", "sport_partition", "league_partition").parquet(root)
    return finish(src.watch_traffic_scan(spark, root, sport="click", league="L1", client="web"))


TRAFFIC_SCHEMA = T.StructType([T.StructField("datetime", T.TimestampType()), T.StructField("count", T.DoubleType()),
                               T.StructField("ingest_date", T.StringType())])


@query("csv_traffic_roundtrip", ops=("SNK1", "SRC2", "SRC3", "SRC7", "PRJ1", "PRJ31", "FIL1"), sql=ctes("service_traffic") + """
SELECT datetime, round(service_count, 6) AS service_count, cast(year(datetime) AS bigint) AS year, cast(month(datetime) AS bigint) AS month,
       cast(day(datetime) AS bigint) AS day, cast(hour(datetime) AS bigint) AS hour, cast(minute(datetime) AS bigint) AS minute
FROM service_traffic WHERE datetime >= (SELECT max(datetime) FROM service_traffic) - INTERVAL 10 DAY""")
def csv_traffic_roundtrip(spark, sf_dir):
    """Hourly traffic written as daily CSV files, read back as one union, 10-day history."""
    t = Tables(spark, sf_dir)
    st = t.service_traffic.select("datetime", F.col("service_count").alias("count"),
                                  F.date_format("datetime", "yyyy-MM-dd").alias("ingest_date"))
    root = sk.scratch_path(spark, "traffic")
    sk.save_processed(st.withColumn("part", F.col("ingest_date")), root, header=True, exclude=["part"])
    back = src.csv_union(spark, f"{root}/*.csv", TRAFFIC_SCHEMA, header=True)
    out = src.traffic_scan(back, history_days=10, rename={"count": "service_count", "missing_col": "x"})
    return finish(out)


@query("snapshot_schema_evolution", ops=("SNK3", "SET4", "SNK2"), sql=ctes("calendar") + """
SELECT id, sport, date_utc, CASE WHEN id % 2 = 0 THEN league END AS league, 'svc0' AS service, '2024-01-20' AS prediction_date
FROM calendar""")
def snapshot_schema_evolution(spark, sf_dir):
    """Two snapshot appends, the second with an added column; read back with merged schema."""
    t = Tables(spark, sf_dir)
    cal = t.calendar.select("id", "sport", "date_utc", "league")
    root = sk.scratch_path(spark, "snap")
    first = cal.where(F.col("id") % 2 == 1).drop("league").withColumns(
        {"prediction_date": F.lit("2024-01-20"), "service": F.lit("svc0"), "region": F.lit("EU")})
    second = cal.where(F.col("id") % 2 == 0).withColumns(
        {"prediction_date": F.lit("2024-01-20"), "service": F.lit("svc0"), "region": F.lit("EU")})
    added = fe.new_columns(first, second)
    assert added == [("league", "string")], added
    sk.append_snapshot(first, root)
    sk.append_snapshot(second, root)
    sk.save_feature_names(second, sk.scratch_path(spark, "names"), exclude=["id"])
    back = sk.read_snapshots(spark, root)
    return finish(back.select("id", "sport", "date_utc", "league", "service", "prediction_date"))


@query("calendar_misc_projections", ops=("PRJ29", "PRJ19", "PRJ31", "FIL8", "PRJ8"), sql=ctes("calendar") + """
SELECT id, name, cast(id % 2 = 0 AS bigint) AS division_competition, cast(id % 3 = 0 AS bigint) AS conference_competition,
       cast(id % 5 = 0 AS bigint) AS on_watch_espn,
       '{"division_competition":' || CASE WHEN id % 2 = 0 THEN 'true' ELSE 'false' END ||
       ',"conference_competition":' || CASE WHEN id % 3 = 0 THEN 'true' ELSE 'false' END ||
       ',"on_watch_espn":' || CASE WHEN id % 5 = 0 THEN 'true' ELSE 'false' END || '}' AS competition_cl,
       array_to_string(string_split(replace(coalesce(media, 'media_unknown'), '|', ','), ','), ',') AS media_text
FROM calendar
WHERE date_utc > TIMESTAMP '2024-01-05' + INTERVAL 6 DAY AND date_utc < TIMESTAMP '2024-01-05' + INTERVAL 11 DAY AND id IS NOT NULL""")
def calendar_misc_projections(spark, sf_dir):
    """Competition JSON expanded to int flags, arrays cast to text, open ingest window."""
    t = Tables(spark, sf_dir)
    cal = t.calendar
    comp = F.to_json(F.array(F.struct((F.col("id") % 2 == 0).alias("division_competition"),
                                      (F.col("id") % 3 == 0).alias("conference_competition"),
                                      (F.col("id") % 5 == 0).alias("on_watch_espn"))))
    cal = cal.withColumn("competitions", comp)
    schema = "array<struct<division_competition:boolean,conference_competition:boolean,on_watch_espn:boolean>>"
    ing = F.lit("2024-01-05").cast("timestamp")
    win = cal.where((F.col("date_utc") > ing + F.make_dt_interval(days=F.lit(6)))
                    & (F.col("date_utc") < ing + F.make_dt_interval(days=F.lit(11))) & F.col("id").isNotNull())
    ex = win.select("*", F.explode_outer(F.from_json("competitions", schema)).alias("c"))
    ex = ex.withColumn("competition_cl", F.to_json("c")).select("*", "c.*").drop("c", "competitions")
    ex = ex.withColumns({c: F.col(c).cast("int") for c in ["division_competition", "conference_competition", "on_watch_espn"]})
    ex = ex.withColumn("media_text", tx.media_list("media"))
    ex = sk.cast_objects_to_string(ex.select("id", "name", "division_competition", "conference_competition", "on_watch_espn",
                                             "competition_cl", "media_text", "venue"))
    return finish(ex.drop("venue", "not_there"))


@query("recommendations_service_info", ops=("JON12", "FIL12", "SRC9"), sql=ctes("series", "service_info", extra={
    "w": "SELECT series_id, cast(ts AS date) AS d FROM series WHERE hour(ts) BETWEEN 18 AND 22 GROUP BY 1, 2",
    "r": """SELECT series_id || '_' || strftime(d, '%Y-%m-%d') AS interval_id, 'svc' || cast(length(series_id) % 5 AS varchar) AS service,
                   'AFRICA' AS region, series_id FROM w"""}) + """
SELECT r.interval_id, r.service, r.region, i.account_id, i.cluster_name,
       coalesce(CASE r.series_id WHEN 'click' THEN 'model-a' WHEN 'view' THEN 'model-b' END, 'default-model') AS model
FROM r LEFT JOIN service_info i ON i.service = r.service AND i.region = r.region WHERE i.account_id IS NOT NULL""")
def recommendations_service_info(spark, sf_dir):
    """Recommendations joined with service account info; rows without an account dropped; model by dictionary with default."""
    t = Tables(spark, sf_dir)
    orig, _ = _recs(t)
    r = orig.select("interval_id", "series_id", F.concat(F.lit("svc"), (F.length("series_id") % 5).cast("string")).alias("service"),
                    F.lit("AFRICA").alias("region"))
    r = enrich.add_service_info(r, t.service_info).where(F.col("account_id").isNotNull())
    models = F.create_map(F.lit("click"), F.lit("model-a"), F.lit("view"), F.lit("model-b"), F.lit("default"), F.lit("default-model"))
    r = r.withColumn("model", src.dictionary_lookup(models, F.col("series_id")))
    return finish(r.select("interval_id", "service", "region", "account_id", "cluster_name", "model"))


@query("accent_strip_documents", ops=("PRJ10",), sql="""
SELECT doc_id, lang, cast(length(strip_accents(text)) AS bigint) AS n_chars_plain, sha256(strip_accents(text)) AS plain_sha
FROM documents""")
def accent_strip_documents(spark, sf_dir):
    """Accents removed from whole document texts (canonical decomposition, marks dropped)."""
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", tx.strip_accents(F.col("text")).alias("plain"))
    return finish(d.select("doc_id", "lang", F.length("plain").alias("n_chars_plain"), F.sha2("plain", 256).alias("plain_sha")))


@query("model_train_predict", ops=("ML5", "ML6", "ML7", "JON15", "SNK10", "AGG8"))
def model_train_predict(spark, sf_dir):
    """The reference's first boosted model and a linear model, registered with vocabulary
    and scaler; the newest approved versions, read back, score the later events."""
    t = Tables(spark, sf_dir)
    f = materialize(feature_frame(t).where(F.col("y").isNotNull()).withColumn("ds", F.col("date_utc")))
    f = f.fillna(0, subset=["n_tasks"])  # no task count at that time: 0 (no row is dropped)
    split = F.col("date_utc") < F.lit(PRED_DATE).cast("timestamp")
    train, test = f.where(split), f.where(~split)
    vocab, scaler = fe.fit_vocabulary(train, ENC_COLS), reg.fit_scaler(train, ["n_tasks"])
    feats = [fe._name(c, v) for c, cats in vocab.items() for v in cats] + ["n_tasks"]
    encoded = reg.Artefacts(0, None, vocab, scaler).encode(train)
    encoded = materialize(encoded.withColumn("weight", F.coalesce(F.sqrt(F.greatest("y", F.lit(0.0))), F.lit(0.0)) + 1e-3))
    models = reg.ModelRegistry(spark, sk.scratch_path(spark, "model-versions"))
    models.register("linear", mdl.fit(mdl.linear_model(feats), encoded), vocab, scaler, "2024-01-20", reg.APPROVED)
    models.register("linear", mdl.fit(mdl.linear_model(["n_tasks"]), encoded), {}, scaler, "2024-01-21")  # not approved: passed over
    models.register("gbt", bo.fit(encoded, feats, bo.FIRST_MODEL, weight="weight", key=["sport", "id"]), vocab, scaler, "2024-01-20", reg.APPROVED)
    out = None
    for group in ("gbt", "linear"):
        scored = reg.score_newest(models, group, test, ("id", "ds", "y")).withColumn("model", F.lit(group))
        out = scored if out is None else out.unionByName(scored)
    return finish(regression_metrics(out, ["model"]))
