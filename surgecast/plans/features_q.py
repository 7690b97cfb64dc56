"""F2 queries: feature snapshot read-back, encodings, scaling and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.functions import text as tx
from surgecast.functions.scalar import sample_weight
from surgecast.functions.timeparts import hour_class
from surgecast.operators import calendar as cal_ops
from surgecast.operators import enrich
from surgecast.operators import features as fe
from surgecast.plans.attribution import ATTR_CTES, ATTR_VIEWS
from surgecast.plans.events import GRAIN, QCAL, _attributed
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.sinks.files import append_snapshot, read_snapshots, scratch_path
from surgecast.session import materialize
from surgecast.sources.tables import Tables

PRED_DATE = "2024-01-20"
TARGET = "event_count_on_service_extra_traffic_scale"

TARGET_CTES = {**ATTR_CTES, **QCAL, "pe_max": """
    SELECT a.sport, a.event_id AS id, max(a.s2) AS tgt, max(a.service_count) AS svc
    FROM attributed a JOIN grid g ON a.sport = g.sport AND a.event_id = g.id AND a.event_time = g.event_time
    GROUP BY a.sport, a.event_id"""}


def event_rows(t: Tables):
    """Training rows (events with a target) and prediction rows (events in the horizon)."""
    calq = cal_ops.quantize_calendar(t.calendar, grain_seconds=GRAIN)
    train = cal_ops.event_targets(_attributed(t), calq).select(
        "sport", "id", "date_utc", F.col(TARGET).alias("y"), "service_count", F.lit("training").alias("data_type"))
    fut = cal_ops.future_events(t.calendar, PRED_DATE, 5).select(
        "sport", "id", "date_utc", "y", "service_count", F.lit("prediction").alias("data_type"))
    return train.unionByName(fut)


@query("snapshot_latest", ops=("SNK3", "PRJ20", "SRC10", "FIL18", "AGG13", "PRJ17", "ML4", "PRJ32"),
       sql=ctes(*ATTR_VIEWS, "calendar", extra={**TARGET_CTES,
           "base": f"""SELECT c.sport, c.id, c.date_utc, p.tgt AS y, p.svc AS service_count, 'training' AS data_type
                       FROM pe_max p JOIN calq c ON c.sport = p.sport AND c.id = p.id
                       UNION ALL
                       SELECT sport, id, date_utc, -1.0E0, -1.0E0, 'prediction' FROM calendar
                       WHERE date_utc >= TIMESTAMP '{PRED_DATE}' AND date_utc < TIMESTAMP '{PRED_DATE}' + INTERVAL 5 DAY""",
           "snap": f"""SELECT *, '2024-01-19 00:00:00' AS eventtime, 'svc0' AS service, false AS is_deleted FROM base
                       UNION ALL SELECT *, '2024-01-20 00:00:00', 'svc0', id % 7 = 0 FROM base WHERE date_utc < TIMESTAMP '2024-01-26'
                       UNION ALL SELECT *, '2024-01-21 00:00:00', 'svc1', false FROM base""",
           "latest": """SELECT DISTINCT sport, id, date_utc, y, service_count, data_type FROM snap
                        WHERE service = 'svc0' AND NOT is_deleted
                          AND eventtime = (SELECT max(eventtime) FROM snap WHERE service = 'svc0')""",
           "vs": f"""SELECT min(date_utc) AS start_val FROM (SELECT date_utc FROM latest
                     WHERE data_type = 'training' AND date_utc < TIMESTAMP '{PRED_DATE}' ORDER BY date_utc DESC LIMIT 10) x"""})
       + f"""SELECT sport, id, date_utc, round(y, 6) AS y, round(CASE WHEN y >= 0 THEN sqrt(y) END, 6) AS weight,
                    round(service_count, 6) AS service_count, data_type,
                    CASE WHEN date_utc < start_val THEN 'train' WHEN date_utc < TIMESTAMP '{PRED_DATE}' THEN 'val' ELSE 'test' END AS split
             FROM latest, vs""")
def snapshot_latest(spark, sf_dir):
    """Three snapshot writes; read back the newest for one service; weights and train/val/test labels."""
    t = Tables(spark, sf_dir)
    base = event_rows(t)
    tags = dict(prediction_date=PRED_DATE, region="AFRICA")
    s1 = fe.tag_snapshot(base, event_time="2024-01-19 00:00:00", service="svc0", **tags)
    s2 = fe.tag_snapshot(base.where(F.col("date_utc") < F.lit("2024-01-26").cast("timestamp")),
                         event_time="2024-01-20 00:00:00", service="svc0", **tags).withColumn("is_deleted", F.col("id") % 7 == 0)
    s3 = fe.tag_snapshot(base, event_time="2024-01-21 00:00:00", service="svc1", **tags)
    root = scratch_path(spark, "feature-store")
    for snap in (s1, s2, s3):
        append_snapshot(snap, root)
    latest = fe.latest_snapshot(read_snapshots(spark, root), PRED_DATE, "svc0", "AFRICA")
    train = latest.where(F.col("data_type") == "training")
    start_val = fe.validation_start(train, "date_utc", PRED_DATE, 10)
    out = latest.withColumns({
        "weight": sample_weight("y"),
        "split": fe.split_label("date_utc", start_val, F.lit(PRED_DATE).cast("timestamp")),
    })
    return finish(out.select("sport", "id", "date_utc", "y", "weight", "service_count", "data_type", "split"))


ENC_COLS = ["league", "day", "hour_encoded", "media"]
TEAM_COLS = ["team_0_display_name", "team_1_display_name"]

# Categories present in the sf0.01 calendar (the Spark side fits them from data).
SQL_VOCAB = {
    "league": ["L0", "L1", "L2", "L3"],
    "day": list(range(7)),
    "hour_encoded": [0, 1, 2],
    "media": ["A,B", "A,C", "B", "media_unknown"],
}
SQL_TEAMS = sorted(f"NATION_{i}" for i in range(25))


def feature_frame(t: Tables):
    cal = t.calendar
    calq = cal_ops.quantize_calendar(cal, grain_seconds=GRAIN).drop("filler")
    calq = enrich.join_task_counts(calq, t.scheduled_tasks, ts="start_quantized")
    feats = calq.select(
        "sport", "id", "date_utc", "league", F.weekday("date_utc").alias("day"),
        hour_class("date_utc").alias("hour_encoded"), tx.media_key("media").alias("media"), *TEAM_COLS, "n_tasks",
    )
    targets = cal_ops.event_targets(_attributed(t), cal_ops.quantize_calendar(cal, grain_seconds=GRAIN)).select(
        "sport", "id", F.col(TARGET).alias("y"))
    return feats.join(targets, ["sport", "id"], "left")


def _enc_sql() -> str:
    onehot = []
    for c, cats in SQL_VOCAB.items():
        for v in cats:
            lit = f"'{v}'" if isinstance(v, str) else str(v)
            onehot.append(f"CASE WHEN {c} = {lit} THEN 1.0E0 ELSE 0.0E0 END AS \"{c}_{v}\"")
    teams = [
        f"cast((coalesce(team_0_display_name, 'Unknown_competitor') = '{n}') AS bigint) + "
        f"cast((coalesce(team_1_display_name, 'Unknown_competitor') = '{n}') AS bigint) AS \"team_{n}\""
        for n in SQL_TEAMS
    ]
    return ctes(*ATTR_VIEWS, "calendar", "scheduled_tasks", extra={**TARGET_CTES,
        "f": """SELECT c.sport, c.id, c.date_utc, c.league, isodow(c.date_utc) - 1 AS day,
                       CASE WHEN hour(c.date_utc) BETWEEN 17 AND 21 THEN 1 WHEN hour(c.date_utc) >= 22 OR hour(c.date_utc) < 5 THEN 2 ELSE 0 END AS hour_encoded,
                       array_to_string(string_split(replace(coalesce(c.media, 'media_unknown'), '|', ','), ','), ',') AS media,
                       c.team_0_display_name, c.team_1_display_name, t.n_tasks, p.tgt AS y
                FROM calq c LEFT JOIN scheduled_tasks t ON t.datetime = c.start_quantized
                LEFT JOIN pe_max p ON p.sport = c.sport AND p.id = c.id""",
        "vs": f"""SELECT min(date_utc) AS start_val FROM (SELECT date_utc FROM f
                  WHERE y IS NOT NULL AND date_utc < TIMESTAMP '{PRED_DATE}' ORDER BY date_utc DESC LIMIT 10) x""",
        "sp": f"""SELECT f.*, CASE WHEN date_utc < start_val THEN 'train' WHEN date_utc < TIMESTAMP '{PRED_DATE}' THEN 'val' ELSE 'test' END AS split
                  FROM f, vs""",
        "st": "SELECT avg(n_tasks) AS mu, stddev_pop(n_tasks) AS sd FROM sp WHERE split = 'train'",
    }) + f"""SELECT round(y, 6) AS y, round(CASE WHEN y >= 0 THEN sqrt(y) END, 6) AS weight,
       {', '.join(onehot)}, {', '.join(teams)},
       round(CASE WHEN sd = 0 THEN n_tasks - mu ELSE (n_tasks - mu) / sd END, 6) AS n_tasks, id, date_utc AS ds, split
FROM sp, st"""


@query("encoded_features", ops=("AGG12", "FIL19", "ML1", "ML2", "ML3", "ML4", "PRJ17", "PRJ18", "JON7"), sql=_enc_sql())
def encoded_features(spark, sf_dir):
    """One-hot league/weekday/hour class/media, multi-hot teams, scaled task count, split labels."""
    t = Tables(spark, sf_dir)
    # one row per calendar event; materialised once, then vocabularies, the
    # validation start and the scaler statistics all read the checkpoint
    f = materialize(feature_frame(t))
    labelled = f.where(F.col("y").isNotNull())
    cal_cut = f.where(F.col("date_utc") >= labelled.agg(F.min("date_utc")).scalar())
    vocab = fe.fit_vocabulary(cal_cut, ENC_COLS)
    teams = fe.fit_competitors(cal_cut, TEAM_COLS)
    start_val = fe.validation_start(labelled, "date_utc", PRED_DATE, 10)
    f = f.withColumn("split", fe.split_label("date_utc", start_val, F.lit(PRED_DATE).cast("timestamp")))
    f = fe.multi_hot(fe.one_hot(f, vocab), TEAM_COLS, teams)
    f = fe.standard_scale(f, ["n_tasks"], fit_on=F.col("split") == "train")
    features = [fe._name(c, v) for c, cats in vocab.items() for v in cats] + [f"team_{n}" for n in teams] + ["n_tasks"]
    out = fe.select_model_features(f.withColumn("weight", sample_weight("y")), ["weight", *features, "split"], "y", "date_utc")
    return finish(out)
