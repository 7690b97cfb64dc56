"""Published tables: what a write touches, what readers see when one fails, versions of models and metrics."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from surgecast.operators import calendar as cal_ops
from surgecast.operators import models as mdl
from surgecast.operators import registry as reg
from surgecast.sinks import history as hi
from surgecast.sinks.files import scratch_path
from surgecast.sinks.tables import PublishedTable

KIND = "id string, month string, interval_id string, type string, v int"


def table(spark, name="t"):
    return PublishedTable(spark, scratch_path(spark, name), ["id"])


def rows(t, cols=("id", "month", "v")):
    return sorted((tuple(r[c] for c in cols) for r in t.read().collect()), key=str)


def files(t):
    """Data files that the newest version lists, with size and time of change."""
    root = t.root.removeprefix("file:")
    out = {}
    for part, folder in t.version().folders.items():
        at = os.path.join(root, folder)
        out[part] = sorted((f, os.stat(os.path.join(at, f)).st_size, os.stat(os.path.join(at, f)).st_mtime_ns) for f in os.listdir(at) if f.endswith(".parquet"))
        out[part] = (folder, out[part])
    return out


def test_upsert_rewrites_touched_months_only(spark):
    t = table(spark)
    df = lambda *r: spark.createDataFrame(list(r), "id string, month string, v int")
    with pytest.raises(ValueError, match="no published version"):
        t.read()
    assert t.upsert(df(("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-03", 3))).number == 1
    before = files(t)
    assert t.upsert(df(("b", "2024-02", 20), ("d", "2024-02", 4), ("c", "2024-03", 3), ("e", "2024-04", 5))).number == 2
    assert rows(t) == [("a", "2024-01", 1), ("b", "2024-02", 20), ("c", "2024-03", 3), ("d", "2024-02", 4), ("e", "2024-04", 5)]
    after = files(t)
    assert after["2024-01"] == before["2024-01"] and after["2024-03"] == before["2024-03"]  # c came, but unchanged
    assert after["2024-02"] != before["2024-02"] and sorted(after) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert t.upsert(df(("b", "2024-02", 20), ("e", "2024-04", 5))).number == 2 and files(t) == after
    assert sorted(r.id for r in t.read(["2024-02"]).collect()) == ["b", "d"]
    assert t.upsert(df().limit(0)).number == 2


def test_upsert_of_nulls_repeats_ties_and_new_columns(spark):
    t = table(spark)
    t.upsert(spark.createDataFrame([(None, None, 1), (None, None, 2), ("a", "x/y=z", 3), ("a", "x/y=z", 3)], "id string, month string, v int"))
    assert rows(t) == [("a", "x/y=z", 3), (None, None, 2)]
    newest = spark.createDataFrame([("a", "x/y=z", 1, 5.0, "m"), ("a", "x/y=z", 9, 1.0, "n")], "id string, month string, v int, at double, _part0 string")
    t.upsert(newest, order=["at"])
    assert rows(t, ("id", "v", "at")) == [("a", 1, 5.0), (None, 2, None)]
    t.upsert(spark.createDataFrame([(None, None)], "id string, month string"))
    assert rows(t, ("id", "v")) == [("a", 1), (None, None)]


def test_replace_is_one_commit(spark, monkeypatch):
    t = table(spark)
    t.replace(spark.createDataFrame([(f"{i}{m}", m, i, "n", 1) for m in ("2024-01", "2024-02") for i in "ijk"], KIND), ["interval_id", "type"])
    old = rows(t)
    new = spark.createDataFrame([("i-new", "2024-02", "i", "n", 7), ("j-new", "2024-03", "j", "other", 8)], KIND)

    def fail(self, base, schema, folders):
        raise OSError("lost before publishing")

    with monkeypatch.context() as m:
        m.setattr(PublishedTable, "_publish", fail)
        with pytest.raises(OSError):
            t.replace(new, ["interval_id", "type"])
    assert rows(t) == old and t.version().number == 1  # the new files exist, but no version lists them
    seen = t.version()
    t.replace(new, ["interval_id", "type"])
    assert rows(t) == [("i-new", "2024-02", 7), ("j-new", "2024-03", 8), ("j2024-01", "2024-01", 1), ("j2024-02", "2024-02", 1), ("k2024-01", "2024-01", 1), ("k2024-02", "2024-02", 1)]
    assert sorted(r.id for r in t.read(version=seen).collect()) == sorted(r[0] for r in old)  # a reader of the old version still can
    gone = t.replace(new.where("id = 'j-new'").withColumn("month", F.lit("2024-05")), ["interval_id", "type"])
    assert "2024-03" not in gone.folders and "2024-05" in gone.folders


def test_second_writer_of_a_version_fails(spark):
    t = table(spark)
    t.upsert(spark.createDataFrame([("a", "2024-01", 1)], "id string, month string, v int"))
    base = t.version()
    t.upsert(spark.createDataFrame([("a", "2024-01", 2)], "id string, month string, v int"))
    with pytest.raises(RuntimeError, match="another writer"):
        t._publish(base, base.schema, {})
    assert rows(t) == [("a", "2024-01", 2)]


def test_a_run_is_appended_once(spark):
    root = scratch_path(spark, "runs")
    table = hi.metrics_history(spark, f"{root}/h")
    m = lambda v: spark.createDataFrame([("x", v), ("y", 2 * v)], "model string, mape double")
    assert hi.append_run(table, m(0.1), "r1", "2024-01-01", True, f"{root}/1") == 1
    assert hi.append_run(table, m(0.3), "r2", "2024-01-02", False, f"{root}/2") == 2
    assert hi.append_run(table, m(0.1), "r1", "2024-01-01", True, f"{root}/3") == 2
    assert hi.decide_run(table, "r2", True) == 3
    got = sorted((r.run_id, r.model, r.mape, r.approved) for r in table.read().collect())
    assert got == [("r1", "x", 0.1, True), ("r1", "y", 0.2, True), ("r2", "x", 0.3, True), ("r2", "y", 0.6, True)]


def test_newest_approved_version_scores_from_its_folder(spark):
    df = spark.createDataFrame([(i, datetime(2024, 1, 1), "ab"[i % 2], float(i), 3.0 * (i % 2) + i) for i in range(40)], "id int, ds timestamp, kind string, x double, y double")
    r = reg.ModelRegistry(spark, scratch_path(spark, "models"))
    with pytest.raises(ValueError, match="no approved"):
        r.load("svc-eu")
    vocabulary, scaler = {"kind": ["a", "b"]}, reg.fit_scaler(df, ["x"])
    assert scaler == {"x": (19.5, pytest.approx(11.543, abs=1e-3))}
    own = reg.Artefacts(0, None, vocabulary, scaler)
    feats = ["kind_a", "kind_b", "x"]
    first = mdl.fit(mdl.linear_model(feats, weight=None), own.encode(df))
    assert r.register("svc-eu", first, vocabulary, scaler, "2024-01-01") == 1
    with pytest.raises(ValueError, match="no approved"):
        r.load("svc-eu")
    r.decide("svc-eu", 1, reg.APPROVED)
    other = mdl.fit(mdl.linear_model(["x"], weight=None), own.encode(df))
    assert r.register("svc-eu", other, {}, {}, "2024-01-02") == 2
    assert r.register("svc-us", other, {}, scaler, "2024-01-02", reg.APPROVED) == 1
    again = reg.ModelRegistry(spark.newSession(), r.root)
    new = again.spark.createDataFrame([(1, "b", 7.0), (2, "unknown", 7.0)], "id int, kind string, x double").withColumn("ds", F.lit("2024-02-01"))
    got = {x.id: (x.yhat, x.version) for x in reg.score_newest(again, "svc-eu", new).collect()}
    want = {x.id: x.yhat for x in mdl.score(first, own.encode(new.to(new.schema))).collect()}
    assert {k: v[0] for k, v in got.items()} == want and {v[1] for v in got.values()} == {1}
    assert got[1][0] == pytest.approx(10.0, abs=1e-6)
    with pytest.raises(ValueError, match="no version 5"):
        r.decide("svc-eu", 5, reg.APPROVED)


def test_guard_stops_the_run(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "a int, b int")
    assert cal_ops.guard(df, F.col("b") > 4, "too small").select("a").count() == 2
    with pytest.raises(Exception, match="too small"):
        cal_ops.guard(df, F.col("b") > 5, "too small").select("a").collect()
    with pytest.raises(Exception, match="stale"):
        cal_ops.guard(df, df.agg(F.max("a")).scalar() > F.lit(None), "stale").select("a").count()
