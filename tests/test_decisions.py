"""DEC1 / DEC2 branches on hand-made inputs (one key)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from surgecast.operators import decide as de

PT = datetime(2024, 1, 1, 0, 0)
REC_SCHEMA = ("k string, interval_id string, rec_order bigint, start_ds timestamp, end_ds timestamp, n_tasks bigint, "
              "max_tasks_timestamp timestamp, original_start_ds timestamp, original_end_ds timestamp, "
              "original_n_tasks bigint, metadata map<string,string>")


def _frames(spark, fc_value=150.0, pred_value=100.0, tasks=10, fc_values=None):
    times = [PT + timedelta(minutes=30 * i) for i in range(1, 7)]  # 00:30 .. 03:00
    vals = fc_values or [fc_value] * len(times)
    fc = spark.createDataFrame([("k", t, v) for t, v in zip(times, vals)], "k string, ts timestamp, count double")
    pred = spark.createDataFrame([("k", t, pred_value) for t in times], "k string, ts timestamp, count double")
    tk = spark.createDataFrame([("k", t, tasks) for t in times], "k string, ts timestamp, n_tasks bigint")
    return fc, pred, tk


def _recs(spark, rows):
    return spark.createDataFrame(rows, REC_SCHEMA)


def _rec(iid, start_h, end_h, n, mt_h=None, orig=(None, None, None), meta=None):
    s = PT + timedelta(hours=start_h)
    e = PT + timedelta(hours=end_h)
    mt = PT + timedelta(hours=mt_h if mt_h is not None else start_h)
    return ("k", iid, 0, s, e, n, mt, orig[0], orig[1], orig[2], meta or {"prediction_date": "2023-12-31"})


def decide(spark, fc, pred, tk, orig, adj):
    out = de.adjust_recommendations(fc, pred, tk, orig, adj, PT, ["k"]).collect()
    assert len(out) == 1
    return out[0]


def test_no_trigger_inside_thresholds(spark):
    fc, pred, tk = _frames(spark, fc_value=110.0)
    r = decide(spark, fc, pred, tk, _recs(spark, []), _recs(spark, []))
    assert r.action == "none" and r.diff == 10 and r.n_tasks is None


def test_new_recommendation_when_nothing_near(spark):
    fc, pred, tk = _frames(spark)
    r = decide(spark, fc, pred, tk, _recs(spark, []), _recs(spark, []))
    assert r.action == "new"
    assert r.n_tasks == 15 and r.start_ds == PT + timedelta(minutes=30) and r.end_ds == PT + timedelta(hours=3)
    assert r.metadata == {"prediction_date": "2024-01-02 00:00:00"}


def test_adjust_affected_original(spark):
    fc, pred, tk = _frames(spark)
    orig = _recs(spark, [_rec("a", 2, 6, 8)])
    r = decide(spark, fc, pred, tk, orig, _recs(spark, []))
    assert r.action == "adjust" and r.interval_id == "a"
    assert r.start_ds == PT + timedelta(minutes=30)  # least(t0, start)
    assert r.end_ds == PT + timedelta(hours=6)  # greatest(end, t1)
    assert (r.original_start_ds, r.original_end_ds, r.original_n_tasks) == (PT + timedelta(hours=2), PT + timedelta(hours=6), 8)
    assert r.metadata == {"prediction_date": "2024-01-01 00:00:00", "original_prediction_date": "2023-12-31"}


def test_close_after_counts_as_affected(spark):
    fc, pred, tk = _frames(spark)
    orig = _recs(spark, [_rec("later", 10, 12, 8), _rec("too_far", 19, 20, 8)])
    r = decide(spark, fc, pred, tk, orig, _recs(spark, []))
    assert r.action == "adjust" and r.interval_id == "later"


def test_early_start_moves_to_recommendation_start(spark):
    fc, pred, tk = _frames(spark)
    start = PT + timedelta(minutes=60)  # t0 = 00:30 is within one hour before it
    orig = _recs(spark, [("k", "e", 0, start, start + timedelta(hours=3), 8, start, None, None, None, {"prediction_date": "x"})])
    r = decide(spark, fc, pred, tk, orig, _recs(spark, []))
    assert r.action == "adjust" and r.start_ds == start


def test_readjust_with_null_originals(spark):
    fc, pred, tk = _frames(spark)
    adj = _recs(spark, [_rec("n1", 0, 2, 9, meta={"prediction_date": "p0", "original_prediction_date": "p-1"})])
    r = decide(spark, fc, pred, tk, _recs(spark, []), adj)
    assert r.action == "readjust" and r.interval_id == "n1"
    # least / greatest skip the null originals
    assert r.start_ds == PT + timedelta(minutes=30) and r.end_ds == PT + timedelta(hours=3)
    assert r.metadata == {"original_prediction_date": "p-1", "prediction_date": "2024-01-01 00:00:00"}


def test_small_change_is_suppressed(spark):
    fc, pred, tk = _frames(spark)
    orig = _recs(spark, [_rec("a", 1, 4, 14)])  # new 15 vs prev 14: +7% with a flat forecast
    r = decide(spark, fc, pred, tk, orig, _recs(spark, []))
    assert r.action == "none" and r.prev_n_tasks == 14


def test_downscale_before_max_reached_is_suppressed(spark):
    fc, pred, tk = _frames(spark, fc_value=50.0)
    orig = _recs(spark, [_rec("a", 1, 4, 30, mt_h=3)])  # t0 < max_tasks_timestamp, diff -50
    r = decide(spark, fc, pred, tk, orig, _recs(spark, []))
    assert r.action == "none" and r.diff == -50


def test_slope_and_percent_rounding(spark):
    fc, pred, tk = _frames(spark, fc_values=[100.0, 110.0, 120.0, 130.0, 140.0, 152.5])
    r = decide(spark, fc, pred, tk, _recs(spark, []), _recs(spark, []))
    assert r.diff == 52  # round half to even of 52.5
    assert r.slope == pytest.approx(57.29577951308232 * (1 - 100 / 152.5))


def test_merge_metadata_keeps_first_original(spark):
    df = spark.createDataFrame([({"prediction_date": "a"},), ({"prediction_date": "b", "original_prediction_date": "o"},)],
                               "m map<string,string>")
    got = [r.x for r in df.select(de.merge_metadata(F.col("m"), F.lit("z")).alias("x")).collect()]
    assert got == [{"prediction_date": "z", "original_prediction_date": "a"},
                   {"original_prediction_date": "o", "prediction_date": "z"}]


def test_event_ids_in_order_over_days(spark):
    at = lambda d, h: datetime(2024, 1, d, h)
    rows = [(1, "click", at(2, 1), "b"), (1, "click", at(1, 9), "z"), (1, "click", at(2, 1), "a"), (1, "view", at(1, 5), "v"), (2, "click", at(3, 0), "k")]
    got = de.event_ids(spark.createDataFrame(rows, "interval bigint, sport string, start timestamp, id string")).collect()
    assert {r["interval"]: r.event_ids for r in got} == {1: {"click": "z,a,b", "view": "v"}, 2: {"click": "k"}}


def test_traffic_intervals_name_their_events(spark, tmp_path):
    """ev_<sport> lists the calendar events that overlap an interval, '' if none."""
    from surgecast.plans import catalog

    h = lambda d, hour, minute=0: datetime(2024, 1, d, hour, minute)
    # user u's calendar event: its first minute plus u % 29 days; sport by u % 3 (click, view, purchase)
    rows = [(1, 100, "click", h(12, 5), 50.0), (2, 100, "view", h(12, 6), 50.0),  # an interval from 5 to 6
            (3, 29, "error", h(12, 4, 50), 1.0), (4, 58, "error", h(12, 5, 10), 1.0),  # purchase, view
            (5, 87, "error", h(12, 5, 30), 1.0),  # click
            (6, 116, "error", h(12, 7, 0), 1.0)]  # after the interval
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    got = catalog.registry()["traffic_intervals"].fn(spark, str(tmp_path)).collect()
    assert [(r.start_ds, r.ev_click, r.ev_view, r.ev_purchase) for r in got] == [(h(12, 5), "87", "58", "29")]
