"""Hand-made edge cases for scalar rules, filters and islands."""

from datetime import datetime

from pyspark.sql import functions as F

from surgecast.functions.timeparts import filler, quantize_next
from surgecast.operators import calendar as cal_ops
from surgecast.operators import islands as isl
from surgecast.plans.registry import decimal_round
from surgecast.sources import asof


def _one(spark, expr, ts):
    return spark.createDataFrame([(ts,)], "t timestamp").select(expr.alias("x")).first().x


def test_quantize_strictly_next_mark(spark):
    q = lambda s: _one(spark, quantize_next(F.col("t"), 300), datetime.fromisoformat(s))
    assert q("2024-01-01 10:05:00") == datetime(2024, 1, 1, 10, 10)
    assert q("2024-01-01 10:05:10") == datetime(2024, 1, 1, 10, 10)
    assert q("2024-01-01 10:04:30") == datetime(2024, 1, 1, 10, 10)
    assert q("2024-01-01 10:00:00") == datetime(2024, 1, 1, 10, 5)
    assert q("2024-01-01 10:58:30") == datetime(2024, 1, 1, 11, 0)
    assert q("2024-01-01 23:58:10") == datetime(2024, 1, 2, 0, 0)


def test_filler_bounds_and_modulo(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10, 30))], "s timestamp, e timestamp")
    full = df.select(filler("s", "e", 300).alias("f")).first().f
    wrapped = df.select(filler("s", "e", 300, modulo_day=True).alias("f")).first().f
    assert full[0] == datetime(2024, 1, 1, 9, 55) and full[-1] == datetime(2024, 1, 2, 10, 40)
    assert wrapped[-1] == datetime(2024, 1, 1, 10, 40)


def test_exclude_periods_closed_and_malformed(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 8)], "date_utc timestamp")
    out = cal_ops.exclude_periods(df, [("2024-01-02", "2024-01-03"), ("2024-01-06", "2024-01-05"), ("2024-01-07",)])
    days = sorted(r.date_utc.day for r in out.collect())
    assert days == [1, 4, 5, 6, 7]


def test_network_filter_keeps_null_and_unaired(spark):
    ev = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id bigint")
    air = spark.createDataFrame([(1, "X"), (2, None), (3, "X"), (3, "Y")], "event_id bigint, network_name string")
    out = sorted(r.id for r in cal_ops.filter_by_network(ev, air, ["X"]).collect())
    assert out == [2, 3, 4]


def test_zero_divisor_gives_null(spark):
    from surgecast.functions.scalar import influence, percent_diff

    r = spark.range(1).select(influence(F.lit(3), F.lit(0)).alias("a"), percent_diff(F.lit(5.0), F.lit(0.0)).alias("b")).first()
    assert r.a is None and r.b is None


def test_percent_diff_half_even(spark):
    from surgecast.functions.scalar import percent_diff

    r = spark.range(1).select(percent_diff(F.lit(100.5), F.lit(100.0)).alias("a"), percent_diff(F.lit(101.5), F.lit(100.0)).alias("b")).first()
    assert r.a == 0 and r.b == 2


def test_island_gap_exactly_threshold_merges(spark):
    pts = [("a", datetime(2024, 1, 1, 0, 0)), ("a", datetime(2024, 1, 1, 0, 30)), ("a", datetime(2024, 1, 1, 1, 0, 1)),
           ("b", datetime(2024, 1, 1, 0, 0))]
    df = spark.createDataFrame(pts, "s string, ts timestamp")
    out = sorted((r.s, r.start_time, r.end_time, r.n_points) for r in isl.islands(df, ["s"], "ts", gap_seconds=1800).collect())
    assert out == [("a", datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 30), 2),
                   ("a", datetime(2024, 1, 1, 1, 0, 1), datetime(2024, 1, 1, 1, 0, 1), 1),
                   ("b", datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 0), 1)]


def test_islands_independent_of_partitioning(spark):
    rows = [("k", datetime(2024, 1, 1) .replace(minute=m % 60, hour=m // 60)) for m in range(0, 600, 7)]
    df = spark.createDataFrame(rows, "s string, ts timestamp")
    a = sorted(map(tuple, isl.islands(df.repartition(1), ["s"], "ts", gap_seconds=300).collect()))
    b = sorted(map(tuple, isl.islands(df.repartition(7), ["s"], "ts", gap_seconds=300).collect()))
    assert a == b


def test_covering_gap_file_is_used(spark):
    rows = [("2024-01-01T00:00:00_2024-01-05T00:00:00", datetime(2024, 1, 2, h), float(h)) for h in range(5)]
    df = spark.createDataFrame(rows, "file_name string, datetime timestamp, v double")
    out = asof.gap_files(df, "2024-01-02 01:00:00", "2024-01-02 03:00:00")
    assert sorted(r.datetime.hour for r in out.collect()) == [2, 3]


def test_asof_partition_empty_when_none(spark):
    df = spark.createDataFrame([("2024-01-05", 1)], "d string, v int").withColumn("d", F.to_date("d"))
    assert asof.asof_partition(df, "d", "2024-01-01").count() == 0
    assert asof.asof_partition(df, "d", "2024-01-09").count() == 1


def test_decimal_round_rewrite_keeps_other_rounds():
    sql = decimal_round("SELECT round(a, 6), round(b, 2), ground(c, 6)")
    assert "round(b, 2)" in sql and "ground(c, 6)" in sql and "decimal(38,18)" in sql


def test_exact_median_matches_builtin(spark):
    import random

    from surgecast.operators.metrics import exact_median

    random.seed(1)
    rows = [("a", float(random.randint(0, 50))) for _ in range(5001)] + [("b", random.random()) for _ in range(4000)]
    rows += [("c", 1.0), ("c", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in exact_median(df, ["g"], F.col("v"), accuracy=100).collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got == want
