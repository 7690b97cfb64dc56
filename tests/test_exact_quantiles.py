"""Distributed quantiles and numbering against one-process forms."""

import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from surgecast.operators import decide as de
from surgecast.operators import metrics as met
from surgecast.operators import series as ser


def test_quantiles_equal_numpy(spark):
    rnd = random.Random(2)
    groups = {"a": [rnd.gauss(0, 1) for _ in range(997)], "b": [rnd.randint(0, 3) for _ in range(400)], "c": [5.0], "d": [1.0, 2.0], "e": [float("inf"), 1.0, 2.0]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("a", None), ("f", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    qs = [0.0, 0.5, 0.95, 0.999, 1.0]
    got = {r.k: r.quantiles for r in met.exact_quantiles(df, ["k"], F.col("v"), qs, accuracy=100).collect()}
    assert sorted(got) == ["a", "b", "c", "d", "e"]
    for k in "abcd":
        assert np.allclose(got[k], np.quantile(groups[k], qs), rtol=1e-12)
    assert got["e"][1] == 2.0 and got["e"][4] == float("inf")
    whole = met.exact_quantiles(df.where("k in ('a', 'b')"), [], F.col("v"), [0.25]).first()
    assert np.isclose(whole.quantiles[0], np.quantile(groups["a"] + groups["b"], 0.25))
    assert met.exact_quantiles(df.limit(0), [], F.col("v"), [0.5]).count() == 0


def test_no_values_are_gathered_in_one_buffer(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "cast(id AS double) AS v")
    out = ser.with_distribution_features(df, ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan and "median(" not in plan
    med = {r.k: r.v - r.v_diff_from_median for r in out.collect()}
    assert med == {0: 499.5, 1: 499.0, 2: 500.0}


def test_numbers_run_over_days(spark):
    rnd = random.Random(4)
    rows = [("s%d" % rnd.randint(0, 1), datetime(2024, 1, 1) + timedelta(hours=rnd.randint(0, 90)), f"e{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "sport string, start timestamp, id string").repartition(3)
    got = sorted((r.sport, r.number, r.id) for r in de.numbered(df, ["sport"]).collect())
    want = []
    for s in ("s0", "s1"):
        want += [(s, i, r[2]) for i, r in enumerate(sorted((r for r in rows if r[0] == s), key=lambda r: (r[1], r[2])), 1)]
    assert got == want


def test_rows_of_one_group_are_dealt_over_tasks(spark):
    """rows that meet their group's brackets don't all land in the group's task."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        base = spark.range(8000).select(F.lit("k").alias("k"), (F.col("id") * 1.5).alias("_v"))
        dealt = met._with_brackets(base, ["k"], [0.5], 100).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in dealt) == 8000 and max(r["count"] for r in dealt) < 4000


def test_medians_of_several_values_at_once(spark):
    rows = [("a", i % 7 * 1.0, None if i % 3 else i * 0.5) for i in range(101)] + [("b", 1.0, float("inf")), ("b", 4.0, 2.0), ("c", 3.0, None), ("d", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r.k: (r.mx, r.my) for r in met.exact_medians(df, ["k"], {"mx": F.col("x"), "my": F.col("y")}, accuracy=100).collect()}
    want = {r.k: (r.mx, r.my) for r in df.where("k != 'd'").groupBy("k").agg(F.median("x").alias("mx"), F.median("y").alias("my")).collect()}
    assert got == want and got["b"] == (2.5, float("inf")) and got["c"] == (3.0, None)
