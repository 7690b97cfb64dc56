"""Property tests for the rows-only time-series operators (brute force or invariants)."""

import math
import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from surgecast.operators import anomaly as an
from surgecast.operators import forest as fo
from surgecast.operators import decompose as dc


def _series(spark, values, key="s", step=3600):
    t0 = datetime(2024, 1, 1)
    rows = [(key, t0 + timedelta(seconds=i * step), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, ts timestamp, value double")


def check_smoothed(y, lag, threshold, influence, signal, avg, std):
    """Each point against the definition, from the signals given: the filtered
    values they imply, and mean and deviation of the last ``lag`` of them."""
    filtered = []
    for i, v in enumerate(y):
        filtered.append(v if not signal[i] else influence * v + (1 - influence) * filtered[-1])
        last = filtered[-lag:]
        if len(last) < lag:
            assert (signal[i], avg[i], std[i]) == (0, 0, 0)
            continue
        assert math.isclose(avg[i], statistics.fmean(last), abs_tol=1e-9)
        assert math.isclose(std[i], statistics.pstdev(last), abs_tol=1e-9)
        if i >= lag:
            far = abs(v - avg[i - 1]) > threshold * std[i - 1]
            assert signal[i] == (0 if not far else 1 if v > avg[i - 1] else -1)


def test_zscore_matches_definition(spark):
    random.seed(3)
    y = [random.gauss(10, 1) for _ in range(200)]
    y[120] = 40
    y[150] = -20
    df = an.smoothed_zscore(_series(spark, y), ["series_id"], "ts", "value", lag=12, threshold=4, influence=0.2)
    got = df.orderBy("ts").toPandas()
    check_smoothed(y, 12, 4, 0.2, list(got.signal), list(got.avg_filter), list(got.std_filter))
    assert got.signal[120] == 1 and got.signal[150] == -1


def test_zscore_state_can_be_cut_anywhere():
    random.seed(5)
    y = [random.gauss(0, 1) * (30 if i % 37 == 0 else 1) for i in range(150)]
    whole = an.SmoothedScore(7, 3.0, 0.4)
    expected = [whole.push(v) for v in y]
    got, window = [], ()
    for a, b in ((0, 3), (3, 40), (40, 41), (41, 150)):
        part = an.SmoothedScore(7, 3.0, 0.4, window)
        got += [part.push(v) for v in y[a:b]]
        window = part.window()
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert np.allclose(got, expected)


def test_zscore_short_series_is_an_error(spark):
    with pytest.raises(Exception, match="fewer than the lag"):
        an.smoothed_zscore(_series(spark, [1.0, 2.0]), ["series_id"], "ts", "value", lag=3, threshold=2, influence=0.5).collect()


def test_forest_sample_limit_has_no_floor():
    for n in (10**6, 10**9, 10**12):
        share = (fo.sample_limit(n, 256) + (1 << 63)) / (1 << 64)
        assert math.isclose(share * n, 512, rel_tol=1e-6)
    assert fo.sample_limit(500, 256) is None


def test_forest_samples_equal_rows_by_key_and_needs_rows(spark):
    same = spark.range(3000).selectExpr("id", "1.0D AS a", "2.0D AS b")
    roots = fo.rcf_fit(same, ["a", "b"], key=["id"], n_trees=6, sample_size=50).where("node = 0").collect()
    assert sorted(r["size"] for r in roots) == [50] * 6
    with pytest.raises(ValueError):
        fo.rcf_fit(same.limit(0), ["a", "b"])


def test_forest_frame_has_the_features_of_the_reference(spark):
    from surgecast.plans import anomaly_q as aq
    from surgecast.plans.series_q import aligned_metrics
    from surgecast.sources.tables import Tables
    from tests.conftest import SF_CHECK

    t = Tables(spark, SF_CHECK)
    got = aq.forest_frame(t).toPandas().set_index("datetime").sort_index()
    e = aligned_metrics(t).toPandas().set_index("datetime").sort_index()[aq.FOREST_FEATURES].astype(float)
    for c in aq.FOREST_FEATURES:
        e[f"{c}_diff_from_median"] = e[c] - e[c].median()
        e[f"{c}_more_quant_999"] = (e[c] > e[c].quantile(0.999)).astype(int)
        e[f"{c}_log"] = np.log(e[c] + 1)
        for l in range(1, 11):
            e[f"{c}_lag_{l}"] = e[c].shift(l)
    e = e.dropna()
    e["hour"], e["weekday"] = e.index.hour, e.index.dayofweek
    assert sorted(got.columns) == sorted(e.columns) and len(got) == len(e) > 0
    assert np.allclose(got[e.columns].to_numpy(float), e.to_numpy(float), rtol=0, atol=1e-9)


def test_peak_replacement_brute_force():
    pdf = pd.DataFrame({"t": [1, 2, 2, 3, 4, 5], "y": [50.0, 1.0, 3.0, 60.0, 2.0, 70.0]})
    out = an.replace_peaks_frame(pdf, "t", "y", 10)
    # first row is a peak with no earlier rows: median of nothing
    assert math.isnan(out.y[0])
    # t=3: earlier values {nan (replaced), 1, 3} -> median of [1, 3] = 2
    assert out.y[3] == 2.0
    # t=5: earlier {1, 3, 2, 2} -> 2
    assert out.y[5] == 2.0


def test_decomposition_parts_sum_to_input(spark):
    vals = [10 + 3 * math.sin(2 * math.pi * i / 24) + 0.1 * i for i in range(24 * 6)]
    d, _ = dc.decompose(_series(spark, vals), ["series_id"], "value", 24)
    p = d.orderBy("ts").toPandas()
    assert np.allclose(p.trend + p.seasonal + p.resid, p.value)
    assert abs(p.seasonal.sum()) < 1e-6 * len(p) + 1e-6


def test_periodic_input_gives_seasonal_naive(spark):
    pattern = [1.0, 5.0, 2.0, 8.0, 3.0, 4.0]
    vals = pattern * 10
    g = dc.with_index(_series(spark, vals), ["series_id"], "ts")
    _, phase = dc.decompose(g, ["series_id"], "value", 6, indexed=True)
    last = g.where(F.col("_i") == F.col("_n") - 1).select("series_id", "_n", F.col("ts").alias("last_ts"))
    fut = dc.seasonal_forecast(dc.future_positions(last, ["series_id"], 6, 3600), phase, ["series_id"], 6, "s")
    s = [r.s for r in fut.orderBy("_j").collect()]
    centred = np.array(pattern) - np.mean(pattern)
    assert np.allclose(s, centred)


def test_ses_closed_form_matches_loop(spark):
    random.seed(5)
    y = [random.random() for _ in range(50)]
    g = dc.with_index(_series(spark, y), ["series_id"], "ts")
    lvl = dc.ses_level(g, ["series_id"], "value", 12).first().level
    a, level = 2 / 13, y[0]
    for v in y:
        level = a * v + (1 - a) * level
    assert lvl == pytest.approx(level)


def test_boxcox_lambda_matches_brute_force(spark):
    random.seed(11)
    x = np.array([math.exp(random.gauss(3, 0.6)) for _ in range(400)])
    lam = dc.boxcox_lambda(_series(spark, x), ["series_id"], "value").first().lmbda

    def llf(l):
        y = np.log(x) if l == 0 else (x ** l - 1) / l
        return (l - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    grid = np.arange(-2, 2.00001, 0.0005)
    best = grid[np.argmax([llf(g) for g in grid])]
    assert abs(lam - best) <= 0.002
    assert abs(lam) < 0.3  # log-normal data: lambda near 0


def test_boxcox_lambda_refined_is_the_maximum():
    rng = np.random.default_rng(6)
    for x in (np.exp(rng.normal(2, 0.5, 300)), rng.uniform(1, 9, 300), rng.gamma(2, 3, 300) + 0.1):
        lam, top = dc.best_lambda(np.sort(x), 0.05, 0.001, True)
        dense = np.linspace(lam - 0.002, lam + 0.002, 4001)
        best = max(dense, key=lambda v: dc._likelihood(np.sort(x), v))
        assert abs(lam - best) < 1e-5 and top >= dc._likelihood(np.sort(x), best) - 1e-9
    assert abs(dc.best_lambda(np.full(5, 3.0), 0.05, 0.001, True)[0]) <= 2.06  # any lambda does for a constant
    assert dc.best_lambda(np.array([1.0]), 0.05, 0.001, True) == (-2.05, -math.inf)


def test_trend_forecast_of_a_line_is_the_line(spark):
    vals = [2.0 + 0.5 * i for i in range(100)]
    g = dc.with_index(_series(spark, vals), ["series_id"], "ts")
    tr = dc.trend_forecast(g, ["series_id"], "value", 5, 3600, degree=2, tau=-1.0)
    got = [r.trend_forecast for r in tr.orderBy("_j").collect()]
    assert np.allclose(got, [2.0 + 0.5 * i for i in range(100, 105)], atol=1e-6)


def test_esd_finds_injected_spike(spark):
    random.seed(2)
    vals = [10 + 2 * math.sin(2 * math.pi * i / 24) + random.gauss(0, 0.3) for i in range(24 * 7)]
    vals[100] += 30
    out = an.seasonal_esd(_series(spark, vals), ["series_id"], "ts", "value", period=24, max_anoms=0.02)
    hits = [r.ts for r in out.collect()]
    assert datetime(2024, 1, 1) + timedelta(hours=100) in hits


def test_esd_short_series_is_an_error(spark):
    with pytest.raises(Exception, match="47 points, fewer than 48"):
        an.seasonal_esd(_series(spark, [1.0] * 46 + [90.0]), ["series_id"], "ts", "value", period=24, max_anoms=0.02).collect()
    assert an.seasonal_esd(_series(spark, [1.0] * 48), ["series_id"], "ts", "value", period=24, max_anoms=0.02).collect() == []
    with pytest.raises(ValueError, match="too few"):
        an.esd_positive(np.array([1.0, 9.0]), 1)


def test_t_quantile_known_values():
    assert an.t_ppf(0.975, 10) == pytest.approx(2.228138851986, abs=1e-6)
    assert an.t_ppf(0.99, 3) == pytest.approx(4.540702858568, abs=1e-6)


def test_forest_ranks_outliers_on_top(spark):
    random.seed(9)
    rows = [(i, random.gauss(0, 1), random.gauss(0, 1)) for i in range(600)]
    rows += [(600, 9.0, 9.0), (601, -8.0, 7.5)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    trees = fo.rcf_fit(df, ["a", "b"], n_trees=30, sample_size=128)
    scored = fo.rcf_score(df, trees, ["a", "b"]).orderBy(F.col("score").desc()).limit(2)
    assert sorted(r.i for r in scored.collect()) == [600, 601]


def test_forest_independent_of_partitioning(spark):
    random.seed(4)
    rows = [(i, random.gauss(0, 1), random.gauss(0, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    t1 = sorted(map(tuple, fo.rcf_fit(df.repartition(1), ["a", "b"], n_trees=5, sample_size=64).collect()))
    t2 = sorted(map(tuple, fo.rcf_fit(df.repartition(6), ["a", "b"], n_trees=5, sample_size=64).collect()))
    assert t1 == t2


@pytest.mark.parametrize("op", ["zscore", "esd", "peaks"])
def test_grouped_operators_independent_of_partitioning(spark, op):
    random.seed(31)
    vals = [10 + 2 * math.sin(2 * math.pi * i / 24) + random.gauss(0, 0.5) for i in range(24 * 5)]
    vals[70] += 25
    rows = []
    for key in ["a", "b", "c"]:
        rows += [(key, datetime(2024, 1, 1) + timedelta(hours=i), v + len(key)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, value double")

    def run(d):
        if op == "zscore":
            out = an.smoothed_zscore(d, ["series_id"], "ts", "value", lag=12, threshold=3, influence=0.2)
        elif op == "esd":
            out = an.seasonal_esd(d, ["series_id"], "ts", "value", period=24, max_anoms=0.05)
        else:
            out = an.replace_peaks(d, ["series_id"], "ts", "value", threshold=20.0)
        return sorted(map(tuple, out.collect()))

    assert run(df.repartition(1)) == run(df.repartition(7, "ts").sortWithinPartitions(F.desc("ts")))
