"""F4 queries: Box-Cox fit, decomposition, seasonal / trend / residual forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from surgecast.operators import decompose as dc
from surgecast.operators import forecast as fc
from surgecast.operators import series as ser
from surgecast.plans.oracle_views import ctes
from surgecast.plans.registry import finish, query
from surgecast.session import materialize
from surgecast.sources.tables import Tables

STEP = 3600
DAY = 24
HORIZON = 24
CFG = fc.ForecastConfig(step_seconds=STEP, day_points=DAY, week_points=168, horizon_points=HORIZON, smooth_points=2)


def hourly_complete(t: Tables):
    """Hourly series per event type on a full grid; hours without events count 0."""
    g = ser.regular_grid(t.series, ["series_id"], "ts", STEP)
    return dc.with_index(g.withColumn("value", F.coalesce("value", F.lit(0.0))), ["series_id"], "ts")


GRID_SQL = {
    "b": "SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM series GROUP BY series_id",
    "gr": f"SELECT series_id, unnest(generate_series(lo, hi, INTERVAL {STEP} SECOND)) AS ts FROM b",
    "x": """SELECT g.series_id, g.ts, coalesce(s.value, 0.0) AS value,
                   row_number() OVER (PARTITION BY g.series_id ORDER BY g.ts) - 1 AS i,
                   count(*) OVER (PARTITION BY g.series_id) AS n
            FROM gr g LEFT JOIN series s ON s.series_id = g.series_id AND s.ts = g.ts""",
}


def decompose_sql(src: str, value: str, period: int, p: str) -> dict[str, str]:
    h = period // 2
    if period % 2 == 0:
        raw = (f"(cast(sum(cast({value} AS decimal(30,10))) OVER (PARTITION BY series_id ORDER BY i ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) AS double)"
               f" - 0.5 * lag({value}, {h}) OVER (PARTITION BY series_id ORDER BY i) - 0.5 * lead({value}, {h}) OVER (PARTITION BY series_id ORDER BY i)) / {period}")
    else:
        raw = f"cast(sum(cast({value} AS decimal(30,10))) OVER (PARTITION BY series_id ORDER BY i ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) AS double) / {period}"
    fr = f"i >= {h} AND i < least({h} + {period}, n - 1 - {h})"
    bk = f"i >= greatest({h}, n - 1 - {h} - {period}) AND i < n - 1 - {h}"
    return {
        f"{p}t": f"SELECT *, CASE WHEN i >= {h} AND i <= n - 1 - {h} THEN {raw} END AS tr FROM {src}",
        f"{p}f": f"""SELECT series_id,
              regr_slope(CASE WHEN {fr} THEN tr END, CASE WHEN {fr} THEN cast(i AS double) END) AS k1,
              regr_intercept(CASE WHEN {fr} THEN tr END, CASE WHEN {fr} THEN cast(i AS double) END) AS c1,
              regr_slope(CASE WHEN {bk} THEN tr END, CASE WHEN {bk} THEN cast(i AS double) END) AS k2,
              regr_intercept(CASE WHEN {bk} THEN tr END, CASE WHEN {bk} THEN cast(i AS double) END) AS c2
            FROM {p}t GROUP BY series_id""",
        f"{p}tt": f"""SELECT t.*, CASE WHEN i < {h} THEN k1 * i + c1 WHEN i > n - 1 - {h} THEN k2 * i + c2 ELSE tr END AS trend
                      FROM {p}t t JOIN {p}f f ON f.series_id = t.series_id""",
        f"{p}ph": f"""SELECT series_id, i % {period} AS phase,
                        cast(sum(cast({value} - trend AS decimal(30,10))) AS double) / count(*) AS pm FROM {p}tt GROUP BY 1, 2""",
        f"{p}phc": f"SELECT series_id, phase, pm - avg(pm) OVER (PARTITION BY series_id) AS seasonal FROM {p}ph",
        f"{p}dec": f"""SELECT tt.*, c.seasonal, {value} - trend - c.seasonal AS resid FROM {p}tt tt
                       JOIN {p}phc c ON c.series_id = tt.series_id AND c.phase = tt.i % {period}""",
    }


@query("seasonal_decompose_day", ops=("TS5", "GEN2"),
       sql=ctes("series", extra={**GRID_SQL, **decompose_sql("x", "value", DAY, "d_")}) + """
SELECT series_id, ts, round(value, 6) AS value, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(resid, 6) AS resid FROM d_dec""")
def seasonal_decompose_day(spark, sf_dir):
    """Additive decomposition (period one day) of every hourly series."""
    t = Tables(spark, sf_dir)
    d, _ = dc.decompose(hourly_complete(t), ["series_id"], "value", DAY, indexed=True)
    return finish(d.select("series_id", "ts", "value", "trend", "seasonal", "resid"))


@query("seasonal_forecast_day", ops=("TS6",),
       sql=ctes("series", extra={**GRID_SQL, **decompose_sql("x", "value", DAY, "d_"),
                                 "last": "SELECT series_id, max(n) AS n, max(ts) AS last_ts FROM x GROUP BY series_id",
                                 "fut": f"SELECT series_id, n, last_ts, unnest(generate_series(n, n + {HORIZON - 1})) AS j FROM last"})
       + f"""SELECT f.series_id, f.last_ts + (f.j - f.n + 1) * INTERVAL {STEP} SECOND AS ts, round(c.seasonal, 6) AS s1
             FROM fut f JOIN d_phc c ON c.series_id = f.series_id AND c.phase = f.j % {DAY}""")
def seasonal_forecast_day(spark, sf_dir):
    """Daily seasonal component continued over the next day."""
    t = Tables(spark, sf_dir)
    g = hourly_complete(t)
    _, phase = dc.decompose(g, ["series_id"], "value", DAY, indexed=True)
    last = g.where(F.col("_i") == F.col("_n") - 1).select("series_id", "_n", F.col("ts").alias("last_ts"))
    fut = dc.seasonal_forecast(dc.future_positions(last, ["series_id"], HORIZON, STEP), phase, ["series_id"], DAY, "s1")
    return finish(fut.select("series_id", "ts", "s1"))


def _boxcox_sql() -> str:
    bc = "CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END"
    return ctes("series", extra={
        **GRID_SQL,
        "g1": "SELECT series_id, value AS x, unnest(list_transform(range(0, 81), lambda k: round(k * 0.05 - 2, 6))) AS lam FROM x WHERE value > 0",
        "a1": f"SELECT series_id, lam, (lam - 1) * sum(ln(x)) - count(*) / 2 * ln(var_pop({bc})) AS llf FROM g1 GROUP BY 1, 2",
        "b1": "SELECT series_id, arg_max(lam, (llf, -lam)) AS l0 FROM a1 GROUP BY 1",
        "g2": """SELECT x.series_id, x.value AS x, unnest(list_transform(range(-50, 51), lambda k: round(b1.l0 + k * 0.001, 9))) AS lam
                 FROM x JOIN b1 ON b1.series_id = x.series_id WHERE x.value > 0""",
        "a2": f"SELECT series_id, lam, (lam - 1) * sum(ln(x)) - count(*) / 2 * ln(var_pop({bc})) AS llf FROM g2 GROUP BY 1, 2",
    }) + "SELECT series_id, round(arg_max(lam, (llf, -lam)), 6) AS lmbda, round(max(llf), 6) AS llf FROM a2 GROUP BY 1"


@query("boxcox_lambda_fit", ops=("TS4",), sql=_boxcox_sql())
def boxcox_lambda_fit(spark, sf_dir):
    """Maximum-likelihood Box-Cox lambda per hourly series."""
    t = Tables(spark, sf_dir)
    return finish(dc.boxcox_lambda(hourly_complete(t), ["series_id"], "value"))


@query("ses_residual_level", ops=("TS8",), sql=ctes("series", extra={**GRID_SQL}) + """
SELECT series_id, round(sum((2.0 / 13) * pow(1 - 2.0 / 13, n - 1 - i) * value) + pow(1 - 2.0 / 13, max(n)) * arg_min(value, i), 6) AS level
FROM x GROUP BY series_id""")
def ses_residual_level(spark, sf_dir):
    """Simple exponential smoothing level (span 12) of every hourly series."""
    t = Tables(spark, sf_dir)
    return finish(dc.ses_level(hourly_complete(t), ["series_id"], "value", 12))


def _cramer3(prefix: str) -> str:
    """Columns c0, c1, c2 solving [[s0,s1,s2],[s1,s2,s3],[s2,s3,s4]] c = [t0,t1,t2] (Cramer's rule)."""
    def det(m):
        return (f"(({m[0][0]}) * (({m[1][1]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][1]}))"
                f" - ({m[0][1]}) * (({m[1][0]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][0]}))"
                f" + ({m[0][2]}) * (({m[1][0]}) * ({m[2][1]}) - ({m[1][1]}) * ({m[2][0]})))")
    a = [[f"{prefix}s{p + q}" for q in range(3)] for p in range(3)]
    b = [f"{prefix}t{p}" for p in range(3)]
    d = det(a)
    cols = []
    for j in range(3):
        aj = [[b[i] if c == j else a[i][c] for c in range(3)] for i in range(3)]
        cols.append(f"{det(aj)} / {d} AS {prefix}c{j}")
    return ", ".join(cols)


def _power_sums(prefix: str, u: str, y: str, w2: str) -> str:
    return ", ".join([f"sum({w2} * pow({u}, {k})) AS {prefix}s{k}" for k in range(5)]
                     + [f"sum({w2} * pow({u}, {k}) * {y}) AS {prefix}t{k}" for k in range(3)])


TAU = 50.0
TREND_SQL = ctes("series", extra={
    **GRID_SQL, **decompose_sql("x", "value", DAY, "d_"),
    "sc1": "SELECT series_id, (max(i) + min(i)) / 2.0 AS xc, greatest((max(i) - min(i)) / 2.0, 1e-12) AS xs FROM d_dec GROUP BY 1",
    "f1s": f"""SELECT d.series_id, {_power_sums('a', '((d.i - sc1.xc) / sc1.xs)', 'd.trend', '1.0')}
               FROM d_dec d JOIN sc1 USING (series_id) GROUP BY d.series_id""",
    "f1": f"SELECT series_id, {_cramer3('a')} FROM f1s",
    "cv": """SELECT d.series_id, d.i, d.n, d.ts, d.trend,
                    ac0 + ac1 * ((d.i - xc) / xs) + ac2 * ((d.i - xc) / xs) * ((d.i - xc) / xs) AS curve
             FROM d_dec d JOIN f1 USING (series_id) JOIN sc1 USING (series_id)""",
    "cl": "SELECT series_id, max(n) AS n, arg_max(curve, i) AS clast, max(ts) AS last_ts FROM cv GROUP BY 1",
    "sc2": "SELECT series_id, (max(curve) + min(curve)) / 2.0 AS vc, greatest((max(curve) - min(curve)) / 2.0, 1e-12) AS vs FROM cv GROUP BY 1",
    "f2s": f"""SELECT cv.series_id,
               {_power_sums('b', '((cv.curve - sc2.vc) / sc2.vs)', 'cv.trend',
                            f'(exp(-pow(cl.clast - cv.curve, 2) / (2 * {TAU} * {TAU})) * exp(-pow(cl.clast - cv.curve, 2) / (2 * {TAU} * {TAU})))')}
               FROM cv JOIN sc2 USING (series_id) JOIN cl USING (series_id) GROUP BY cv.series_id""",
    "f2": f"SELECT series_id, {_cramer3('b')} FROM f2s",
    "fut": f"SELECT series_id, n, last_ts, unnest(generate_series(n, n + {HORIZON - 1})) AS j FROM cl",
    "fc": """SELECT fut.series_id, fut.last_ts + (fut.j - fut.n + 1) * INTERVAL 3600 SECOND AS ts,
                    ac0 + ac1 * ((fut.j - xc) / xs) + ac2 * ((fut.j - xc) / xs) * ((fut.j - xc) / xs) AS fcurve
             FROM fut JOIN f1 USING (series_id) JOIN sc1 USING (series_id)""",
})
TREND_SQL += """SELECT fc.series_id, fc.ts,
       round(bc0 + bc1 * ((fcurve - vc) / vs) + bc2 * ((fcurve - vc) / vs) * ((fcurve - vc) / vs), 6) AS trend_forecast
FROM fc JOIN f2 USING (series_id) JOIN sc2 USING (series_id)"""


@query("trend_forecast_poly", ops=("TS7",), sql=TREND_SQL)
def trend_forecast_poly(spark, sf_dir):
    """Polynomial trend forecast of the daily trend (degree 2, then weighted degree 2 on the curve)."""
    t = Tables(spark, sf_dir)
    d, _ = dc.decompose(hourly_complete(t), ["series_id"], "value", DAY, prefix="d_", indexed=True)
    d = materialize(d)
    tr = dc.trend_forecast(d, ["series_id"], "d_trend", HORIZON, STEP, degree=2, tau=TAU)
    return finish(tr.select("series_id", "ts", "trend_forecast"))


@query("residual_outliers_clean", ops=("TS3",), sql=ctes("series", extra={**GRID_SQL, **decompose_sql("x", "value", DAY, "d_"),
    "band": """SELECT *, avg(resid) OVER (PARTITION BY series_id) AS mu, stddev_samp(resid) OVER (PARTITION BY series_id) AS sd FROM d_dec"""})
    + """SELECT series_id, ts, round(value, 6) AS value,
             round(CASE WHEN resid < mu - 4 * sd OR resid > mu + 4 * sd THEN NULL ELSE value END, 6) AS cleaned FROM band""")
def residual_outliers_clean(spark, sf_dir):
    """Points whose daily-decomposition residual is beyond 4 sigma become null."""
    t = Tables(spark, sf_dir)
    out = fc.residual_outliers(hourly_complete(t), ["series_id"], "value", DAY, 4.0, out="cleaned", method="classical")
    return finish(out.select("series_id", "ts", "value", "cleaned"))


@query("nrt_forecast_composed", ops=("TS9", "TS1", "TS3", "TS4", "TS5", "TS6", "TS7", "TS8", "WIN2", "PRJ28", "JON16"))
def nrt_forecast_composed(spark, sf_dir):
    """Composed next-day forecast for every hourly series (rows-only check)."""
    t = Tables(spark, sf_dir)
    out = fc.nrt_forecast(t.series, ["series_id"], "ts", "value", CFG)
    return finish(out)
