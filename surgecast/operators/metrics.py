"""Model evaluation metrics, metric-history alerts and model choice.

Means, sums and deviations are one grouped aggregate (partial aggregation).
Medians are exact but never buffer a whole group in one task: an approximate
quantile brackets the middle ranks, rows below the bracket are only counted,
and rows inside it are reduced to (value, count) pairs before the middle order
statistics are located (see :func:`exact_medians`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.functions.scalar import exact_sum

METRIC_DIGITS = 10  # the report keeps ten decimals
SALTS = 64  # tasks that a group's rows are dealt over


def _with_brackets(base: DataFrame, keys: list[str], qs: Sequence[float], accuracy: int) -> DataFrame:
    """``base`` (keys, ``_v``) with its group's row count ``_n`` and approximate
    brackets ``_q`` (low and high edge of each of ``qs``).

    Rows meet their group's brackets by (keys, hash of the value): a group's
    rows are dealt over up to SALTS tasks, however few groups there are, and
    equal values stay together."""
    half = 2.0 / accuracy
    edges = [p for q in qs for p in (max(0.0, q - half), min(1.0, q + half))]
    stats = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", edges, accuracy).alias("_q"))
    stats = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int")
    return base.withColumn("_salt", salt).join(stats, [*keys, "_salt"])


def exact_medians(df: DataFrame, keys: Sequence[str], values: dict[str, Column], *, accuracy: int = 10000) -> DataFrame:
    """Exact median per group (linear interpolation of the two middle values,
    as ``median``) of each of ``values`` without holding a group in one task.

    1. ``percentile_approx`` at 0.5 -/+ 2/accuracy gives a value bracket that
       contains the middle ranks (rank error <= n / accuracy).
    2. Rows inside the bracket are grouped to (value, count), so a bracket
       holds about 4 n / accuracy distinct values; those below it become one
       row without a value.
    3. A cumulative count over these rows finds the values at the middle ranks
       (n-1)//2 and n//2.

    Nulls take no part; a group with no value at all has no row.
    """
    kc = list(keys)
    named = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), v.cast("double").alias("_v")) for i, v in enumerate(values.values())]))
    base = df.select(*kc, named.alias("_x")).select(*kc, "_x.*").where(F.col("_v").isNotNull())
    g = [*kc, "_i"]
    lo, hi = F.col("_q")[0], F.col("_q")[1]
    rows = _with_brackets(base, g, [0.5], accuracy).where(F.col("_v") <= hi)
    found = rows.select(*g, "_n", F.when(F.col("_v") >= lo, F.col("_v")).alias("_v")).groupBy(*g, "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"))
    w = Window.partitionBy(*g).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = found.withColumn("_cum", F.sum("_c").over(w)).where(F.col("_v").isNotNull())
    # value at 0-based rank r: the first value whose cumulative count exceeds r

    def at_rank(i: int, r: Column) -> Column:
        return F.min(F.when((F.col("_i") == i) & (F.col("_cum") > r), F.col("_v")))

    r1, r2 = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    return ranked.groupBy(*kc).agg(*[(at_rank(i, r1) * 0.5 + at_rank(i, r2) * 0.5).alias(out) for i, out in enumerate(values)])


def exact_median(df: DataFrame, keys: Sequence[str], value: Column, *, accuracy: int = 10000,
                 out: str = "median") -> DataFrame:
    """:func:`exact_medians` of one value."""
    return exact_medians(df, keys, {out: value}, accuracy=accuracy)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: Column, qs: Sequence[float], *, accuracy: int = 10000,
                    out: str = "quantiles") -> DataFrame:
    """Exact quantiles per group (linear interpolation between ranks, as
    ``percentile``) as an array in the order of ``qs``, without holding a group's
    values in one place. Without keys the whole frame is one group.

    As in :func:`exact_medians`: an approximate bracket around each quantile, a
    count of the rows below it, and a cumulative count of the values inside. In
    small groups a rank may be the one just outside, so the neighbours of the
    bracket are kept, too. Nulls take no part; a group without values has no row."""
    kc, n_q = list(keys), len(qs)
    base = df.select(*([F.col(k) for k in kc] or [F.lit(0).alias("_all")]), value.cast("double").alias("_v")).where("_v IS NOT NULL")
    g = kc or ["_all"]
    j = _with_brackets(base, g, qs, accuracy)
    lo, hi = (lambda i: F.col("_q")[2 * i]), (lambda i: F.col("_q")[2 * i + 1])
    outside = [F.struct(F.count_if(F.col("_v") < lo(i)).alias("n"), F.max(F.when(F.col("_v") < lo(i), F.col("_v"))).alias("last"),
                        F.min(F.when(F.col("_v") > hi(i), F.col("_v"))).alias("next")) for i in range(n_q)]
    below = j.groupBy(*g).agg(F.array(*outside).alias("_out"), F.max("_n").alias("_n"))
    held = F.array_compact(F.array(*[F.when((F.col("_v") >= lo(i)) & (F.col("_v") <= hi(i)), F.lit(i)) for i in range(n_q)]))
    inside = j.select(*g, F.explode(held).alias("_i"), "_v").groupBy(*g, "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*g, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("_cum", F.sum("_c").over(w)).join(below, g)
    place = F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("_i") + 1) * (F.col("_n") - 1)
    out_of = F.element_at("_out", F.col("_i") + 1)

    def at_rank(r: Column) -> Column:
        inside = F.min(F.when(out_of["n"] + F.col("_cum") > r, F.col("_v")))
        return F.coalesce(F.max(F.when(r < out_of["n"], out_of["last"])), inside, F.max(out_of["next"]))

    two = ranked.groupBy(*g, "_i").agg(at_rank(F.floor(place)).alias("_a"), at_rank(F.ceil(place)).alias("_b"), F.first(place - F.floor(place)).alias("_part"))
    at = F.col("_a") + F.when(F.col("_part") > 0, (F.col("_b") - F.col("_a")) * F.col("_part")).otherwise(0.0)
    got = two.groupBy(*g).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", at.alias("v")))), lambda x: x["v"]).alias(out))  # one entry a quantile
    return got.select(*kc, out)


def regression_metrics(scored: DataFrame, keys: Sequence[str] = (), y: str = "y", yhat: str = "yhat") -> DataFrame:
    """AGG8: mae, med_ae, mape (y != 0), smape (y > 0, mean denominator),
    med_ape (all rows; y = 0 with an error gives +inf), mse, std (population)."""
    yy, pp = F.col(y).cast("double"), F.col(yhat).cast("double")
    err = yy - pp
    ae = F.abs(err)
    ape = F.when(yy != 0, ae / F.abs(yy))
    ape_all = F.when(yy != 0, ae / F.abs(yy)).when(ae != 0, F.lit(float("inf")))
    sape = F.when(yy > 0, F.try_divide(F.abs(pp - yy), (yy + pp) / 2))
    n = F.count(F.lit(1))
    aggs = [
        (exact_sum(ae) / n).alias("mae"),
        F.avg(ape).alias("mape"),
        F.avg(sape).alias("smape"),
        F.avg(err * err).alias("mse"),
        F.stddev_pop(err).alias("std"),
        n.alias("n"),
    ]
    kc = list(keys)
    if kc:
        out = scored.groupBy(*kc).agg(*aggs)
        out = out.join(exact_medians(scored, kc, {"med_ae": ae, "med_ape": ape_all}), kc, "left")
    else:
        whole = {n: exact_quantiles(scored, [], c, [0.5]).select(F.col("quantiles")[0]).scalar() for n, c in (("med_ae", ae), ("med_ape", ape_all))}
        out = scored.agg(*aggs).withColumns(whole)
    return out.withColumns({c: F.round(c, METRIC_DIGITS) for c in ["mae", "med_ae", "mape", "smape", "med_ape", "mse", "std"]})


def accuracy_alerts(
    history: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "created_at",
    metric: str = "mape",
    approved: str | None = "approved",
    last_n: int = 10,
    ratio: float = 2.0,
    stale_days: float = 2.0,
    now=None,
) -> DataFrame:
    """AGG11: per model group, the newest metric against the mean of up to
    ``last_n`` earlier approved ones; alert if it is higher and more than
    ``ratio`` times that mean. Stale if the newest is older than ``stale_days``."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    ranked = history.withColumn("_rn", F.row_number().over(w))
    current = ranked.where("_rn = 1").select(*keys, F.col(ts).alias("last_update"), F.col(metric).alias("current"))
    earlier = ranked.where("_rn > 1")
    if approved:
        earlier = earlier.where(F.col(approved))
    earlier = earlier.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= last_n)
    hist = earlier.groupBy(*keys).agg(F.avg(metric).alias("history_mean"), F.count(F.lit(1)).alias("history_n"))
    out = current.join(hist, list(keys), "left")
    now_c = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return out.withColumns(
        {
            "accuracy_alert": F.coalesce(
                (F.col("history_mean") < F.col("current"))
                & (F.try_divide(F.col("current"), F.col("history_mean")) > ratio),
                F.lit(False),
            ),
            "stale_alert": (F.unix_seconds(now_c) - F.unix_seconds(F.col("last_update").cast("timestamp")))
            > stale_days * 86400,
        }
    )


def choose_model(metrics: DataFrame, keys: Sequence[str], *, model: str = "model", metric: str = "smape",
                 threshold: float = 0.33) -> DataFrame:
    """ML8: per group, the model with the lowest metric among those within the threshold."""
    ok = metrics.where(F.col(metric) <= threshold)
    return ok.groupBy(*keys).agg(
        F.min_by(model, F.struct(F.col(metric), F.col(model))).alias("chosen_model"),
        F.min(metric).alias(f"chosen_{metric}"),
    )


def mark_target(df: DataFrame, keys: Sequence[str], count: str, target: str, out: str = "target") -> DataFrame:
    """DEC4: the target value on the row(s) with the group's highest count, null elsewhere."""
    w = Window.partitionBy(*keys)
    return df.withColumn(out, F.when(F.col(count) == F.max(count).over(w), F.col(target)))
