"""F4 decisions: traffic intervals with tasks, sport shares and events (DEC3),
recommendation adjustment (DEC1), new recommendations (DEC2), interval
expansion (GEN3) and forecast tags (SNK7); ``sinks.tables`` publishes them.

Every rule is a column expression over per-key aggregates joined together;
there is one output row per (service, region) key, no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.functions.scalar import any_positive, percent_diff, slope_degrees

Keys = Sequence[str]
DAY = 86400


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def remap_sport(sport: str = "sport", league: str = "league") -> Column:
    """PRJ24: league 'ufc' is its own sport."""
    return F.when(F.col(league) == "ufc", F.lit("ufc")).otherwise(F.col(sport))


def calendar_events(cal: DataFrame, period_start, period_end) -> DataFrame:
    """AGG4 input + FIL10: events overlapping the closed period, one row each."""
    c = cal.select(
        remap_sport().alias("sport"),
        F.col("date_utc").cast("timestamp").alias("start"),
        F.col("end_with_avg_duration").cast("timestamp").alias("end"),
        F.col("id").cast("string").alias("id"), "name", "league",
    )
    return c.where((F.col("start") <= _ts(period_end)) & (F.col("end") >= _ts(period_start)))


def numbered(events: DataFrame, keys: Sequence[str], out: str = "number") -> DataFrame:
    """Rows numbered from 1 within ``keys`` by (start, id).

    Numbers run within a day; the days' counts, added up, shift them. So no task
    sorts more than a key's events of one day, however many a key has."""
    kc = list(keys)
    rows = events.withColumn("_day", F.to_date("start"))
    days = rows.groupBy(*kc, "_day").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*kc).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)  # a row a day
    days = days.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    within = F.row_number().over(Window.partitionBy(*kc, "_day").orderBy("start", "id"))
    return rows.withColumn("_k", within).join(days, [*kc, "_day"]).withColumn(out, F.col("_before") + F.col("_k")).drop("_day", "_k", "_before")


def events_by_sport(events: DataFrame) -> DataFrame:
    """AGG4: the events of each sport as rows, numbered by (start, id)."""
    return numbered(events, ["sport"])


def _day_buckets(start: str, end: str) -> Column:
    return F.explode(F.sequence(F.floor(F.unix_seconds(F.col(start)) / DAY), F.floor(F.unix_seconds(F.col(end)) / DAY)))


def overlap_join(left: DataFrame, right: DataFrame, *, keys: Sequence[str], left_span=("start_ds", "end_ds"),
                 right_span=("start", "end"), left_id: Sequence[str] = ("interval",)) -> DataFrame:
    """JON11: pairs whose closed spans overlap, as an equi-join on (keys, day
    bucket) plus the exact overlap predicate, deduplicated. Each side explodes
    into the days it covers (bounded by its own length), so no pair of rows
    far apart is ever formed."""
    ls, le = left_span
    rs, re_ = right_span
    lb = left.withColumn("_day", _day_buckets(ls, le))
    rb = right.withColumn("_day", _day_buckets(rs, re_))
    j = lb.join(rb, [*keys, "_day"]).where((F.col(rs) <= F.col(le)) & (F.col(re_) >= F.col(ls)))
    return j.drop("_day").dropDuplicates([*left_id, *keys, "id"])


def traffic_intervals(
    traffic: DataFrame,
    tasks: DataFrame,
    sports: dict[str, str],
    period_start,
    period_end,
    *,
    min_gap_seconds: int = 3600,
    keys: Keys = (),
    ts: str = "ds",
) -> DataFrame:
    """DEC3: intervals of extra traffic with their task peak and sport shares.

    ``traffic`` has one column per sport (``sports`` maps column -> calendar
    sport). Steps: FIL9 any sport positive, FIL20 closed period, WIN5 new
    interval after a gap > ``min_gap_seconds``, JON13 inner join with task
    counts, AGG5 interval rollup, AGG6 shares, FIL11 intervals touching the
    period edge dropped. The events of an interval are rows of
    :func:`interval_events`.
    """
    kc = list(keys)
    ps, pe = _ts(period_start), _ts(period_end)
    cols = list(sports)
    tr = traffic.withColumn(ts, F.col(ts).cast("timestamp")).where(
        any_positive(cols) & F.col(ts).between(ps, pe))
    tk = tasks.select(*kc, F.col(ts).cast("timestamp").alias(ts), "n_tasks").where(F.col(ts).between(ps, pe))
    w = Window.partitionBy(*kc).orderBy(ts) if kc else Window.partitionBy(F.lit(0)).orderBy(ts)
    gap = F.unix_seconds(F.col(ts)) - F.unix_seconds(F.lag(ts).over(w))
    tr = tr.withColumn("_new", F.when(gap > min_gap_seconds, 1).otherwise(0))
    tr = tr.withColumn("interval", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = tr.join(tk, [*kc, ts])
    agg = merged.groupBy(*kc, "interval").agg(
        F.min(ts).alias("start_ds"), F.max(ts).alias("end_ds"), F.max("n_tasks").alias("n_tasks"),
        F.max_by(F.col(ts), F.struct(F.col("n_tasks"), F.col(ts))).alias("max_tasks_timestamp"),
        *[F.sum(c).alias(c) for c in cols],
    )
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    shares = agg.select(
        *kc, "interval", "start_ds", "end_ds",
        F.explode(F.array(*[F.struct(F.lit(s).alias("sport"), F.try_divide(F.col(c), total).alias("weight"))
                            for c, s in sports.items()])).alias("_s"),
    ).select(*kc, "interval", "start_ds", "end_ds", "_s.*")
    weights = shares.groupBy(*kc, "interval").agg(
        F.map_from_entries(F.collect_list(F.struct("sport", "weight"))).alias("sport_weight_in_extra_traffic"))  # one entry a sport
    out = agg.join(weights, [*kc, "interval"]).drop(*cols)
    return out.where((F.col("start_ds") != ps) & (F.col("end_ds") != pe))


def interval_events(intervals: DataFrame, events: DataFrame, sports: Sequence[str], keys: Keys = ()) -> DataFrame:
    """AGG6 + JON11: the calendar events that overlap each interval, one row each,
    numbered by (start, id) within (interval, sport)."""
    kc = list(keys)
    by_sport = intervals.select(*kc, "interval", "start_ds", "end_ds", F.explode(F.array(*map(F.lit, sports))).alias("sport"))
    found = overlap_join(by_sport, events.select("sport", "start", "end", "id", "name", "league"), keys=["sport"], left_id=[*kc, "interval"])
    return numbered(found.drop("start_ds", "end_ds"), [*kc, "interval", "sport"])


def event_ids(events: DataFrame, keys: Keys = (), sep: str = ",") -> DataFrame:
    """AGG6: per interval, a map from sport to the ids of its :func:`interval_events`
    joined in the order of (start, id). Sports without events are left out.

    Ids are joined within a day, then the days' texts: a task sorts one day's
    events, and of a whole (interval, sport) holds only the joined text itself."""
    kc = [*keys, "interval"]
    days = events.groupBy(*kc, "sport", F.to_date("start").alias("_day")).agg(
        F.array_sort(F.collect_list(F.struct("start", "id"))).alias("_e"))  # one day's events
    days = days.select(*kc, "sport", "_day", F.array_join(F.col("_e")["id"], sep).alias("_ids"))
    sports = days.groupBy(*kc, "sport").agg(F.array_sort(F.collect_list(F.struct("_day", "_ids"))).alias("_d"))  # a text a day
    sports = sports.select(*kc, "sport", F.array_join(F.col("_d")["_ids"], sep).alias("_ids"))
    return sports.groupBy(*kc).agg(F.map_from_entries(F.collect_list(F.struct("sport", "_ids"))).alias("event_ids"))  # one entry a sport


@dataclass(frozen=True)
class AdjustConfig:
    """Thresholds of the reference's adjustment (defaults as there)."""

    up: float = 25.0
    down: float = -30.0
    change_up: float = 0.3
    change_down: float = -0.4
    slope: float = 5.0
    lead_seconds: int = 1800
    close_after_seconds: int = 15 * 3600
    early_start_seconds: int = 3600


def merge_metadata(meta: Column, prediction_date: Column) -> Column:
    """PRJ23: set ``prediction_date``; keep the first one as ``original_prediction_date`` (once)."""
    base = F.map_filter(meta, lambda k, v: k != "prediction_date")
    orig = F.when(
        ~F.map_contains_key(meta, "original_prediction_date") & F.map_contains_key(meta, "prediction_date"),
        F.create_map(F.lit("original_prediction_date"), F.element_at(meta, "prediction_date")),
    ).otherwise(F.create_map().cast("map<string,string>"))
    return F.map_concat(base, F.create_map(F.lit("prediction_date"), prediction_date), orig)


def _first_matching(recs: DataFrame, window: DataFrame, keys: Keys, cond: Column, prefix: str) -> DataFrame:
    """WIN10: the first recommendation (by ``rec_order``) meeting ``cond`` per key."""
    kc = list(keys)
    j = recs.join(window, kc).where(cond)
    w = Window.partitionBy(*kc).orderBy("rec_order", "interval_id")
    first = j.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    cols = [c for c in recs.columns if c not in kc]
    return first.select(*kc, *[F.col(c).alias(f"{prefix}{c}") for c in cols], F.lit(True).alias(f"{prefix}found"))


def adjust_recommendations(
    forecast: DataFrame,
    predictions: DataFrame,
    tasks: DataFrame,
    originals: DataFrame,
    adjusted: DataFrame,
    prediction_time,
    keys: Keys,
    cfg: AdjustConfig = AdjustConfig(),
    *,
    service: Column | None = None,
    region: Column | None = None,
) -> DataFrame:
    """DEC1 (+ DEC2 branch): one decision row per key. With ``service`` and
    ``region`` (columns of the keys) a new recommendation gets its id (PRJ21).

    Inputs carry ``keys``; forecast ``ts, count``; predictions ``ts, count``;
    tasks ``ts, n_tasks``; recommendations ``interval_id, rec_order, start_ds,
    end_ds, n_tasks, max_tasks_timestamp, original_start_ds, original_end_ds,
    original_n_tasks, metadata``. ``action`` is one of none / readjust /
    adjust / new.
    """
    kc = list(keys)
    pt = _ts(prediction_time)
    cut = forecast.where(F.col("ts") >= pt + F.make_dt_interval(secs=F.lit(cfg.lead_seconds)))
    valid = cut.where(F.col("count").isNotNull())
    fa = cut.groupBy(*kc).agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.max("count").alias("fmax")).join(
        valid.groupBy(*kc).agg(F.min_by("count", "ts").alias("first_v"), F.max_by("count", "ts").alias("last_v")), kc, "left")
    win = fa.select(*kc, "t0", "t1")
    inwin = F.col("ts").between(F.col("t0"), F.col("t1"))
    pmax = predictions.join(win, kc).where(inwin).groupBy(*kc).agg(F.max("count").alias("pmax"))
    ntmax = tasks.join(win, kc).where(inwin).groupBy(*kc).agg(F.max("n_tasks").alias("ntmax"))
    overlap = (F.col("start_ds") <= F.col("t1")) & (F.col("end_ds") >= F.col("t0"))
    after = F.unix_seconds("start_ds") - F.unix_seconds("t1")
    close = (after >= 0) & (after <= cfg.close_after_seconds)
    aff = _first_matching(originals, win, kc, overlap | close, "aff_")
    adj = _first_matching(adjusted, win, kc, overlap, "adj_")
    d = fa.join(pmax, kc, "left").join(ntmax, kc, "left").join(aff, kc, "left").join(adj, kc, "left")
    has_aff, has_adj = F.coalesce("aff_found", F.lit(False)), F.coalesce("adj_found", F.lit(False))
    diff = percent_diff("fmax", "pmax")
    prev = F.when(has_adj, F.col("adj_n_tasks")).when(has_aff, F.col("aff_n_tasks")).otherwise(F.col("ntmax"))
    max_end = (F.when(has_adj, F.col("adj_max_tasks_timestamp")).when(has_aff, F.col("aff_max_tasks_timestamp"))
               .otherwise(F.col("t0")))
    early = has_aff & (F.col("t0") >= F.col("aff_start_ds") - F.make_dt_interval(secs=F.lit(cfg.early_start_seconds))) & (
        F.col("t0") < F.col("aff_start_ds"))
    d = d.withColumns({
        "diff": diff, "prev_n_tasks": prev, "max_end": max_end,
        "start_change": F.when(early, F.col("aff_start_ds")).otherwise(F.col("t0")),
        "slope": slope_degrees("first_v", "last_v"),
    })
    new = F.bround(F.col("ntmax") * (100 + F.col("diff")) / 100, 0).cast("bigint")
    d = d.withColumn("new_n_tasks", new)
    change = F.try_divide((F.col("new_n_tasks") - F.col("prev_n_tasks")).cast("double"), F.col("prev_n_tasks").cast("double"))
    triggered = (F.col("diff") > cfg.up) | (F.col("diff") < cfg.down)
    suppress = (
        ((F.col("slope") < cfg.slope) & (change >= 0) & (change < cfg.change_up))
        | ((change > cfg.change_down) & (change <= 0))
        | ((F.col("t0") < F.col("max_end")) & (F.col("diff") < cfg.down))
    )
    action = (
        F.when(~F.coalesce(triggered, F.lit(False)) | F.coalesce(suppress, F.lit(False)), "none")
        .when(has_adj, "readjust").when(has_aff, "adjust")
        .when(F.col("new_n_tasks") > F.col("ntmax"), "new").otherwise("none")
    )
    d = d.withColumn("action", action)
    pdate = F.date_format(pt, "yyyy-MM-dd HH:mm:ss")
    start = (F.when(F.col("action") == "readjust", F.least("start_change", "adj_original_start_ds"))
             .when(F.col("action") == "adjust", F.least("start_change", "aff_start_ds"))
             .when(F.col("action") == "new", F.col("t0")))
    end = (F.when(F.col("action") == "readjust", F.greatest("adj_end_ds", "adj_original_end_ds", "t1"))
           .when(F.col("action") == "adjust", F.greatest("aff_end_ds", "t1"))
           .when(F.col("action") == "new", F.col("t1")))
    meta_new = F.create_map(F.lit("prediction_date"), F.date_format(pt + F.make_dt_interval(days=F.lit(1)), "yyyy-MM-dd HH:mm:ss"))
    return d.select(
        *kc, "action", "t0", "t1", "diff", "slope", "prev_n_tasks",
        F.when(F.col("action") != "none", F.col("new_n_tasks")).alias("n_tasks"),
        start.alias("start_ds"), end.alias("end_ds"),
        F.when(F.col("action") == "readjust", F.col("adj_interval_id")).when(F.col("action") == "adjust", F.col("aff_interval_id"))
        .when(F.col("action") == "new", F.lit(None) if service is None else new_recommendation_id(F.col("t0"), service, region))
        .alias("interval_id"),
        F.when(F.col("action") == "readjust", F.col("adj_original_start_ds")).when(F.col("action") == "adjust", F.col("aff_start_ds"))
        .alias("original_start_ds"),
        F.when(F.col("action") == "readjust", F.col("adj_original_end_ds")).when(F.col("action") == "adjust", F.col("aff_end_ds"))
        .alias("original_end_ds"),
        F.when(F.col("action") == "readjust", F.col("adj_original_n_tasks")).when(F.col("action") == "adjust", F.col("aff_n_tasks"))
        .alias("original_n_tasks"),
        F.when(F.col("action") == "readjust", merge_metadata(F.col("adj_metadata"), pdate))
        .when(F.col("action") == "adjust", merge_metadata(F.col("aff_metadata"), pdate))
        .when(F.col("action") == "new", meta_new).alias("metadata"),
    )


def new_recommendation_id(start: Column, aiops_service: Column, region: Column) -> Column:
    """PRJ21: ``<start date>_<service>_<region>_nrt_generated``."""
    return F.concat_ws("_", F.date_format(start, "yyyy-MM-dd"), aiops_service, region, F.lit("nrt_generated"))


def expand_intervals(recs: DataFrame, step_seconds: int = 300, *, kind: str = "n_tasks", env: str = "prod") -> DataFrame:
    """GEN3 + PRJ21: each interval as rows every ``step`` from start to end,
    ``n_tasks`` as ``count``, keyed ``<interval>_<type>_<ts>_<env>``."""
    t = F.explode(F.sequence(F.unix_seconds("start_ds"), F.unix_seconds("end_ds"), F.lit(step_seconds).cast("bigint")))
    rows = recs.select("interval_id", F.col("n_tasks").alias("count"), t.alias("_t"))
    rows = rows.withColumn("ts", F.timestamp_seconds("_t")).drop("_t").withColumn("type", F.lit(kind))
    key = F.concat_ws("_", "interval_id", "type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(env))
    return rows.withColumn("id", key)


def tag_forecast(forecast: DataFrame, *, env: str, region: str, service: str, keys: Keys = ()) -> DataFrame:
    """SNK7 + PRJ20: tags, ``series_start`` = first time of the series, composite id."""
    f = forecast.withColumns({"env": F.lit(env), "region": F.lit(region), "service": F.lit(service)})
    first = F.min("ts").over(Window.partitionBy(*keys)) if keys else forecast.agg(F.min("ts")).scalar()
    f = f.withColumn("series_start", first)
    return f.withColumn("id", F.concat_ws("_", F.date_format("series_start", "yyyy-MM-dd'T'HH:mm:ss"), "service",
                                          "region", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "env"))
