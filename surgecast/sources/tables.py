"""Driver tables and the reference-shaped inputs derived from them.

The reference reads watch traffic, service traffic, a baseline forecast, a
sport calendar, airings, task counts and service metrics. The driver ships a
TPC-H-like star schema plus an ``events`` table; the functions here derive the
reference inputs from those tables as lazy DataFrames (nothing is collected),
so every downstream operator scales with the driver tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.session import prepare_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def money(c) -> F.Column:
    """Exact two-decimal view of a money-like double (driver values have two decimals)."""
    return F.col(c).cast("decimal(12,2)") if isinstance(c, str) else c.cast("decimal(12,2)")


def money_sum(c) -> F.Column:
    """Sum through decimal so the total is exact and engine independent."""
    return F.sum(money(c)).cast("double")


def hour_of(ts: str = "ts") -> F.Column:
    return F.date_trunc("hour", F.col(ts))


def spread_days(user: str) -> F.Column:
    """0 to 28 days by user, so that events of all users fill a month."""
    return F.make_dt_interval(days=(F.col(user) % 29).cast("int"))


class Tables:
    """Lazy accessors for the driver's parquet tables in one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    # ---- reference-shaped views (FIXTURES.md section 2) -------------------

    @cached_property
    def watch_traffic(self) -> DataFrame:
        """Per-event watch counts at the grain: id, sport, league, starttime, cnt."""
        ev = self.events
        return (
            ev.groupBy(
                F.col("user_id").alias("id"),
                F.col("event_type").alias("sport"),
                hour_of().alias("starttime"),
            )
            .agg(F.count(F.lit(1)).alias("cnt"))
            .withColumn("league", F.concat(F.lit("L"), (F.col("id") % 4).cast("string")))
            .select("id", "sport", "league", "starttime", "cnt")
        )

    @cached_property
    def service_traffic(self) -> DataFrame:
        return self.events.groupBy(hour_of().alias("datetime")).agg(money_sum("value").alias("service_count"))

    @cached_property
    def baseline(self) -> DataFrame:
        by_hour = Window.partitionBy(F.hour("datetime"))
        return self.service_traffic.select(
            F.col("datetime").alias("ds"),
            (F.lit(0.8) * F.avg("service_count").over(by_hour)).alias("baseline_count"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Scheduled events: one per user, two nation names as teams."""
        ev = self.events
        first_seen = (
            ev.groupBy(F.col("user_id").alias("id"))
            .agg((F.date_trunc("minute", F.min("ts")) + spread_days("user_id")).alias("date_utc"))
        )
        n0 = self.nation.select(F.col("n_nationkey").alias("k0"), F.col("n_name").alias("team_0_display_name"))
        n1 = self.nation.select(F.col("n_nationkey").alias("k1"), F.col("n_name").alias("team_1_display_name"))
        idc = F.col("id")
        return (
            first_seen.join(F.broadcast(n0), n0.k0 == idc % 25)
            .join(F.broadcast(n1), n1.k1 == (idc + 7) % 25)
            .select(
                "id",
                F.concat_ws(" at ", "team_0_display_name", "team_1_display_name").alias("name"),
                F.concat(F.lit("L"), (idc % 4).cast("string")).alias("league"),
                F.when(idc % 3 == 0, "click").when(idc % 3 == 1, "view").otherwise("purchase").alias("sport"),
                "date_utc",
                (F.col("date_utc") + F.make_dt_interval(mins=(60 + idc % 180).cast("int"))).alias(
                    "end_with_avg_duration"
                ),
                "team_0_display_name",
                "team_1_display_name",
                F.when(idc % 4 == 0, "A|B").when(idc % 4 == 1, "A,C").when(idc % 4 == 2, "B").alias("media"),
                F.when(idc % 5 == 0, F.lit(None).cast("string"))
                .otherwise(F.concat(F.lit("V"), (idc % 7).cast("string")))
                .alias("venue"),
            )
        )

    @cached_property
    def airings(self) -> DataFrame:
        return self.lineitem.select(
            (F.col("l_orderkey") % 200).alias("event_id"),
            (F.col("l_orderkey") % 200).cast("string").alias("game_id"),
            F.when(F.col("l_linenumber") == 3, F.lit(None).cast("string"))
            .otherwise(F.concat("l_returnflag", "l_linestatus"))
            .alias("network_name"),
        )

    @cached_property
    def scheduled_tasks(self) -> DataFrame:
        return self.events.groupBy(hour_of().alias("datetime")).agg(
            F.ceil(money_sum("value") / 100).cast("bigint").alias("n_tasks")
        )

    @cached_property
    def predictions_full(self) -> DataFrame:
        def part(kind: str) -> F.Column:
            hit = (F.col("event_type") == kind) & (F.col("value") > 40)  # extra traffic: high values only
            return F.coalesce(F.sum(F.when(hit, money("value"))).cast("double"), F.lit(0.0))

        return self.events.groupBy(hour_of().alias("ds")).agg(
            money_sum("value").alias("total"),
            part("click").alias("click"),
            part("view").alias("view_"),
            part("purchase").alias("purchase"),
        )

    @cached_property
    def service_metrics(self) -> DataFrame:
        n = F.count(F.lit(1))
        return self.events.groupBy(hour_of().alias("datetime")).agg(
            money_sum("value").alias("traffic"),
            (money_sum("value") / n).alias("cpu_util"),
            (F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).cast("double") / n).alias("error_rate"),
            F.max("value").alias("response_time"),
            F.countDistinct("user_id").alias("running_ecs"),
        )

    @cached_property
    def series(self) -> DataFrame:
        """Long-form regular series: series_id, ts, value (hour grain)."""
        return self.events.groupBy(F.col("event_type").alias("series_id"), hour_of().alias("ts")).agg(
            money_sum("value").alias("value")
        )

    @cached_property
    def anomaly_points(self) -> DataFrame:
        return self.events.where(F.col("value") > 40).select(
            F.col("event_type").alias("series_id"), "ts", "value"
        )

    @cached_property
    def scored(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_returnflag").alias("model"),
            F.col("l_extendedprice").alias("y"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("yhat"),
        )

    @cached_property
    def rankings(self) -> DataFrame:
        return self.nation.select(
            F.col("n_name").alias("team_name"),
            F.lit(2024).alias("year"),
            (F.col("n_nationkey") + 1).alias("league_rank"),
        )

    @cached_property
    def service_info(self) -> DataFrame:
        r = F.col("r_regionkey")
        return self.region.select(
            F.concat(F.lit("svc"), r.cast("string")).alias("service"),
            F.col("r_name").alias("region"),
            (1000 + r).cast("string").alias("account_id"),
            F.concat(F.lit("cl-"), F.col("r_name")).alias("cluster_name"),
        )

    @cached_property
    def ranking_pages(self) -> DataFrame:
        """HTML ranking tables of at most 50 customers each, by account balance."""
        page = F.floor(F.col("c_custkey") / 50).cast("bigint")
        rank = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("c_acctbal"), "c_custkey"))
        ranked = self.customer.select(page.alias("page_id"), "c_custkey", "c_name", "c_acctbal").withColumn("rank", rank)
        row = F.concat(F.lit("<tr><td>"), F.col("rank").cast("string"), F.lit("</td><td> <b>"), "c_name", F.lit("</b></td></tr>"))
        rows = F.array_sort(F.collect_list(F.struct("rank", row.alias("row"))))
        return ranked.groupBy("page_id").agg(F.concat(
            F.lit("<table><tr><th>Rk</th><th>Team</th></tr>"), F.array_join(F.transform(rows, lambda r: r["row"]), ""), F.lit("</table>")).alias("html"))
