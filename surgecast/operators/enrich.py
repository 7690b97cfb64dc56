"""F5 enrichment and F1 side joins: rankings, social metrics, task counts,
service info, aliases and keep-last dedupe.

Dimension-like inputs (rankings, service info, alias maps) have one row per
team/season or service and are broadcast; their size is fixed by the domain
(teams, services), not by traffic volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgecast.functions.text import map_values


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WIN7 without a window: ``max_by`` of the whole row per key.

    Aggregation is partial (map-side), so a hot key costs one row per
    partition before the shuffle, not all its rows.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("_r")).select(*keys, "_r.*")


def join_social_metrics(cal: DataFrame, social: DataFrame, keys: Sequence[str] = ("id", "date_utc")) -> DataFrame:
    """JON6: calendar left join social metrics on (id, date)."""
    return cal.join(social, list(keys), "left")


def join_task_counts(df: DataFrame, tasks: DataFrame, ts: str = "date_utc", tasks_ts: str = "datetime") -> DataFrame:
    """JON7: scheduled task count at exactly the event time (left join)."""
    t = tasks.select(F.col(tasks_ts).alias("_tts"), "n_tasks")
    return df.join(t, F.col(ts) == F.col("_tts"), "left").drop("_tts")


def join_rankings(
    cal: DataFrame,
    rankings: DataFrame,
    *,
    season: str = "season",
    teams: Sequence[str] = ("team_0_display_name", "team_1_display_name"),
) -> DataFrame:
    """JON17: rank of each team in the event's season -> rank_0, rank_1."""
    out = cal
    for i, team in enumerate(teams):
        r = rankings.select(
            F.col("team_name").alias(f"_t{i}"), F.col("year").alias(f"_y{i}"),
            F.col("league_rank").cast("double").alias(f"rank_{i}"),
        )
        out = out.join(
            r, (F.col(team) == F.col(f"_t{i}")) & (F.col(season) == F.col(f"_y{i}")), "left"
        ).drop(f"_t{i}", f"_y{i}")
    return out


def add_service_info(df: DataFrame, info: DataFrame, keys: Sequence[str] = ("service", "region")) -> DataFrame:
    """JON12: service account and cluster by (service, region); AQE broadcasts ``info`` if it proves small."""
    return df.join(info, list(keys), "left")


def duplicate_with_aliases(rankings: DataFrame, aliases: dict[str, str], col: str = "team_name") -> DataFrame:
    """SET2: rows whose team has a second name are appended under that name."""
    if not aliases:
        return rankings
    dup = rankings.where(F.col(col).isin(list(aliases))).withColumn(col, map_values(col, aliases))
    return rankings.unionByName(dup)


def add_missing(
    rankings: DataFrame, defaults: dict[str, int], *, col: str = "team_name", season: str = "year",
    value: str = "league_rank",
) -> DataFrame:
    """SET3: per season, add (team, default rank) for listed teams absent that season."""
    if not defaults:
        return rankings
    listed = F.array(*[F.struct(F.lit(k).alias(col), F.lit(v).cast("bigint").alias(value)) for k, v in defaults.items()])
    candidates = rankings.select(season).distinct().select(season, F.inline(listed))
    missing = candidates.join(rankings.select(col, season), [col, season], "left_anti")
    return rankings.unionByName(missing.select(*[F.col(c).cast(rankings.schema[c].dataType) for c in rankings.columns]))


def rankings_from_mapping(rankings: DataFrame, mapping: dict[str, str], col: str = "team_name") -> DataFrame:
    """PRJ16: team names replaced by their calendar names."""
    return rankings.withColumn(col, map_values(col, mapping))
