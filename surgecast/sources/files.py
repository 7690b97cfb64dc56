"""File scans: partitioned Parquet, CSV unions, single traffic files, JSON dictionaries.

All scans declare their schema (no inference) and leave filters and column
selection to Catalyst, so partition filters prune folders and the Parquet
reader gets pushed filters and a pruned read schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def watch_traffic_scan(spark: SparkSession, root: str, *, year=None, sport=None, league=None, client=None,
                       fields: Sequence[str] = ("id", "sport", "league", "starttime", "cnt")) -> DataFrame:
    """SRC1: partitioned scan (``year / sport_partition / league_partition``) with
    optional pruning, client filter, projection and ``sport_league``."""
    df = spark.read.parquet(root)
    cond = F.lit(True)
    if year is not None:
        cond = cond & (F.col("year") == year)
    if sport is not None:
        cond = cond & (F.col("sport_partition") == sport)
    if league is not None:
        cond = cond & (F.col("league_partition") == league)
    if client is not None:
        cond = cond & (F.col("client_app") == client)
    out = df.where(cond).select(*fields, "year")
    return out.withColumn("sport_league", F.concat_ws("/", "sport", "league"))


def csv_union(spark: SparkSession, pattern: str, schema: T.StructType | str, *, latest_only: bool = False,
              header: bool = True) -> DataFrame:
    """SRC2 / SRC7: union of CSV files, or only the most recently modified one."""
    df = spark.read.schema(schema).option("header", header).csv(pattern).withColumn(
        "_mtime", F.col("_metadata.file_modification_time")).withColumn("_file", F.col("_metadata.file_path"))
    if latest_only:
        newest = df.agg(F.max_by("_file", F.struct("_mtime", "_file"))).scalar()
        df = df.where(F.col("_file") == newest)
    return df.drop("_mtime", "_file")


def traffic_scan(df: DataFrame, *, ts: str = "datetime", history_days: int = 0,
                 rename: dict[str, str] | None = None, drop: Sequence[str] = ("ingest_date",)) -> DataFrame:
    """SRC3: drop ingest bookkeeping, UTC time, history window ``[max - n d, max]``,
    time parts, renames (missing names ignored)."""
    from surgecast.functions.timeparts import with_time_parts

    out = df.drop(*drop).withColumn(ts, F.col(ts).cast("timestamp"))
    if history_days > 0:
        mx = out.agg(F.max(ts)).scalar()
        out = out.where(F.col(ts) >= mx - F.make_dt_interval(days=F.lit(history_days)))
    out = with_time_parts(out, ts)
    return out.withColumnsRenamed({k: v for k, v in (rename or {}).items() if k in out.columns})


def latest_per_file_key(df: DataFrame, key: str = "id") -> DataFrame:
    """SRC8: newest file wins per key (file path order = date folders)."""
    from surgecast.operators.enrich import latest_per_key

    with_file = df.withColumn("_file", F.col("_metadata.file_path"))
    return latest_per_key(with_file, [key], ["_file"]).drop("_file")


def dictionary_lookup(mapping: Column, key: Column, default_key: str = "default") -> Column:
    """SRC9: ``m[key]`` falling back to ``m['default']``."""
    return F.coalesce(F.try_element_at(mapping, key), F.try_element_at(mapping, F.lit(default_key)))


def read_json_dictionary(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """SRC9: a small JSON dictionary (one object per line) with a declared schema."""
    return spark.read.schema(schema).json(path)


def nested_lookup(df: DataFrame, dictionary: DataFrame, key: str, inner: str, out: str, default_key: str = "default") -> DataFrame:
    """SRC9: ``dictionary[key][inner]`` for each row, ``dictionary`` having columns
    (``key``, models map). An unknown inner key takes its map's default, an
    unknown key the default key's map. Keys of the dictionary are taken to be
    distinct; a row without any match has null."""
    own = dictionary.select(F.col(key), F.col("models").alias("_own"))
    rest = dictionary.where(F.col(key) == default_key).select(F.col("models").alias("_rest"))
    found = df.join(own, key, "left").withColumn("_rest", rest.agg(F.first("_rest")).scalar())
    model = F.coalesce(dictionary_lookup(F.col("_own"), F.col(inner), default_key), dictionary_lookup(F.col("_rest"), F.col(inner), default_key))
    return found.withColumn(out, model).drop("_own", "_rest")


#: Columns of a saved recommendation.
RECOMMENDATION = "interval_id string, service string, start_ds timestamp, end_ds timestamp, n_tasks long"


def read_recommendations(spark: SparkSession, root: str, part: str = "day") -> DataFrame:
    """SRC5: JSON recommendations in dated folders; the folder's date is a column,
    so a choice of dates reads the chosen folders only."""
    return spark.read.schema(f"{RECOMMENDATION}, {part} date").json(root)
