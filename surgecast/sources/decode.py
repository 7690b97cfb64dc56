"""Decoders for saved replies and pages: HTML ranking tables, metric replies,
point lists and score files. All run as column expressions over a table of
texts, so they scale with the number of pages / replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_RE = r"(?s)<tr[^>]*>(.*?)</tr>"
CELL_RE = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"
TAG_RE = r"<[^>]+>"


def html_table_rows(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """SRC11 (first half): one row per ``<tr>`` with its cell texts (tags removed, trimmed)."""
    rows = pages.select(*keys, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(ROW_RE), 1)).alias("row_no", "tr"))
    cells = F.transform(
        F.regexp_extract_all(F.col("tr"), F.lit(CELL_RE), 1), lambda c: F.trim(F.regexp_replace(c, TAG_RE, ""))
    )
    return rows.select(*keys, "row_no", cells.alias("cells"))


def ranking_table(
    pages: DataFrame, season, *, html: str = "html", keys: tuple[str, ...] = ("page_id",), skip_rows: int = 2
) -> DataFrame:
    """SRC11: ranking rows (league_rank, team_name, year) from pages whose
    header row starts with ``Rk, Team``; the first ``skip_rows`` rows
    (header and the row after it) are skipped, as in the reference."""
    rows = html_table_rows(pages, html, keys)
    header_ok = (
        rows.where(F.col("row_no") == 0)
        .where((F.element_at("cells", 1) == "Rk") & (F.element_at("cells", 2) == "Team"))
        .select(*keys)
    )
    data = rows.where(F.col("row_no") >= skip_rows).join(header_ok, list(keys), "left_semi")
    return data.select(
        *keys,
        F.col("row_no"),
        F.element_at("cells", 2).alias("team_name"),
        F.lit(season).cast("int").alias("year") if not isinstance(season, F.Column) else season.alias("year"),
        F.element_at("cells", 1).cast("int").alias("league_rank"),
    )


METRIC_REPLY = T.StructType(
    [
        T.StructField("startDate", T.StringType()),
        T.StructField("endDate", T.StringType()),
        T.StructField(
            "metrics",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "dataset",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("seriesName", T.StringType()),
                                        T.StructField("set", T.ArrayType(T.DoubleType())),
                                    ]
                                )
                            ),
                        )
                    ]
                )
            ),
        ),
    ]
)


def decode_metric_reply(replies: DataFrame, series: list[str], *, reply: str = "reply", key: str = "id") -> DataFrame:
    """SRC12: ``metrics[0].dataset[*]`` -> column ``netbase_metric_<series lower>``
    holding ``set[0]``; millisecond epochs -> start/end timestamps.

    The pivot values are given explicitly (no extra pass to find them).
    """
    parsed = replies.select(key, F.from_json(F.col(reply), METRIC_REPLY).alias("r"))
    base = parsed.select(
        key,
        F.timestamp_millis(F.col("r.startDate").cast("bigint")).alias("netbase_start_date"),
        F.timestamp_millis(F.col("r.endDate").cast("bigint")).alias("netbase_end_date"),
    )
    ds = parsed.select(key, F.explode(F.element_at("r.metrics", 1).getField("dataset")).alias("d")).select(
        key,
        F.concat(F.lit("netbase_metric_"), F.lower("d.seriesName")).alias("metric"),
        F.element_at("d.set", 1).alias("v"),
    )
    names = [f"netbase_metric_{s.lower()}" for s in series]
    wide = ds.groupBy(key).pivot("metric", names).agg(F.last("v"))
    return base.join(wide, key, "left")


POINT_REPLY = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("series", T.ArrayType(T.StructType([T.StructField("pointlist", T.ArrayType(T.ArrayType(T.DoubleType())))]))),
    ]
)


def decode_point_list(replies: DataFrame, *, reply: str = "reply", keys: tuple[str, ...] = ()) -> DataFrame:
    """SRC13: ``series[0].pointlist`` of ``[ms, value]`` -> ``datetime, count``."""
    parsed = replies.select(*keys, F.from_json(F.col(reply), POINT_REPLY).alias("r"))
    pts = parsed.select(*keys, F.explode(F.element_at("r.series", 1).getField("pointlist")).alias("p"))
    return pts.select(
        *keys,
        F.timestamp_millis(F.element_at("p", 1).cast("bigint")).alias("datetime"),
        F.element_at("p", 2).alias("count"),
    )


def parse_scores(lines: DataFrame, col: str = "value") -> DataFrame:
    """SRC14: a number per line, or a JSON object with ``score``."""
    v = F.col(col)
    return lines.withColumn(
        "score", F.coalesce(v.try_cast("double"), F.get_json_object(v, "$.score").try_cast("double"))
    )
