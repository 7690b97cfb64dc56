"""As-of partition scans and tiered unions (SRC4-SRC6, SET5).

The chosen partition is a scalar subquery over the partition column, so on a
partitioned table only that folder is read (dynamic partition pruning).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _lit(v, like: DataFrame, col: str) -> Column:
    return F.lit(v).cast(like.schema[col].dataType)


def asof_partition(df: DataFrame, part_col: str, as_of, *, min_exclusive=None) -> DataFrame:
    """SRC4 / SRC5: rows of the greatest partition value <= ``as_of`` (and
    > ``min_exclusive`` when given); empty when none qualifies."""
    cond = F.col(part_col) <= _lit(as_of, df, part_col)
    if min_exclusive is not None:
        cond = cond & (F.col(part_col) > _lit(min_exclusive, df, part_col))
    best = df.where(cond).agg(F.max(part_col)).scalar()
    return df.where(F.col(part_col) == best)


def gap_files(df: DataFrame, left, right, *, file_col: str = "file_name", ts: str = "datetime") -> DataFrame:
    """SRC6: files named ``<from>_<to>`` whose span overlaps (left, right];
    rows inside (left, right], one per time (the newest file wins).

    A file that covers the whole range counts (true overlap)."""
    lo = F.to_timestamp(F.regexp_extract(F.col(file_col), r"^([^_]+)_", 1))
    hi = F.to_timestamp(F.regexp_extract(F.col(file_col), r"_([^_]+)$", 1))
    l_, r_ = F.lit(left).cast("timestamp"), F.lit(right).cast("timestamp")
    files = df.withColumns({"_lo": lo, "_hi": hi}).where((F.col("_lo") <= r_) & (F.col("_hi") > l_))
    rows = files.where((F.col(ts) > l_) & (F.col(ts) <= r_))
    w = Window.partitionBy(ts).orderBy(F.col("_hi").desc(), F.col(file_col).desc())
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_lo", "_hi")


def tiered_union(tiers: Sequence[DataFrame], keys: Sequence[str], ts: str = "datetime", min_gap_seconds: Sequence[int] | None = None) -> DataFrame:
    """SET5: tier k contributes only rows strictly after the newest time of
    tiers 0..k-1 (plus its minimum gap); the result is the bag union."""
    kc = list(keys)
    gaps = list(min_gap_seconds or [0] * len(tiers))
    out = None
    for k, t in enumerate(tiers):
        part = t.withColumn("tier", F.lit(k))
        if out is not None:
            newest = out.groupBy(*kc).agg(F.max(ts).alias("_newest")) if kc else None
            if kc:
                part = part.join(newest, kc, "left").where(
                    F.col("_newest").isNull() | (F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(F.col("_newest").cast("timestamp")) >= max(gaps[k], 1))
                ).drop("_newest")
            else:
                nv = out.agg(F.max(ts)).scalar()
                part = part.where(F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(nv.cast("timestamp")) >= max(gaps[k], 1))
            out = out.unionByName(part)
        else:
            out = part
    return out
