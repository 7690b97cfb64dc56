"""Query registry shared by ``__spark_entry__``, the bench and the tests.

A query is ``fn(spark, sf_dir) -> DataFrame``. The oracle is ANSI SQL that
DuckDB runs over the same parquet tables (registered as views by name); the
reference-shaped inputs are spelled as CTEs from ``oracle_views``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def decimal_round(sql: str, digits: int = 6) -> str:
    """Rewrite ``round(x, 6)`` in oracle SQL to round the shortest decimal text.

    Spark rounds a double half-up on its shortest decimal text; DuckDB rounds
    the binary value. Near decimal ties (sums divided by 2^k) they part;
    rounding DuckDB's shortest text through a decimal gives Spark's rule.
    """
    key = "round("
    out, i = [], 0
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i : j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth and k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key) : k - 1]
        tail = f", {digits}"
        if inner.rstrip().endswith(tail):
            arg = decimal_round(inner.rstrip()[: -len(tail)], digits)
            x = f"cast({arg} AS double)"
            out.append(
                sql[i:j] + f"(CASE WHEN isfinite({x}) THEN cast(round(cast(cast({x} AS varchar) AS "
                f"decimal(38,18)), {digits}) AS double) ELSE {x} END)"
            )
        else:
            out.append(sql[i:j] + key + decimal_round(inner, digits) + ")")
        i = k


def query(name: str, *, ops: tuple[str, ...] | list[str] = (), sql: str | None = None):
    """Decorator registering a Spark query and (optionally) its oracle SQL."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, decimal_round(sql) if sql else None, tuple(ops))
        return fn

    return wrap


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Normalise output types so both engines agree on schema and values.

    Integers widen to bigint, floating values are rounded to ``digits``,
    zoned timestamps become naive (UTC) timestamps.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(t, T.DecimalType):
            c = F.round(c.cast("double"), digits)
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.DateType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.BooleanType):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
