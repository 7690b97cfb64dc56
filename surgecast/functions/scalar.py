"""Scalar ratios, scales and numeric transforms used by the feature build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def influence(event_count: ColumnOrName, coevent_count: ColumnOrName) -> Column:
    """PRJ5: share of an event in all traffic at that time (null on zero divisor)."""
    return F.try_divide(_c(event_count).cast("double"), _c(coevent_count).cast("double"))


def on_service_scale(service_count: ColumnOrName, infl: ColumnOrName) -> Column:
    """PRJ6: event traffic expressed in service requests."""
    return _c(service_count) * _c(infl)


def extra_on_service_scale(service_count: ColumnOrName, baseline: ColumnOrName, infl: ColumnOrName) -> Column:
    """PRJ7: the model target, max(service - baseline, 0) * influence."""
    return F.greatest(_c(service_count) - _c(baseline), F.lit(0.0)) * _c(infl)


def sample_weight(y: ColumnOrName) -> Column:
    """PRJ17: sqrt(y); future rows carry a -1 sentinel and get a null weight."""
    return F.when(_c(y) >= 0, F.sqrt(_c(y)))


def percent_diff(a: ColumnOrName, b: ColumnOrName) -> Column:
    """PRJ26: 100 (a - b) / b, rounded half-to-even to an integer; null when b = 0."""
    return F.bround(F.try_divide(F.lit(100.0) * (_c(a) - _c(b)), _c(b)), 0)


def slope_degrees(first: ColumnOrName, last: ColumnOrName) -> Column:
    """PRJ27: degrees(1 - first / last)."""
    return F.degrees(F.lit(1.0) - F.try_divide(_c(first).cast("double"), _c(last).cast("double")))


def clip_lower(x: ColumnOrName, lower: float = 1.0) -> Column:
    """PRJ28: values below ``lower`` become ``lower``."""
    return F.greatest(_c(x), F.lit(lower))


def any_positive(cols: list[str]) -> Column:
    """FIL9: true when some column is > 0 (nulls count as not positive)."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > 0, F.lit(False)) for c in cols])


def exact_sum(x: ColumnOrName, over=None) -> Column:
    """Sum through decimal(30,10): the total does not depend on summation order,
    so a result is the same for any partitioning (and in any engine).
    ``over`` is an optional window spec."""
    s = F.sum(_c(x).cast("decimal(30,10)"))
    return (s.over(over) if over is not None else s).cast("double")
