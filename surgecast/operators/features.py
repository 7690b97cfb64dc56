"""F2 feature preparation: snapshots, vocabularies, encodings, scaling, splits.

Vocabularies are the one thing collected to the driver: they are bounded by
the number of categories (leagues, weekdays, media lists, teams), not by
rows, and they become column names. Everything else stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOOKKEEPING = ["eventtime", "prediction_date", "write_time", "api_invocation_time", "is_deleted", "service", "region"]
UNKNOWN_COMPETITOR = "Unknown_competitor"


def tag_snapshot(df: DataFrame, *, event_time, prediction_date: str, service: str, region: str,
                 data_type: str | Column | None = None) -> DataFrame:
    """PRJ20: snapshot tags added to a feature frame before it is appended."""
    tags = {
        "eventtime": F.lit(event_time).cast("string"),
        "prediction_date": F.lit(prediction_date),
        "service": F.lit(service),
        "region": F.lit(region),
        "write_time": F.current_timestamp(),
        "api_invocation_time": F.current_timestamp(),
        "is_deleted": F.lit(False),
    }
    if data_type is not None:
        tags["data_type"] = data_type if isinstance(data_type, Column) else F.lit(data_type)
    return df.withColumns(tags)


def latest_snapshot(snapshots: DataFrame, prediction_date: str, service: str, region: str) -> DataFrame:
    """SRC10: rows of the newest ``eventtime`` for (prediction_date, service,
    region), not deleted, distinct, without bookkeeping columns."""
    scope = (F.col("prediction_date") == prediction_date) & (F.col("service") == service) & (F.col("region") == region)
    newest = snapshots.where(scope).agg(F.max("eventtime")).scalar()
    rows = snapshots.where(scope & (F.col("eventtime") == newest) & ~F.col("is_deleted"))
    return rows.drop(*[c for c in BOOKKEEPING if c in rows.columns]).dropDuplicates()


def new_columns(current: DataFrame, incoming: DataFrame) -> list[tuple[str, str]]:
    """SET4: columns of ``incoming`` not yet in ``current`` (schema evolution, add-only)."""
    have = {f.name for f in current.schema.fields}
    return [(f.name, f.dataType.simpleString()) for f in incoming.schema.fields if f.name not in have]


#: A category becomes an output column; more of them than this are a mistake in the choice of columns.
MAX_CATEGORIES = 10_000


def _bounded(names: DataFrame, what: str) -> list:
    """The values of a one-column frame of distinct values, in order; too many are an error."""
    got = [r[0] for r in names.distinct().limit(MAX_CATEGORIES + 1).collect()]
    if len(got) > MAX_CATEGORIES:
        raise ValueError(f"{what} has more than {MAX_CATEGORIES} categories")
    return sorted(got)


def fit_vocabulary(calendar: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """AGG12: sorted distinct non-null categories per column, in one job. More
    than ``MAX_CATEGORIES`` in a column are an error."""
    sizes = calendar.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    for c in cols:
        if sizes[c] > MAX_CATEGORIES:
            raise ValueError(f"{c} has more than {MAX_CATEGORIES} categories")
    row = calendar.select(*[F.array_sort(F.collect_set(F.col(c))).alias(c) for c in cols]).first()
    return {c: list(row[c] or []) for c in cols}


def fit_competitors(calendar: DataFrame, cols: Sequence[str]) -> list[str]:
    """AGG12 (second form): distinct competitors over several columns, nulls as unknown."""
    names = calendar.select(F.explode(F.array(*[F.coalesce(F.col(c), F.lit(UNKNOWN_COMPETITOR)) for c in cols])).alias("n"))
    return _bounded(names, "the competitors")


def _name(col: str, cat) -> str:
    return f"{col}_{cat}"


def one_hot(df: DataFrame, vocab: dict[str, list], drop: bool = True) -> DataFrame:
    """ML1: ``<col>_<category>`` indicators in vocabulary order; unknown -> all zero."""
    cols = {_name(c, v): F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0)) for c, cats in vocab.items() for v in cats}
    out = df.withColumns(cols)
    return out.drop(*vocab) if drop else out


def multi_hot(df: DataFrame, cols: Sequence[str], competitors: Sequence[str], prefix: str = "team_") -> DataFrame:
    """ML2: one count per competitor over the given columns (a team twice gives 2)."""
    filled = [F.coalesce(F.col(c), F.lit(UNKNOWN_COMPETITOR)) for c in cols]
    ind = {}
    for comp in competitors:
        total = None
        for f in filled:
            term = (f == F.lit(comp)).cast("int")
            total = term if total is None else total + term
        ind[f"{prefix}{comp}"] = total
    return df.withColumns(ind)


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """ML3: scale with mean and population std fitted on the rows where
    ``fit_on`` holds (the training split), applied to every row.

    The statistics are scalar subqueries over the fitting rows; a zero std
    leaves the centred value (as the reference's scaler does).
    """
    fit = df if fit_on is None else df.where(fit_on)
    out = {}
    for c in cols:
        mu, sd = fit.agg(F.avg(c)).scalar(), fit.agg(F.stddev_pop(c)).scalar()
        out[c] = F.when(sd == 0, F.col(c) - mu).otherwise((F.col(c) - mu) / sd)
    return df.withColumns(out)


def validation_start(df: DataFrame, ts: str, before, n_events: int) -> Column:
    """AGG13: earliest time among the last ``n_events`` rows before ``before``
    (a distributed top-n, then a min), as a scalar subquery."""
    b = F.lit(before).cast(df.schema[ts].dataType)
    last_n = df.where(F.col(ts) < b).orderBy(F.col(ts).desc()).limit(n_events)
    return last_n.agg(F.min(ts)).scalar()


def split_label(ts: str, start_val, start_test) -> Column:
    """ML4: 'train' before ``start_val``, 'val' until ``start_test``, then 'test'."""
    c = F.col(ts)
    lab = F.when(c < start_val, "train")
    if start_test is not None:
        lab = lab.when(c < start_test, "val").otherwise("test")
    else:
        lab = lab.otherwise("val")
    return lab


def select_model_features(df: DataFrame, features: Sequence[str], target: str, ds: str = "date_utc") -> DataFrame:
    """PRJ18: ``y`` first (null when the target is absent), features, ``id``, ``ds``."""
    y = F.col(target).cast("double") if target in df.columns else F.lit(None).cast("double")
    dsc = F.col(ds) if ds in df.columns else F.col("ds")
    return df.select(y.alias("y"), *features, "id", dsc.alias("ds"))
