"""Sinks: every write is a DataFrame writer call; Spark commits the output
atomically per job and writes the ``_SUCCESS`` marker itself."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex[:12]}"


def save_processed(df: DataFrame, path: str, *, fmt: str = "csv", header: bool = False,
                   exclude: Sequence[str] = (), mode: str = "overwrite") -> str:
    """SNK1: write without the excluded columns; refuse an empty frame."""
    if df.isEmpty():
        raise ValueError(f"refusing to write an empty frame to {path}")
    out = df.drop(*exclude)
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def save_feature_names(df: DataFrame, path: str, exclude: Sequence[str] = ()) -> str:
    """SNK2: the feature column names as a one-column table (from the schema, not data)."""
    names = [c for c in df.columns if c not in set(exclude)]
    spark = df.sparkSession
    spark.createDataFrame([(n,) for n in names], "feature string").coalesce(1).write.mode("overwrite").csv(path)
    return path


def append_snapshot(df: DataFrame, root: str, partition_cols: Sequence[str] = ("prediction_date", "service", "region")) -> str:
    """SNK3: append a tagged snapshot, partitioned; new columns are allowed
    (read back with ``mergeSchema``)."""
    df.write.mode("append").partitionBy(*partition_cols).parquet(root)
    return root


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """SNK3 / SET4 read side: all snapshots with merged (add-only) schema.

    Partition values are tags (text); type inference would turn dates into
    DATE, so they are read back as strings."""
    df = spark.read.option("mergeSchema", "true").parquet(root)
    return df.withColumns({c: F.col(c).cast("string") for c in ("prediction_date", "service", "region") if c in df.columns})


def _touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file through Hadoop's FileSystem (any scheme)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(jpath, True).close()


def write_dated(df: DataFrame, root: str, date_col: str = "date", fmt: str = "parquet") -> str:
    """SNK4: dated folders ``date=<d>`` replaced partition by partition, each
    with a ``_SUCCESS`` marker once the job has committed.

    Dynamic partition overwrite commits through a staging folder, which does
    not leave Spark's own marker in place, so after the commit every folder
    without a marker (a rewritten folder has lost its own) gets one."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").partitionBy(date_col).format(fmt).save(root)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
    jroot = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = jroot.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in [s.getPath() for s in fs.listStatus(jroot) if s.getPath().getName().startswith(f"{date_col}=")]:
        marker = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        if not fs.exists(marker):
            fs.create(marker, True).close()
    _touch(spark, f"{root.rstrip('/')}/_SUCCESS")
    return root


def write_report(df: DataFrame, path: str) -> str:
    """SNK8: a (small) report frame as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def cast_objects_to_string(df: DataFrame) -> DataFrame:
    """PRJ19: arrays become comma-joined text, maps / structs JSON text; scalars stay."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if t == "array":
            c = F.array_join(c.cast("array<string>"), ",")
        elif t in ("map", "struct"):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
