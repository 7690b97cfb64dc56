"""Session set-up: UTC clock, ANSI arithmetic, adaptive execution.

On a cluster the session is created by the platform; ``prepare_session`` only
sets the few SQL options the operators depend on and never overrides a
checkpoint directory the cluster already names.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Options every operator relies on; all are runtime SQL options.
SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Arrow batches bounded in bytes: long texts else make batches of tens of MB in the JVM and in each Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on executors (grouped pandas functions and
    stateful streaming functions are pickled by module reference).

    The package's ``.py`` files are zipped once per Spark application and
    added with ``addPyFile``, which distributes them to every executor, as
    ``--py-files`` would at submit time.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="surgecast-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the options the operators need on an existing session and ship the
    package to the executors."""
    for key, value in SQL_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "surgecast") -> SparkSession:
    """Build (or reuse) a session for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SURGECAST_DRIVER_MEMORY", "16g"))
    )
    for key, value in SQL_OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named in ``spark.checkpoint.dir``.

    A cluster names a shared, durable folder there; that value is always used.
    Only a session whose executors are threads of the driver (``local[n]``:
    tests, bench) may do without; it gets a scratch folder. Any other session
    without the setting is an error, since executors cannot share a folder of
    the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="surgecast-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def materialize(df, enabled: bool = True):
    """Reliable checkpoint of ``df`` in the shared checkpoint folder.

    Cuts the lineage so later stages (and several actions on the same data)
    start from the written result; it survives executor loss, unlike a local
    checkpoint.
    """
    if not enabled:
        return df
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark removes the shuffle files of an action when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Narrow tables of at most this many rows are small.
SMALL_ROWS = 1 << 16


def step(df):
    """``materialize`` for jobs of many rounds: the shuffle files that lead to the
    result go once it is written. Spark else keeps those of all rounds until the
    driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, None)
    conf.set(FREE_SHUFFLES, "true")
    try:
        return materialize(df.select("*"))  # a plan of its own, whose exchanges nothing else reads
    finally:
        conf.unset(FREE_SHUFFLES) if before is None else conf.set(FREE_SHUFFLES, before)


def packed(df, rows: int | None = None):
    """A materialized ``df`` of narrow rows; a small one in one partition, to be
    broadcast in joins.

    Out of an exchange it has a partition for each shuffle partition, and Spark's
    estimate of its size grows with each join before it; so every further join would
    deal a few rows over all of them. Larger tables stay as they are. ``rows``:
    their number, if known.
    """
    rows = df.count() if rows is None else rows
    return F.broadcast(df.coalesce(1)) if rows <= SMALL_ROWS else df
