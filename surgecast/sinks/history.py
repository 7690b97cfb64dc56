"""Evaluation reports and the history of their metrics (SNK8, AGG11, ML8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.sinks.files import write_report
from surgecast.sinks.tables import PublishedTable


def metrics_history(spark: SparkSession, root: str, keys: tuple[str, ...] = ("model",)) -> PublishedTable:
    """Append-only history: a run's rows are told apart by ``keys``, a run is a partition."""
    return PublishedTable(spark, root, list(keys), partition="run_id")


def append_run(history: PublishedTable, metrics: DataFrame, run_id: str, created_at: str, approved: bool, report: str) -> int:
    """Write a run's report, then append what the report says to the history.

    A run that is repeated with the same metrics changes nothing; one with other
    metrics replaces its own rows and no other's. Returns the history's version."""
    write_report(metrics, report)
    said = metrics.sparkSession.read.schema(metrics.schema).json(report)
    tagged = said.withColumns({"run_id": F.lit(run_id), "created_at": F.lit(created_at).cast("timestamp"), "approved": F.lit(approved)})
    return history.upsert(tagged).number


def decide_run(history: PublishedTable, run_id: str, approved: bool) -> int:
    """Approve a run, or take the approval back."""
    rows = history.read([run_id])
    return history.upsert(rows.withColumn("approved", F.lit(approved))).number
