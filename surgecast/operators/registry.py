"""Model versions with everything scoring needs (SNK10, ML7).

A version has a folder of its own: the fitted pipeline or boosted trees, the
category vocabulary and the scaler's statistics as tables. The list of versions with their approval
is a published table, so a version exists once all its parts are written, and
scoring resolves the newest approved one and reads nothing but its folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.operators import boosting as bo
from surgecast.operators import features as fe
from surgecast.sinks.tables import PublishedTable

APPROVED, PENDING, REJECTED = "Approved", "PendingManualApproval", "Rejected"
VERSIONS = "group string, version long, status string, path string, kind string, created_at timestamp"


@dataclass(frozen=True)
class Artefacts:
    """What a version was trained with, as read back."""

    version: int
    model: PipelineModel | bo.Boosted
    vocabulary: dict[str, list]
    scaler: dict[str, tuple[float, float]]

    def encode(self, df: DataFrame) -> DataFrame:
        """ML1 + ML3 with the version's own vocabulary and statistics: unknown
        categories are all zero, a zero deviation leaves the centred value."""
        out = fe.one_hot(df, self.vocabulary) if self.vocabulary else df
        return out.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in self.scaler.items()})


def fit_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """ML3 statistics of the fitting rows: mean and population deviation of each column, in one pass."""
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first() if cols else {}
    return {c: (float(row[f"m_{c}"] or 0.0), float(row[f"s_{c}"] or 0.0)) for c in cols}


class ModelRegistry:
    """Versions of groups of models (one group a service, region and kind)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.table = PublishedTable(spark, f"{self.root}/versions", ["version"], partition="group")

    def versions(self, group: str) -> DataFrame:
        """All versions of a group; none before the first."""
        v = self.table.version()
        return self.table.read([group], v) if v.number else self.spark.createDataFrame([], VERSIONS)

    def register(self, group: str, model: PipelineModel | bo.Boosted, vocabulary: dict[str, list], scaler: dict[str, tuple[float, float]],
                 created_at: str, status: str = PENDING) -> int:
        """Write a version's parts, then list it; returns its number."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        boosted = isinstance(model, bo.Boosted)
        if boosted:
            bo.to_table(self.spark, model).coalesce(1).write.parquet(f"{path}/model")
        else:
            model.write().save(f"{path}/model")
        words = [(c, i, str(v)) for c, cats in vocabulary.items() for i, v in enumerate(cats)]
        self.spark.createDataFrame(words, "feature string, position int, category string").coalesce(1).write.parquet(f"{path}/vocabulary")
        stats = [(c, m, s) for c, (m, s) in scaler.items()]
        self.spark.createDataFrame(stats, "feature string, mean double, deviation double").coalesce(1).write.parquet(f"{path}/scaler")
        version = int(self.versions(group).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]) + 1
        row = self.spark.createDataFrame([(group, version, status, path, "boosted" if boosted else "pipeline")], "group string, version long, status string, path string, kind string")
        self.table.upsert(row.withColumn("created_at", F.lit(created_at).cast("timestamp")))
        return version

    def decide(self, group: str, version: int, status: str) -> None:
        """Approve or reject a version."""
        row = self.versions(group).where(F.col("version") == version)
        if row.isEmpty():
            raise ValueError(f"{group} has no version {version}")
        self.table.upsert(row.withColumn("status", F.lit(status)))

    def load(self, group: str) -> Artefacts:
        """The newest approved version, from its folder alone; none is an error."""
        row = self.versions(group).where(F.col("status") == APPROVED).orderBy(F.desc("version")).first()
        if row is None:
            raise ValueError(f"{group} has no approved version")
        words = self.spark.read.parquet(f"{row.path}/vocabulary").orderBy("feature", "position").collect()  # as many as output columns
        vocabulary: dict[str, list] = {}
        for w in words:
            vocabulary.setdefault(w.feature, []).append(w.category)
        scaler = {s.feature: (s.mean, s.deviation) for s in self.spark.read.parquet(f"{row.path}/scaler").collect()}
        where = f"{row.path}/model"
        model = bo.from_table(self.spark.read.parquet(where)) if row.kind == "boosted" else PipelineModel.load(where)
        return Artefacts(row.version, model, vocabulary, scaler)


def score_newest(registry: ModelRegistry, group: str, df: DataFrame, keep: tuple[str, ...] = ("id", "ds")) -> DataFrame:
    """ML7 + JON15: ``df`` encoded and scored by the newest approved version."""
    found = registry.load(group)
    rows = found.encode(df)
    scored = bo.score(rows, found.model) if isinstance(found.model, bo.Boosted) else found.model.transform(rows)
    return scored.select(*keep, F.col("prediction").alias("yhat"), F.lit(found.version).cast("long").alias("version"))
