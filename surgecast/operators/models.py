"""F2 models: weighted regressors on the prepared features, scoring, persistence.

Training uses Spark ML (distributed tree / linear learners); scoring is
``model.transform`` on a frame that still carries ``id`` and ``ds``, so the
reference's positional zip of predictions and ids is not needed (JON15).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BoostConfig:
    """The reference's boosted-tree settings (rounds, depth, learning rate)."""

    rounds: int = 80
    depth: int = 6
    eta: float = 0.15
    subsample: float = 1.0
    seed: int = 7


def boosted_trees(features: Sequence[str], cfg: BoostConfig = BoostConfig(), label: str = "y", weight: str | None = "weight") -> Pipeline:
    """ML5: squared-error gradient-boosted trees with sample weights."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=cfg.rounds, maxDepth=cfg.depth,
                       stepSize=cfg.eta, subsamplingRate=cfg.subsample, seed=cfg.seed)
    if weight:
        gbt = gbt.setWeightCol(weight)
    return Pipeline(stages=[asm, gbt])


def linear_model(features: Sequence[str], label: str = "y", weight: str | None = "weight") -> Pipeline:
    """ML6: weighted linear regression."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol=label)
    if weight:
        lr = lr.setWeightCol(weight)
    return Pipeline(stages=[asm, lr])


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    return pipeline.fit(train)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("id", "ds")) -> DataFrame:
    """ML7 + JON15: predictions next to their ids (no positional join)."""
    return model.transform(df).select(*keep, F.col("prediction").alias("yhat"))
