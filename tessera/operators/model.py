"""The pair classifier: gradient-boosted trees of Spark ML."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.features import FEATURES

#: 63 splits at most a tree, and rows that a leaf needs. Each round is some passes over the rows here, so there are fewer of them.
ROUNDS, DEPTH, LEAST = 40, 6, 100


def train(rows: DataFrame, rounds: int = ROUNDS, rate: float = 0.08, depth: int = DEPTH, least: int = LEAST, weight: str | None = None, seed: int = 42) -> PipelineModel:
    """rows: features and y; ``weight`` names a column of row weights.

    Rows that are alike in all features and y fall into one leaf in every tree, so they are sent through the rounds once, weighted by their
    number; a leaf needs as many rows as ever. The share of rows drawn for a tree is drawn of these groups.
    """
    gbt = GBTClassifier(labelCol="y", featuresCol="features", maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=0.9, featureSubsetStrategy="0.9", seed=seed)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    if weight:
        return Pipeline(stages=[vectors, gbt.setWeightCol(weight).setMinInstancesPerNode(least)]).fit(rows)
    alike = grouped(rows).persist()
    try:
        total = alike.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if total < 2 * least:  # no node can be cut
            gbt.setMaxDepth(0)
        else:
            gbt.setMinWeightFractionPerNode(min(least / total, 0.5) * (1 - 1e-12))
        return Pipeline(stages=[vectors, gbt.setWeightCol("n")]).fit(alike)
    finally:
        alike.unpersist()


def grouped(rows: DataFrame) -> DataFrame:
    """(20 features, y, n): n rows that are alike, in an order that does not change from run to run."""
    return rows.groupBy(*FEATURES, "y").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions(*FEATURES, "y")


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(s1, tgt, prob)."""
    return model.transform(rows).select("s1", "tgt", vector_to_array("probability")[1].alias("prob"))


def out_of_fold(rows: DataFrame, folds: int = 5, **options) -> DataFrame:
    """(s1, tgt, prob) of every row by a model that has not seen its query entity; rows have fold."""
    out = None
    for k in range(folds):
        part = predict(train(rows.where(F.col("fold") != k), **options), rows.where(F.col("fold") == k))
        out = part if out is None else out.unionByName(part)
    return out


def save(model: PipelineModel, path: str, threshold: float | None = None) -> None:
    model.write().overwrite().save(f"{path}/model")
    if threshold is not None:
        spark = SparkSession.active()
        spark.range(1).select(F.lit(json.dumps({"threshold": threshold})).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/threshold")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, float | None]:
    try:
        line = spark.read.text(f"{path}/threshold").first()
    except Exception:
        line = None
    return PipelineModel.load(f"{path}/model"), json.loads(line["value"])["threshold"] if line else None
