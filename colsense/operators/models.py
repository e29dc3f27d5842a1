"""Classifiers of columns: training, prediction, decisions by cost; cross-validation is in forest.py."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train(rows: DataFrame, features: list[str], label: str = "label", trees: int = 20, depth: int = 8, seed: int = 1):
    """A random forest on rows(label, features ...); null features count as 0."""
    steps = [StringIndexer(inputCol=label, outputCol="_y"), VectorAssembler(inputCols=features, outputCol="_x"), RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed)]
    return Pipeline(stages=steps).fit(rows.filter(F.col(label).isNotNull()).fillna(0, features))


def predict(model, rows: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """rows with scores (class -> probability), the likeliest class as predicted (ties to the first name) and its confidence."""
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    out = rows.fillna(0, features)
    for stage in model.stages[1:]:
        out = stage.transform(out)
    out = out.withColumn("scores", F.map_from_arrays(names, vector_to_array("probability"))).drop("_x", "rawPrediction", "probability", "prediction")
    best = F.array_sort(F.transform(F.map_entries("scores"), lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("k"))))[0]
    return out.withColumn("predicted", best["k"]).withColumn("confidence", -best["s"])


def by_cost(scores: DataFrame, cost: DataFrame, item: str = "item") -> DataFrame:
    """(item, predicted, expected_cost): the class of least expected cost, ties to the first name.

    scores(item, label, score), cost(actual, predicted, cost): one row per pair of classes, so that it is broadcast by
    Spark's own size estimate only.
    """
    c = scores.join(cost, scores["label"] == cost["actual"]).groupBy(item, "predicted").agg(F.sum(F.col("score") * F.col("cost")).alias("expected_cost"))
    least = c.groupBy(item).agg(F.min(F.struct("expected_cost", "predicted")).alias("m"))
    return least.select(item, "m.predicted", "m.expected_cost")
