"""Labels of columns: checks, upserts, joins with predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.uris import known_label


def violations(labels: DataFrame, columns: DataFrame, classes: DataFrame) -> DataFrame:
    """labels(column_id, label) whose column or label isn't known, and why."""
    a = labels.join(columns, "column_id", "left_anti").select("column_id", "label", F.lit("no such column").alias("why"))
    return a.union(labels.join(classes, "label", "left_anti").select("column_id", "label", F.lit("no such class").alias("why")))


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Labels with the new ones in place of old ones of the same column."""
    return new.select("column_id", "label").union(old.join(new, "column_id", "left_anti").select("column_id", "label"))


def listing(labels: DataFrame, columns: DataFrame) -> DataFrame:
    return labels.join(columns, "column_id").select(F.col("label").alias("user_label"), F.col("name").alias("column_name"), "dataset_id", "column_id")


def with_truth(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """predictions(column_id, label) beside the user's label; `unknown` where there is none."""
    return predictions.select("column_id", F.col("label").alias("predicted")).join(labels.select("column_id", F.col("label").alias("user_label")), "column_id", "left").select("column_id", "predicted", known_label(F.col("user_label")).alias("actual"))


def class_universe(labels: DataFrame) -> DataFrame:
    return labels.select("label").union(labels.sparkSession.createDataFrame([("unknown",)], "label string")).distinct()
