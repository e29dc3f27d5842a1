"""Evaluation of column classifiers over folds, and views of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .metrics import confusion, mean_scores, scores

SCORE = "scores_"


def centroid_folds(rows: DataFrame, features: list[str], fold: str = "fold", item: str = "column_id", label: str = "label", missing: str = "unknown") -> DataFrame:
    """(item, fold, actual, predicted): each fold predicted by the nearest class mean of the others' labelled rows.

    All folds at once: sums per fold and class, less the fold's own, are the means that the fold is tested by; no model is
    fitted on the driver. Ties go to the first name; a fold without other labelled rows predicts `missing`, and so counts a
    row without a label.
    """
    known = rows.filter(F.col(label).isNotNull())
    per = known.groupBy(fold, label).agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in features])
    all_ = per.groupBy(label).agg(F.sum("n").alias("n"), *[F.sum(f).alias(f) for f in features])
    folds = F.array(*[F.lit(r[0]) for r in rows.select(fold).distinct().collect()])  # the few folds
    own = per.select(fold, label, F.col("n").alias("own"), *[F.col(f).alias(f"own_{f}") for f in features])
    # as many rows as folds and classes
    means = all_.withColumn(fold, F.explode(folds)).join(own, [fold, label], "left").withColumn("left", F.col("n") - F.coalesce("own", F.lit(0))).filter(F.col("left") > 0)
    means = means.select(fold, F.col(label).alias("class"), *[((F.col(f) - F.coalesce(f"own_{f}", F.lit(0.0))) / F.col("left")).alias(f"mean_{f}") for f in features])
    away = sum(((F.col(f) - F.col(f"mean_{f}")) ** 2 for f in features), F.lit(0.0))
    near = rows.join(means, fold).groupBy(fold, item).agg(F.min(F.struct(F.round(away, 9).alias("away"), "class")).alias("m"))
    return rows.select(item, fold, label).join(near, [fold, item], "left").select(item, fold, F.coalesce(label, F.lit(missing)).alias("actual"), F.coalesce("m.class", F.lit(missing)).alias("predicted"))


def evaluated(predictions: DataFrame, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Scores of each fold, and their means over folds, of predictions(fold, actual, predicted)."""
    per = scores(confusion(predictions, fold), fold)
    return per, mean_scores(per, fold)


def fold_columns(cells: DataFrame, folds: DataFrame) -> DataFrame:
    """(fold, column, value): cells(column_id, value) of the columns of folds(column_id, fold), by full names; value counts keep their cnt.

    Rows stay where they are: folds have one row per column and are sent to them. Dealt by column, one task would get all
    rows of a column.
    """
    return cells.join(F.broadcast(folds), "column_id").select("fold", F.col("column_id").alias("column"), "value", *(["cnt"] if "cnt" in cells.columns else []))


def projected(predictions: DataFrame, keys: list[str], with_scores: bool = False, features: list[str] | None = None, dataset: str | None = None) -> DataFrame:
    """Key columns of predictions, and on request the scores_ and feature columns, of one dataset or of all."""
    rows = predictions if dataset is None else predictions.filter(F.col("dataset_id") == dataset)
    return rows.select(*keys, *[c for c in predictions.columns if with_scores and c.startswith(SCORE)], *(features or []))


def wide_scores(long: DataFrame, item: str, labels: list[str]) -> DataFrame:
    """(item, scores_<label> ..) of long(item, label, score); 0 where a label is missing."""
    return long.groupBy(item).agg(*[F.coalesce(F.max(F.when(F.col("label") == x, F.col("score"))), F.lit(0)).alias(SCORE + x) for x in labels])


def long_scores(wide: DataFrame, item: str) -> DataFrame:
    """(item, label, score) of the scores_ columns; labels without the prefix."""
    names = [c for c in wide.columns if c.startswith(SCORE)]
    out = wide.select(item, *[F.col(c).alias(c[len(SCORE) :]) for c in names])
    return out.unpivot([item], [c[len(SCORE) :] for c in names], "label", "score")


def sorted_labels(labels: DataFrame, column: str = "column_name") -> DataFrame:
    """labels with their position in the order of column names, from 0. For labels of datasets, not for cells."""
    return labels.withColumn("position", F.row_number().over(Window.partitionBy("dataset_id").orderBy(column)) - 1)
