"""Folds, resampling of classes, bags. Draws are hashes of keys: the same on each run and each cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written
from .ranks import among_first, in_order


def draw(*keys) -> Column:
    """A whole number below 2 ** 32 from a hash of keys."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *keys)), 1, 8), 16, 10).cast("long")


def kfold(columns: DataFrame, k: int, order: str) -> DataFrame:
    """Contiguous folds 0 to k - 1 in the order given; the first n mod k have one more. For catalogues, not for cells."""
    return columns.withColumn("fold", F.ntile(k).over(Window.orderBy(order)) - 1)


def resample(rows: DataFrame, label: str, key: str, strategy: str) -> DataFrame:
    """rows(key, label) with classes brought to one size: `copy` numbers the times a row is drawn.

    upsample_to_max: every class up to the largest. upsample_to_mean: those under the mean up to it, the others as they
    are. resample_to_mean: every class to the mean, up or down. none: as it is. Rows are drawn in the order of a hash.
    """
    if strategy == "none":
        return rows.withColumn("copy", F.lit(0).cast("long"))
    sizes = rows.groupBy(label).agg(F.count("*").alias("n"))
    stat = sizes.agg(F.max("n").alias("most"), F.floor(F.avg("n")).alias("mean"))  # one row
    goal = {"upsample_to_max": F.col("most"), "upsample_to_mean": F.greatest("n", "mean"), "resample_to_mean": F.col("mean")}[strategy]
    sizes = sizes.crossJoin(stat).select(label, "n", goal.alias("goal"))
    # all n rows are drawn goal div n times, and the first goal mod n by their hash once more
    rest = sizes.select(label, (F.col("goal") % F.col("n")).alias("goal"))
    out = among_first(rows, label, F.md5(F.col(key).cast("string")), rest).join(sizes.withColumn("whole", F.floor(F.col("goal") / F.col("n"))).select(label, "whole"), label)
    times = F.col("whole") + F.col("first").cast("long")
    return out.filter(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), times.cast("long") - 1))).select(*rows.columns, "copy")


def bags(cells: DataFrame, columns: DataFrame, bag_size: int) -> DataFrame:
    """columns(column_id, n_bags) -> (column_id, bag, i, value): bag_size cells of a column drawn with replacement.

    Cells are numbered through value counts: a value stands for as many numbers as it occurs, so that a draw finds its
    value in a range of numbers (in_order): no window runs over cells, nor over all values of a column.
    """
    counts = written(cells.groupBy("column_id", "value").agg(F.count("*").alias("cnt")))
    total = counts.groupBy("column_id").agg(F.sum("cnt").alias("t"))
    draws = columns.join(total, "column_id").select("column_id", "t", F.explode(F.sequence(F.lit(1), F.col("n_bags"))).alias("bag")).select("*", F.explode(F.sequence(F.lit(1), F.lit(bag_size))).alias("i"))
    draws = draws.withColumn("at", draw("column_id", "bag", "i") % F.col("t") + 1)
    return in_order(counts, ["column_id"], [F.col("value").asc_nulls_first()], "cnt", draws).select("column_id", "bag", "i", "value")


def resample_within(rows: DataFrame, group: str, label: str, key: str, strategy: str) -> DataFrame:
    """resample() within each group: the goal is the group's own largest or mean class."""
    both = F.concat_ws("\u0001", F.col(group).cast("string"), F.col(label).cast("string"))
    sizes = rows.groupBy(group, label).agg(F.count("*").alias("n"))
    per = Window.partitionBy(group)  # as many rows as classes
    goal = {"upsample_to_max": F.max("n").over(per), "upsample_to_mean": F.greatest(F.col("n"), F.floor(F.avg("n").over(per))), "resample_to_mean": F.floor(F.avg("n").over(per))}[strategy]
    sizes = sizes.withColumn("goal", goal).select(both.alias("_class"), "n", "goal")
    rest = sizes.select("_class", (F.col("goal") % F.col("n")).alias("goal"))
    out = among_first(rows.withColumn("_class", both), "_class", F.md5(F.col(key).cast("string")), rest).join(sizes.select("_class", F.floor(F.col("goal") / F.col("n")).alias("whole")), "_class")
    times = F.col("whole") + F.col("first").cast("long")
    return out.filter(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), times.cast("long") - 1))).select(*rows.columns, "copy")


def bag_counts(drawn: DataFrame) -> DataFrame:
    """bags() as value counts of columns `column_id#bag`, from which each bag's features are computed like a column's."""
    return drawn.groupBy(F.concat_ws("#", "column_id", "bag").alias("column_id"), "value").agg(F.count("*").alias("cnt"))


def bags_per_column(labelled: DataFrame, n_bags: int, strategy: str = "bagging") -> DataFrame:
    """labelled(column_id, label) -> (column_id, n_bags): scaled so that classes reach the largest or the mean class's bags."""
    if strategy == "bagging":
        return labelled.select("column_id", F.lit(n_bags).alias("n_bags"))
    sizes = labelled.groupBy("label").agg(F.count("*").alias("n"))
    stat = sizes.agg((F.max("n") if strategy == "bagging_to_max" else F.avg("n")).alias("goal"))
    sizes = sizes.crossJoin(stat).select("label", F.greatest(F.lit(1), F.ceil(F.lit(n_bags) * F.col("goal") / F.col("n"))).cast("int").alias("n_bags"))
    return labelled.join(sizes, "label").select("column_id", "n_bags")
