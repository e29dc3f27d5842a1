"""Evaluation of predictions: confusion matrices, scores, precision at k, mean reciprocal rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def confusion(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, actual, predicted, n) from rows with actual and predicted; missing labels count as 'unknown'."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c)
    return rows.select(*keys, known("actual"), known("predicted")).groupBy(*keys, "actual", "predicted").agg(F.count("*").alias("n"))


def confusion_wide(long: DataFrame, classes: list[str]) -> DataFrame:
    """A row per actual class, a column per predicted one."""
    return long.groupBy("actual").pivot("predicted", classes).agg(F.sum("n")).na.fill(0)


def scores(long: DataFrame, *keys: str) -> DataFrame:
    """Average accuracy, error rate and micro and macro precision, recall and F1, from a confusion table.

    Macro scores are means over the labels that occur as actual or predicted; a ratio without denominator is 0.
    """
    keys = list(keys)
    sides = long.select(*keys, F.col("actual").alias("label"), "n", F.lit(0).alias("p"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")).unionByName(
        long.select(*keys, F.col("predicted").alias("label"), F.lit(0).cast("long").alias("n"), F.col("n").alias("p"), F.lit(0).cast("long").alias("tp")))
    per = sides.groupBy(*keys, "label").agg(F.sum("n").alias("act"), F.sum("p").alias("pre"), F.sum("tp").alias("tp"))
    total = long.groupBy(*keys).agg(F.sum("n").alias("t"))
    per = per.join(total, keys) if keys else per.crossJoin(total)  # one row of totals
    div = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    p, r = div(F.col("tp"), F.col("pre")), div(F.col("tp"), F.col("act"))
    per = per.withColumns({"p": p, "r": r}).withColumn("f", div(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    wrong = (F.col("act") + F.col("pre") - 2 * F.col("tp")) / F.col("t")
    micro = F.sum("tp") / F.max("t")
    r6 = lambda c, name: F.round(c, 6).alias(name)
    return per.groupBy(*keys).agg(
        r6(F.avg(1 - wrong), "average_accuracy"), r6(F.avg(wrong), "error_rate"), r6(micro, "precision_micro"), r6(F.avg("p"), "precision_macro"),
        r6(micro, "recall_micro"), r6(F.avg("r"), "recall_macro"), r6(micro, "fscore_micro"), r6(F.avg("f"), "fscore_macro"))


def ranked(candidates: DataFrame, item: str = "item", k: int | None = None) -> DataFrame:
    """candidates(item, label, score) with rank by falling score, ties by label; the first k if asked."""
    order = Window.partitionBy(item).orderBy(F.desc("score"), "label")
    out = candidates.withColumn("rank", F.row_number().over(order))
    return out if k is None else out.filter(F.col("rank") <= k)


def rank_of_truth(ranks: DataFrame, truth: DataFrame, item: str = "item") -> DataFrame:
    """(item, actual, rank or null, n): where the true label stands among an item's candidates."""
    sizes = ranks.groupBy(item).agg(F.count("*").alias("n"))
    hit = ranks.join(truth.withColumnRenamed("actual", "label"), [item, "label"]).select(item, "rank")
    return truth.join(sizes, item, "left").join(hit, item, "left").select(item, "actual", "rank", F.coalesce("n", F.lit(0)).alias("n"))


def precision_at_k(found: DataFrame, k: int = 3) -> DataFrame:
    """Micro and macro precision at k: hits over inspected labels; looking stops at the hit, so that it shortens the denominator."""
    seen = F.least(F.coalesce("rank", F.lit(k)), F.lit(k), F.col("n"))
    rows = found.select("actual", F.when(F.col("rank") <= k, 1).otherwise(0).alias("hit"), seen.alias("seen"))
    per = rows.groupBy("actual").agg(F.sum("hit").alias("h"), F.sum("seen").alias("s"))
    each = F.when(F.col("s") == 0, F.lit(0.0)).otherwise(F.col("h") / F.col("s"))
    return per.agg(F.round(F.when(F.sum("s") == 0, F.lit(0.0)).otherwise(F.sum("h") / F.sum("s")), 6).alias("micro"), F.round(F.avg(each), 6).alias("macro"))


def mrr(found: DataFrame) -> DataFrame:
    """Micro and macro mean reciprocal rank; 0 for an item whose truth isn't among its candidates."""
    one = F.when(F.col("rank").isNotNull(), 1 / F.col("rank")).otherwise(0.0)
    per = found.groupBy("actual").agg(F.sum(one).alias("s"), F.count("*").alias("n"))
    return per.agg(F.round(F.sum("s") / F.sum("n"), 6).alias("micro"), F.round(F.avg(F.col("s") / F.col("n")), 6).alias("macro"))


def mean_scores(per_fold: DataFrame, fold: str = "fold") -> DataFrame:
    return per_fold.agg(*[F.round(F.avg(c), 6).alias(c) for c in per_fold.columns if c != fold])
