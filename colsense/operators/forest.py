"""Random forests for all folds at once: trees of every fold grow level by level through histograms, in one job a level.

A tree is keyed by (fold, tree), a node by its number in it: 0 is the root, 2 i + 1 and 2 i + 2 the children of i. Draws are
hashes of names, so that the same forest grows on each run and each cluster.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written
from .sampling import draw

#: Draws below 2 ** 32 at which a row counts once more in a tree: the Poisson distribution of mean 1, as of a bootstrap sample.
POISSON = (1580030169, 3160060337, 3950075422, 4213413783, 4279248374)
NODE = ["fold", "tree", "node"]


def chosen(features: int, take: int, trees: int, level: int) -> list[tuple[int, int]]:
    """(tree, feature): the features that a level of each tree may split by, the first `take` in the order of a hash."""
    rank = lambda t, f: hashlib.md5(f"{t}|{level}|{f}".encode()).hexdigest()
    return [(t, f) for t in range(trees) for f in sorted(range(features), key=lambda f: rank(t, f))[:take]]


def weight(item: Column, tree: Column) -> Column:
    """How often a tree's bootstrap sample has an item."""
    d = draw(item, tree)
    return sum(((d >= p).cast("int") for p in POISSON), F.lit(0))


def binned(train: DataFrame, rows: DataFrame, features: list[str], bins: int) -> DataFrame:
    """rows with `bins`: numbers 0 to bins - 1 of equal ranges between a feature's least and greatest training value; null counts as 0."""
    at = lambda f: F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    ends = train.agg(*[g(at(f)).alias(f"{k}{i}") for i, f in enumerate(features) for k, g in (("lo", F.min), ("hi", F.max))])  # one row
    one = lambda i, f: F.when(F.col(f"hi{i}") > F.col(f"lo{i}"), F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(bins * (at(f) - F.col(f"lo{i}")) / (F.col(f"hi{i}") - F.col(f"lo{i}"))))).cast("int")).otherwise(F.lit(0))
    return rows.join(F.broadcast(ends)).withColumn("bins", F.array(*[one(i, f) for i, f in enumerate(features)])).drop(*ends.columns)


def splits(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """(fold, tree, node, feature, bin): each node's best split by Gini impurity, of rows(fold, tree, node, label, w, bins).

    Rows at or below the bin go left. Ties go to the first feature, then bin. Nodes that no allowed(tree, feature) makes
    purer have no row. Histograms are sums of weights by class; no task holds a node's rows.
    """
    cut = NODE + ["feature", "bin"]
    hist = rows.select(*NODE, "label", "w", F.posexplode("bins").alias("feature", "bin")).join(F.broadcast(allowed), ["tree", "feature"])
    hist = written(hist.groupBy(*cut, "label").agg(F.sum("w").alias("n")))
    total = rows.groupBy(*NODE, "label").agg(F.sum("w").alias("total"))
    dense = hist.select(*cut).distinct().join(total, NODE).join(hist, [*cut, "label"], "left")
    left = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy(*NODE, "feature", "label").orderBy("bin"))
    dense = dense.withColumn("l", left).withColumn("r", F.col("total") - F.col("l"))
    square = lambda c: F.sum(F.col(c) * F.col(c))
    s = dense.groupBy(*cut).agg(F.sum("l").alias("l"), square("l").alias("ll"), F.sum("r").alias("r"), square("r").alias("rr"), F.sum("total").alias("t"), square("total").alias("tt"))
    score = F.round(F.col("ll") / F.col("l") + F.col("rr") / F.col("r"), 9)
    s = s.filter("l > 0 AND r > 0").withColumn("score", score).filter(F.col("score") > F.round(F.col("tt") / F.col("t"), 9))
    best = s.groupBy(*NODE).agg(F.min(F.struct((-F.col("score")).alias("score"), "feature", "bin")).alias("m"))
    return best.select(*NODE, "m.feature", "m.bin")


def scores(train: DataFrame, test: DataFrame, features: list[str], trees: int = 20, depth: int = 6, bins: int = 32, take: int | None = None, only: str | None = None) -> DataFrame:
    """(item, fold, label, score): mean share of each class in the leaves that test rows reach, in trees of the other folds' rows.

    train(item, fold, label, features ..), test(item, fold, features ..): a fold's trees are grown from all labelled
    training rows of other folds, each tree from a bootstrap sample of them, and test the fold's own rows. Training and
    test may have the same rows, or folds that never meet. take: features that each level of a tree tries, by default the
    square root of their number, rounded up. only: a column of train that names the one fold whose trees a row grows, for
    features that differ by fold. All folds and trees grow together, one level a job. Test rows of a fold without training
    rows get no score.
    """
    spark, take = train.sparkSession, take or math.ceil(math.sqrt(len(features)))
    known = train.filter("label IS NOT NULL AND item IS NOT NULL").select("item", F.col(only or "fold").alias("own"), F.col("label").cast("string").alias("label"), *features)
    # folds are numbered, so that a training row goes to each fold but its own without a join of all pairs
    folds = test.select("fold").distinct().withColumn("number", F.row_number().over(Window.orderBy("fold")) - 1)  # as many rows as folds
    folds = written(folds)
    n = folds.count()
    of = binned(known, known, features, bins).join(folds, F.col("fold").eqNullSafe(F.col("own")), "inner" if only else "left")
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    grow = of.select("item", "label", "bins", "number", "fold", tree).withColumn("w", weight(F.col("item"), F.col("tree").cast("string"))).filter("w > 0")
    if not only:
        grow = grow.drop("fold").withColumnRenamed("number", "mine").withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1))))
        grow = grow.filter("mine IS NULL OR mine <> number").join(folds, "number")
    asked = binned(known, test, features, bins).select("item", "fold", "bins", tree)
    row = lambda df, label, w: df.select("item", "fold", "tree", F.lit(0).cast("long").alias("node"), label.alias("label"), w.cast("int").alias("w"), "bins", F.lit(True).alias("open"))
    rows = written(row(grow, F.col("label"), F.col("w")).union(row(asked, F.lit(None).cast("string"), F.lit(0))))
    for level in range(depth):
        allowed = spark.createDataFrame(chosen(len(features), take, trees, level), "tree int, feature int")
        best = written(splits(rows.filter("open AND w > 0"), allowed))
        if best.isEmpty():
            break
        side = F.when(F.get("bins", F.col("feature")) <= F.col("bin"), 1).otherwise(2)
        moved = rows.join(best, NODE, "left").withColumn("open", F.col("open") & F.col("feature").isNotNull())
        rows = written(moved.withColumn("node", F.when(F.col("open"), 2 * F.col("node") + side).otherwise(F.col("node"))).select(*rows.columns))
    leaf = rows.filter("w > 0").groupBy(*NODE, "label").agg(F.sum("w").alias("n"))
    leaf = leaf.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*NODE)))  # a leaf has as many rows as classes
    reached = rows.filter("w = 0").select("item", *NODE).join(leaf.select(*NODE, "label", "share"), NODE)
    return reached.groupBy("item", "fold", "label").agg(F.round(F.sum("share") / trees, 6).alias("score"))


def predicted(scores_: DataFrame, test: DataFrame, missing: str = "unknown") -> DataFrame:
    """(item, fold, actual, predicted, confidence) of test(item, fold, label): the class of the highest score, ties to the first name."""
    best = scores_.groupBy("item", "fold").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("label").alias("l"))).alias("m"))
    best = best.select("item", "fold", F.col("m.l").alias("predicted"), (-F.col("m.s")).alias("confidence"))
    out = test.select("item", "fold", F.coalesce(F.col("label").cast("string"), F.lit(missing)).alias("actual")).join(best, ["item", "fold"], "left")
    return out.select("item", "fold", "actual", F.coalesce("predicted", F.lit(missing)).alias("predicted"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
