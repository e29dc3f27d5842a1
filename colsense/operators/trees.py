"""Trees that connect classes over a graph of weighted links, for many candidate models at once: rounds of joins keyed by model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import written

#: For tables that grow with the models: files of them look small, and would be sent through the driver.
DEALT = "merge"
UNIT = 1_000_000  # what a link without support costs; costs are whole, so that sums compare exactly


def costs(graph: DataFrame) -> DataFrame:
    """(a, b, cost) in both directions of graph(src, label, dst, support): the cheapest link between two classes, 1 / (1 + support) each."""
    one = graph.filter("src <> dst").groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.floor(UNIT / (1 + F.max("support"))).alias("cost"))
    one = one.withColumn("cost", F.greatest(F.col("cost"), F.lit(1)).cast("long"))
    return one.union(one.select(F.col("b"), F.col("a"), "cost"))


def shortest(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, node, cost, prev): the least cost from each of sources(node), and the node before on a cheapest way, the first of several.

    Only nodes whose cost has fallen pass it on in the next round.
    """
    dist = front = written(sources.select(F.col("node").alias("source"), "node", F.lit(0).cast("long").alias("cost")).distinct())
    while True:
        step = front.join(edges.withColumnRenamed("cost", "w"), F.col("node") == F.col("a")).groupBy("source", F.col("b").alias("node")).agg(F.min(F.col("cost") + F.col("w")).alias("cost"))
        old = dist.withColumnRenamed("cost", "old")
        front = written(step.join(old, ["source", "node"], "left").filter("old IS NULL OR cost < old").drop("old"))
        if front.isEmpty():
            break
        dist = written(dist.join(front, ["source", "node"], "left_anti").union(front.select(*dist.columns)))
    before = dist.select("source", F.col("node").alias("a"), F.col("cost").alias("upto")).join(edges.withColumnRenamed("cost", "w"), "a")
    before = before.select("source", F.col("b").alias("node"), (F.col("upto") + F.col("w")).alias("cost"), "a").join(dist, ["source", "node", "cost"])
    return dist.join(before.groupBy("source", "node").agg(F.min("a").alias("prev")), ["source", "node"], "left")


def spanning(edges: DataFrame) -> DataFrame:
    """The edges (model, a, b, cost), a < b, of a least spanning forest of each model; ties go to the first names.

    Rounds after Boruvka: each part takes its cheapest edge to another part, and parts that are linked so become one by
    jumping pointers; a model is done after the logarithm of its nodes.
    """
    part = written(edges.select("model", F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("part", F.col("node")))
    tree = edges.limit(0)
    while True:
        end = lambda c: part.select("model", F.col("node").alias(c), F.col("part").alias(f"of_{c}")).hint(DEALT)
        apart = edges.join(end("a"), ["model", "a"]).join(end("b"), ["model", "b"]).filter("of_a <> of_b")
        both = F.explode(F.array(F.struct(F.col("of_a").alias("part"), F.col("of_b").alias("up")), F.struct(F.col("of_b").alias("part"), F.col("of_a").alias("up")))).alias("e")
        best = apart.select("model", "a", "b", "cost", both).groupBy("model", F.col("e.part").alias("part")).agg(F.min(F.struct("cost", "a", "b", F.col("e.up").alias("up"))).alias("m"))
        best = written(best.select("model", "part", "m.*"))
        if best.isEmpty():
            return tree
        tree = tree.union(best.select(*edges.columns).distinct())
        # of two parts that chose one edge the first stays
        back = best.select("model", F.col("part").alias("up"), F.col("up").alias("part"), F.lit(True).alias("mutual"))
        up = best.select("model", "part", "up").join(back.hint(DEALT), ["model", "part", "up"], "left")
        up = written(up.select("model", "part", F.when(F.col("mutual") & (F.col("part") < F.col("up")), F.col("part")).otherwise(F.col("up")).alias("up")))
        while True:
            jump = up.select("model", F.col("part").alias("up"), F.col("up").alias("top"))
            new = written(up.join(jump.hint(DEALT), ["model", "up"], "left").select("model", "part", F.coalesce("top", "up").alias("up"), (F.coalesce("top", "up") != F.col("up")).alias("moved")))
            up = new.select("model", "part", "up")
            if new.filter("moved").isEmpty():
                break
        part = written(part.join(up.hint(DEALT), ["model", "part"], "left").select("model", "node", F.coalesce("up", "part").alias("part")))


def _ways(pairs: DataFrame, ways: DataFrame) -> DataFrame:
    """(model, a, b), a < b: the edges on the cheapest ways from a to b of pairs(model, a, b)."""
    at, out = written(pairs.select("model", F.col("a").alias("source"), F.col("b").alias("node"))), None
    while not at.isEmpty():
        step = written(at.join(ways.select("source", "node", "prev"), ["source", "node"]).filter("prev IS NOT NULL").distinct())
        edge = step.select("model", F.least("node", "prev").alias("a"), F.greatest("node", "prev").alias("b"))
        out = edge if out is None else out.union(edge)
        at = written(step.filter("prev <> source").select("model", "source", F.col("prev").alias("node")))
    return pairs.select("model", "a", "b").limit(0) if out is None else out.distinct()


def connecting(nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """(model, src, label, dst, support): for each model a tree of the graph's links that connects its classes, of low cost.

    nodes(model, label), graph(src, label, dst, support). A Steiner tree approximated by cheapest ways: the cheapest ways
    between a model's classes, a least spanning tree of these, the links on them, once more a least spanning tree, and off
    with ends that are no class of the model. Its cost is less than twice the least possible. Classes that the graph
    doesn't connect stay apart. Links may be walked in either direction; between two classes the best supported one is
    returned, ties to the first names. Work grows with the square of a model's classes, which are at most its columns.
    """
    edges = written(costs(graph))
    nodes = written(nodes.select("model", "label").distinct())
    ways = written(shortest(nodes.select(F.col("label").alias("node")).distinct(), edges))
    end = lambda c: nodes.select("model", F.col("label").alias(c))
    pairs = end("a").join(ways.select(F.col("source").alias("a"), F.col("node").alias("b"), "cost"), "a").filter("a < b").join(end("b").hint(DEALT), ["model", "b"])
    some = _ways(spanning(written(pairs.select("model", "a", "b", "cost"))), ways)
    tree = written(spanning(written(some.join(edges, ["a", "b"]).select("model", "a", "b", "cost"))))
    while True:  # ends that no one asked for
        ends = tree.select("model", F.explode(F.array("a", "b")).alias("label")).groupBy("model", "label").count().filter("count = 1").join(nodes.hint(DEALT), ["model", "label"], "left_anti")
        ends = written(ends.select("model", "label"))
        if ends.isEmpty():
            break
        off = lambda df, c: df.join(ends.select("model", F.col("label").alias(c)).hint(DEALT), ["model", c], "left_anti")
        tree = written(off(off(tree, "a"), "b").select(*tree.columns))
    links = graph.filter("src <> dst").groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.min(F.struct((-F.col("support")).alias("s"), "src", "label", "dst")).alias("m"))
    return tree.join(links, ["a", "b"]).select("model", "m.src", "m.label", "m.dst", (-F.col("m.s")).alias("support"))
