"""Candidate semantic models: types per column, their combinations, the alignment graph, scores and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written
from .trees import DEALT, connecting

#: Rows of training descriptions, or links with support, that are sent to all tasks: some 10 MB.
NEAR = 100_000


def semantic_types(scores: DataFrame, k: int = 4, threshold: float = 0.0, item: str = "item") -> DataFrame:
    """The k best types of each item, scores(item, label, score); those under the threshold become Unknown, once."""
    order = Window.partitionBy(item).orderBy(F.desc("score"), "label")
    best = scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    best = best.withColumn("label", F.when(F.col("score") < threshold, "Unknown").otherwise(F.col("label")))
    return best.groupBy(item, "label").agg(F.max("score").alias("score"), F.min("rank").alias("rank"))


def alignment(links: DataFrame, ontology: DataFrame | None = None) -> DataFrame:
    """(src, label, dst, support): descriptions that have each link, links(ssd_id, src, label, dst); ontology's own links count 0."""
    key = ["src", "label", "dst"]
    rows = links.select(*key, "ssd_id").distinct().groupBy(*key).agg(F.count("*").alias("support"))
    if ontology is None:
        return rows
    return rows.join(ontology.select(*key).distinct(), key, "full_outer").select(*key, F.coalesce("support", F.lit(0)).alias("support"))


def best_links(graph: DataFrame) -> DataFrame:
    """(src, dst, label, support): the best supported link of each pair of classes, ties to the first name."""
    m = graph.groupBy("src", "dst").agg(F.min(F.struct((-F.col("support")).alias("s"), F.col("label").alias("l"))).alias("m"))
    return m.select("src", "dst", F.col("m.l").alias("label"), (-F.col("m.s")).alias("support"))


def candidate_mappings(types: DataFrame, branch: int = 10, most: int = 10) -> DataFrame:
    """(dataset, labels, score, rank): combinations of types, the best by product of scores.

    types(dataset, position, label, score), positions from 0 without gaps. Positions are taken in turn for all datasets
    at once; `branch` combinations of a dataset go on, as the parameter asks (a search of bounded width), `most` are
    returned.
    """
    types = types.select("dataset", "position", "label", F.col("score").alias("s"))
    last = types.agg(F.max("position")).first()[0]
    kept = lambda df, n: df.withColumn("rank", F.row_number().over(Window.partitionBy("dataset").orderBy(F.desc("score"), "labels"))).filter(F.col("rank") <= n)
    beam = kept(types.filter("position = 0").select("dataset", F.array("label").alias("labels"), F.col("s").alias("score")), branch)
    for p in range(1, (last or 0) + 1):
        step = beam.drop("rank").join(types.filter(F.col("position") == p), "dataset", "left")
        step = step.select("dataset", F.when(F.col("label").isNull(), F.col("labels")).otherwise(F.array_append("labels", F.col("label"))).alias("labels"), (F.col("score") * F.coalesce("s", F.lit(1.0))).alias("score"))
        beam = kept(step, branch)
        if p % 8 == 0:
            beam = written(beam)
    return kept(beam.drop("rank"), most)


def _near(rows: DataFrame) -> DataFrame:
    """rows of what is known already, written once: they go to the models if they are at most NEAR, else both are dealt."""
    rows = written(rows)
    return F.broadcast(rows) if rows.count() <= NEAR else rows.hint(DEALT)


def model_parts(nodes: DataFrame, links: DataFrame, training_nodes: DataFrame, training_links: DataFrame, support: DataFrame) -> DataFrame:
    """(model, confidence, node_coherence, link_coherence, link_cost) of candidate models.

    nodes(model, label, score), links(model, src, label, dst), of training descriptions (ssd_id, label) and
    (ssd_id, src, label, dst), support(src, label, dst, support). Confidence is the mean score of types; coherence the
    largest share of a model's nodes, or links, that one training description has too; a link costs 1 / (1 + support).
    """
    key = ["src", "label", "dst"]

    def once(mine: DataFrame, on: list[str], *more: str) -> DataFrame:
        """Rows of models, `again` but for the first of equal ones: dealt by model, if they aren't, as all that follows leaves them."""
        before = F.lag(F.struct(*on)).over(Window.partitionBy("model").orderBy(*on, *more))
        return mine.select("model", *on, *more).withColumn("again", F.struct(*on).eqNullSafe(before))

    def coherence(mine: DataFrame, theirs: DataFrame, on: list[str], name: str) -> DataFrame:
        """Beside it the mean of score, if mine has it."""
        both = mine.filter("NOT again").join(_near(theirs.select("ssd_id", *on).distinct()), on).groupBy("model", "ssd_id").agg(F.count("*").alias("n")).groupBy("model").agg(F.max("n").alias("n"))
        mean = [F.avg("score").alias("confidence")] if "score" in mine.columns else []
        all_ = mine.groupBy("model").agg(F.count_if(~F.col("again")).alias("t"), *mean)
        return all_.join(both.hint(DEALT), "model", "left").select("model", (F.coalesce("n", F.lit(0)) / F.col("t")).alias(name), *(["confidence"] if mean else []))

    # models are ranked by their unrounded costs, which add up in the order of the distinct links
    cost = links.select("model", *key).distinct().join(_near(support), key, "left").groupBy("model").agg(F.sum(1 / (1 + F.coalesce("support", F.lit(0)))).alias("link_cost"))
    links = once(links, key)
    out = coherence(once(nodes, ["label"], "score"), training_nodes, ["label"], "node_coherence").filter("model IS NOT NULL")
    out = out.join(coherence(links, training_links, key, "link_coherence").hint(DEALT), "model", "left").join(cost.hint(DEALT), "model", "left")
    out = out.select("model", "confidence", "node_coherence", "link_coherence", "link_cost")
    return out.na.fill(0.0, ["link_coherence", "link_cost"])


def scored(models: DataFrame, size_weight: float = 1.0, confidence_weight: float = 1.0, coherence_weight: float = 1.0) -> DataFrame:
    """models with coverage, size_reduction and score.

    models(dataset, model, n_nodes, n_mapped, n_columns, confidence, coherence, link_cost); score is the weighted mean of
    size reduction, confidence and coherence.
    """
    reduction = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("n_nodes") / (2 * F.col("n_columns"))))
    m = models.withColumn("coverage", F.col("n_mapped") / F.col("n_columns")).withColumn("size_reduction", reduction)
    total = F.col("size_reduction") * size_weight + F.col("confidence") * confidence_weight + F.col("coherence") * coherence_weight
    return m.withColumn("score", F.round(total / (size_weight + confidence_weight + coherence_weight), 6))


def ranked(models: DataFrame) -> DataFrame:
    """models with rank: by score, then link cost, coverage and name; 1 is the best of its dataset."""
    return models.withColumn("rank", F.row_number().over(Window.partitionBy("dataset").orderBy(F.desc("score"), "link_cost", F.desc("coverage"), "model")))


def checked_properties(**properties: float) -> None:
    """Counts must be above 0 and weights from 0 to 1; what is None isn't checked."""
    for name, value in properties.items():
        low, high = ("in [0, 1]", 0 <= value <= 1) if name.endswith(("weight", "threshold")) and value is not None else ("above 0", value is None or value > 0)
        if not high:
            raise ValueError(f"{name} must be {low}")


def recommended(
    scores: DataFrame, training: DataFrame, ontology: DataFrame | None = None, types: int = 4, unknown_threshold: float = 0.0, branch: int = 10, most: int = 10,
    size_weight: float = 1.0, confidence_weight: float = 1.0, coherence_weight: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(ranked models, their links): semantic models of each dataset, from scores of its columns to a connected graph of classes.

    scores(dataset, position, label, score): positions of a dataset's columns from 0 without gaps. training(ssd_id, src,
    label, dst): links of known descriptions; ontology(src, label, dst): links that count without support. Each column's best
    types make candidate mappings; the classes of a mapping are connected over the alignment graph (trees.connecting);
    confidence, coherence, cost, coverage and size of that model give its score and rank. Unknown columns are left out of a
    model. Models: dataset, model, labels, n_nodes, n_mapped, n_columns, confidence, node_coherence, link_coherence, link_cost,
    coverage, size_reduction, score, rank.
    """
    checked_properties(types=types, branch=branch, most=most, unknown_threshold=unknown_threshold, size_weight=size_weight, confidence_weight=confidence_weight, coherence_weight=coherence_weight)
    scores, training = written(scores), written(training)  # each is taken several times; what they come from, and sends to the driver, runs once
    item = F.struct("dataset", "position")
    best = written(semantic_types(scores.select(item.alias("item"), "label", "score"), types, unknown_threshold).select("item.*", "label", "score"))
    columns = scores.groupBy("dataset").agg(F.count_distinct("position").alias("n_columns"))
    mapped = written(candidate_mappings(best, branch, most).select("dataset", F.concat_ws("#", F.col("dataset").cast("string"), "rank").alias("model"), "labels"))
    of = mapped.select("dataset", "model", F.posexplode("labels").alias("position", "label")).join(best.hint(DEALT), ["dataset", "position", "label"]).filter("label <> 'Unknown'")
    nodes = written(of.groupBy("model", "label").agg(F.max("score").alias("score"), F.count("*").alias("n")))
    graph = written(alignment(training, ontology))
    links = written(connecting(nodes, graph))
    classes = nodes.select("model", "label").union(links.select("model", "src")).union(links.select("model", "dst")).distinct().groupBy("model").agg(F.count("*").alias("n_nodes"))
    ends = training.select("ssd_id", F.explode(F.array("src", "dst")).alias("label")).distinct()
    parts = model_parts(nodes, links, ends, training, graph)
    n = nodes.groupBy("model").agg(F.sum("n").alias("n_mapped"))
    models = mapped.join(parts.hint(DEALT), "model").join(classes.hint(DEALT), "model").join(n.hint(DEALT), "model").join(columns.hint(DEALT), "dataset").withColumn("coherence", (F.col("node_coherence") + F.col("link_coherence")) / 2)
    out = ranked(scored(models, size_weight, confidence_weight, coherence_weight))
    keep = ["dataset", "model", "labels", "n_nodes", "n_mapped", "n_columns", "confidence", "node_coherence", "link_coherence", "link_cost", "coverage", "size_reduction", "score", "rank"]
    return out.select(*keep), links
