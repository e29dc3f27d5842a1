"""Semantic source descriptions as graphs: nodes and links of many descriptions at once, keyed by ssd_id.

nodes(ssd_id, node_id, type, label, prefix): type is ClassNode, DataNode or Column. links(ssd_id, link_id, source, target,
label, type, prefix): type is ObjectPropertyLink, DataPropertyLink, ClassInstanceLink, SubClassLink or ColumnLink. All
work is keyed by ssd_id, so that nothing depends on the size of one graph fitting a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written

ALL = "All"  # label of the node that connects all classes
NODE = ["ssd_id", "node_id"]
#: Links between classes, semantic types and columns.
KINDS = (("ObjectPropertyLink", "SubClassLink"), ("DataPropertyLink", "ClassInstanceLink"), ("ColumnLink",))


def of_type(rows: DataFrame, *types: str) -> DataFrame:
    """Class nodes, data nodes, columns, or links of some types."""
    return rows.filter(F.col("type").isin(*types))


def owners(links: DataFrame) -> DataFrame:
    """(ssd_id, node_id, owner): the class node of each data node."""
    return of_type(links, "DataPropertyLink", "ClassInstanceLink").groupBy("ssd_id", F.col("target").alias("node_id")).agg(F.min("source").alias("owner"))


def instance_index(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes with idx: null for the only node of its type and name in a description, else 0, 1, ... by node_id.

    Data nodes are told apart within their class node only.
    """
    rows = nodes.join(owners(links), NODE, "left").withColumn("owner", F.when(F.col("type") == "DataNode", F.col("owner")))
    same = Window.partitionBy("ssd_id", "type", "owner", "prefix", "label")
    nth = F.row_number().over(same.orderBy("node_id")) - 1
    return rows.withColumn("idx", F.when(F.count("*").over(same) > 1, nth)).select(*nodes.columns, "idx")


def edges_between(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """All links from source to target of pairs(ssd_id, source, target)."""
    return links.join(pairs.distinct(), ["ssd_id", "source", "target"], "left_semi")


def dataset_of(nodes: DataFrame, links: DataFrame, columns: DataFrame) -> DataFrame:
    """(ssd_id, dataset_id, status): the dataset of a description's first mapped column, columns(column, dataset_id).

    status is ok, unmapped (no column is mapped) or unknown (the column belongs to no dataset).
    """
    cols = of_type(nodes, "Column").select("ssd_id", F.col("node_id").alias("target"), F.col("label").alias("column"))
    first = of_type(links, "ColumnLink").join(cols, ["ssd_id", "target"]).groupBy("ssd_id").agg(F.min_by("column", "target").alias("column"))
    found = nodes.select("ssd_id").distinct().join(first, "ssd_id", "left").join(columns, "column", "left")
    status = F.when(F.col("column").isNull(), "unmapped").when(F.col("dataset_id").isNull(), "unknown").otherwise("ok")
    return found.select("ssd_id", "dataset_id", status.alias("status"))


def summary(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(ssd_id, class_nodes, data_nodes, columns, links) of each description."""
    n = nodes.groupBy("ssd_id").agg(*[F.count_if(F.col("type") == t).alias(name) for t, name in (("ClassNode", "class_nodes"), ("DataNode", "data_nodes"), ("Column", "columns"))])
    e = of_type(links, "ObjectPropertyLink", "DataPropertyLink", "ClassInstanceLink", "SubClassLink").groupBy("ssd_id").agg(F.count("*").alias("links"))
    return n.join(e, "ssd_id", "left").na.fill(0, ["links"])


def columns_of_data_node(nodes: DataFrame, links: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, label, ssd_id, column): columns of all descriptions that are mapped to the data nodes wanted(class, label)."""
    class_ = nodes.select("ssd_id", F.col("node_id").alias("owner"), F.col("label").alias("class"))
    data = of_type(nodes, "DataNode").join(owners(links), NODE).join(class_, ["ssd_id", "owner"]).join(wanted.distinct(), ["class", "label"])
    return data.join(mappings(nodes, links), NODE).select("class", "label", "ssd_id", "column")


def with_prefix(rows: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Missing prefixes filled with the description's default namespace, namespaces(ssd_id, namespace)."""
    return rows.join(namespaces, "ssd_id", "left").withColumn("prefix", F.coalesce("prefix", "namespace")).select(*rows.columns)


def distinct_links(links: DataFrame) -> DataFrame:
    """Of equal links between the same two nodes, the one with the smallest link_id."""
    key = ["ssd_id", "source", "target", "label", "prefix"]
    return links.groupBy(*key).agg(F.min_by(F.struct("link_id", "type"), "link_id").alias("m")).select(*key, "m.link_id", "m.type").select(*links.columns)


def degrees(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(ssd_id, node_id, degree): 0 for nodes without links; a loop counts twice."""
    ends = links.select("ssd_id", F.explode(F.array("source", "target")).alias("node_id")).groupBy(*NODE).agg(F.count("*").alias("degree"))
    return nodes.select(*NODE).join(ends, NODE, "left").select(*NODE, F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def neighbours(links: DataFrame) -> DataFrame:
    """(ssd_id, node_id, neighbour), in both directions, once each."""
    out = links.select("ssd_id", F.col("source").alias("node_id"), F.col("target").alias("neighbour"))
    return out.union(links.select("ssd_id", F.col("target").alias("node_id"), F.col("source").alias("neighbour"))).distinct()


def mappings(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(ssd_id, column, node_id): the data node of each mapped column."""
    cols = of_type(nodes, "Column").select("ssd_id", F.col("node_id").alias("target"), F.col("label").alias("column"))
    return of_type(links, "ColumnLink").join(cols, ["ssd_id", "target"]).select("ssd_id", "column", F.col("source").alias("node_id"))


def unmapped(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Column nodes without a column link."""
    ends = of_type(links, "ColumnLink").select("ssd_id", F.col("target").alias("node_id"))
    return of_type(nodes, "Column").join(ends, NODE, "left_anti")


def numbered_after(rows: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """new with ids that go on after the description's greatest, from 0 where it has none."""
    last = rows.groupBy("ssd_id").agg(F.max(key).alias("last"))
    nth = F.row_number().over(Window.partitionBy("ssd_id").orderBy(order))
    return new.join(last, "ssd_id", "left").withColumn(key, (F.coalesce("last", F.lit(-1)) + nth).cast("long")).drop("last")


def fill_unknown(nodes: DataFrame, links: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and links added so that each unmapped column has a data node `unknown` of an instance of class Unknown."""
    todo = unmapped(nodes, links).select("ssd_id", F.col("node_id").alias("col"))
    kinds = F.array(F.struct(F.lit("ClassNode").alias("type"), F.lit("Unknown").alias("label")), F.struct(F.lit("DataNode").alias("type"), F.lit("unknown").alias("label")))
    new = todo.select("ssd_id", "col", F.posexplode(kinds).alias("k", "kind")).select("ssd_id", "col", "k", "kind.*").withColumn("at", F.col("col") * 2 + F.col("k"))
    new = written(numbered_after(nodes, new, "node_id", "at"))
    pair = new.groupBy("ssd_id", "col").agg(F.min("node_id").alias("c"), F.max("node_id").alias("d"))
    made = F.array(
        F.struct(F.col("c").alias("source"), F.col("d").alias("target"), F.lit("unknown").alias("label"), F.lit("DataPropertyLink").alias("type")),
        F.struct(F.col("d").alias("source"), F.col("col").alias("target"), F.lit("connect").alias("label"), F.lit("ColumnLink").alias("type")))
    added = pair.select("ssd_id", F.explode(made).alias("l")).select("ssd_id", "l.*").withColumn("at", F.col("target") * 2 + F.when(F.col("type") == "ColumnLink", 1).otherwise(0))
    added = numbered_after(links, added, "link_id", "at").withColumn("prefix", F.lit(prefix))
    return new.withColumn("prefix", F.lit(prefix)).select(*nodes.columns), added.select(*links.columns)


def connector(nodes: DataFrame, links: DataFrame, label: str = ALL, link: str = "connect", kind: str = "ObjectPropertyLink", prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """A node for each description and a link between it and every class node: from `All`, or to a top class by subClassOf."""
    top = numbered_after(nodes, nodes.select("ssd_id").distinct(), "node_id", "ssd_id").select("ssd_id", "node_id", F.lit("ClassNode").alias("type"), F.lit(label).alias("label"), F.lit(prefix).alias("prefix"))
    ends = of_type(nodes, "ClassNode").select("ssd_id", F.col("node_id").alias("class")).join(top.select("ssd_id", F.col("node_id").alias("top")), "ssd_id")
    source, target = ("class", "top") if kind == "SubClassLink" else ("top", "class")
    new = numbered_after(links, ends, "link_id", "class").select("ssd_id", "link_id", F.col(source).alias("source"), F.col(target).alias("target"), F.lit(link).alias("label"), F.lit(kind).alias("type"), F.lit(prefix).alias("prefix"))
    return top.select(*nodes.columns), new.select(*links.columns)


def remove_nodes(nodes: DataFrame, links: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and links left without gone(ssd_id, node_id).

    A column takes its data node with it. Then neighbours of what went, but columns, go too where no link leaves them,
    until none does.

    Links that leave a node are counted once; a round touches only the links of what it removes and keeps how many of a
    neighbour's links are lost. Nodes and links themselves are filtered at the end.
    """
    by = of_type(links, "ColumnLink").join(gone.withColumnRenamed("node_id", "target"), ["ssd_id", "target"], "left_semi").select("ssd_id", F.col("source").alias("node_id"))
    go = written(gone.select(*NODE).union(by).distinct().join(nodes, NODE, "left_semi"))
    out = written(links.groupBy("ssd_id", F.col("source").alias("node_id")).agg(F.count("*").alias("leave")))
    away, lost = go, None
    while not go.isEmpty():
        into = written(links.join(go.withColumnRenamed("node_id", "target"), ["ssd_id", "target"], "left_semi").groupBy("ssd_id", F.col("source").alias("node_id")).agg(F.count("*").alias("lost")))
        lost = into if lost is None else lost.union(into)
        after = links.join(go.withColumnRenamed("node_id", "source"), ["ssd_id", "source"], "left_semi").select("ssd_id", F.col("target").alias("node_id"))
        near = written(into.select(*NODE).union(after).distinct().join(away, NODE, "left_anti").join(nodes.filter("type <> 'Column'"), NODE, "left_semi"))
        gone_links = lost.join(near, NODE, "left_semi").groupBy(*NODE).agg(F.sum("lost").alias("lost"))
        left = near.join(out, NODE, "left").join(gone_links, NODE, "left")
        go = written(left.filter(F.coalesce("leave", F.lit(0)) == F.coalesce("lost", F.lit(0))).select(*NODE))
        away = away.union(go)
    end = lambda c: away.withColumnRenamed("node_id", c)
    kept = links.join(end("source"), ["ssd_id", "source"], "left_anti").join(end("target"), ["ssd_id", "target"], "left_anti")
    return nodes.join(away, NODE, "left_anti").select(*nodes.columns), kept.select(*links.columns)


def bound(attributes: DataFrame, mapped: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mappings bound to columns by the attribute's name, and the nodes whose mapping finds none.

    attributes(ssd_id, attr_id, name), mapped(ssd_id, attr_id, node_id), columns(ssd_id, name, column_id).
    """
    found = mapped.join(attributes.join(columns, ["ssd_id", "name"]), ["ssd_id", "attr_id"], "left")
    return found.filter("column_id IS NOT NULL").select("ssd_id", "column_id", "node_id"), found.filter("column_id IS NULL").select(*NODE)


def bind(attributes: DataFrame, mapped: DataFrame, nodes: DataFrame, links: DataFrame, columns: DataFrame, namespaces: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(nodes, links, mappings, lost): descriptions bound to the columns of their datasets.

    Attributes find columns by name; lost(ssd_id, attr_id, name) have none and are left out. A node whose mapping finds no
    column goes with all links at it. Missing prefixes are filled by namespaces(ssd_id, namespace). A description without a
    bound attribute or mapping has an empty model.
    """
    lost = attributes.join(columns.select("ssd_id", "name").distinct(), ["ssd_id", "name"], "left_anti").select("ssd_id", "attr_id", "name")
    found, gone = bound(attributes, mapped, columns)
    alive, gone = found.select("ssd_id").distinct(), gone.join(found.select(*NODE), NODE, "left_anti").distinct()
    left = nodes.join(alive, "ssd_id", "left_semi").join(gone, NODE, "left_anti")
    ends = links.join(alive, "ssd_id", "left_semi")
    for end in ("source", "target"):
        ends = ends.join(gone.withColumnRenamed("node_id", end), ["ssd_id", end], "left_anti")
    return with_prefix(left.select(*nodes.columns), namespaces), with_prefix(ends.select(*links.columns), namespaces), found, lost


def bound_heads(names: DataFrame, known: DataFrame, alive: DataFrame) -> DataFrame:
    """(ssd_id null, name, ontologies) of bound descriptions: their own ontologies give way to known(ontology), the id is dropped.

    names(ssd_id, name); of those that aren't in alive(ssd_id), whose model is empty, only the name is left.
    """
    all_ = known.agg(F.array_sort(F.collect_set("ontology")).alias("ontologies"))  # one row: the ontologies of a collection
    rows = names.join(alive.select("ssd_id", F.lit(True).alias("alive")).distinct(), "ssd_id", "left").join(F.broadcast(all_))
    return rows.select(F.lit(None).cast("long").alias("ssd_id"), "name", F.when(F.col("alive"), F.col("ontologies")).otherwise(F.array().cast("array<string>")).alias("ontologies"))


def _by_names(nodes: DataFrame, links: DataFrame, include_all: bool, include_columns: bool) -> DataFrame:
    """(ssd_id, link_id, type, s, p, o): links by the names of their ends."""
    uri = F.when(F.col("type") == "Column", F.col("label")).otherwise(F.concat(F.coalesce("prefix", F.lit("")), "label"))
    n = nodes.select(*NODE, uri.alias("uri"), (F.col("label") == ALL).alias("top"))
    rows = links if include_columns else links.filter("type <> 'ColumnLink'")
    p = F.when(F.col("type") == "ColumnLink", F.lit("ColumnLink")).otherwise(F.concat(F.coalesce("prefix", F.lit("")), "label"))
    rows = rows.select("ssd_id", "link_id", "type", "source", "target", p.alias("p"))
    a, b = n.toDF("ssd_id", "source", "s", "top_s"), n.toDF("ssd_id", "target", "o", "top_o")
    rows = rows.join(a, ["ssd_id", "source"]).join(b, ["ssd_id", "target"])
    if not include_all:
        rows = rows.filter(~F.col("top_s") & ~F.col("top_o"))
    return rows.select("ssd_id", "link_id", "type", "s", "p", "o")


def triples(nodes: DataFrame, links: DataFrame, include_all: bool = False, include_columns: bool = False) -> DataFrame:
    """(ssd_id, s, p, o, n): links by the names of their ends; n numbers equal ones from 0.

    A column goes by its label, other nodes by prefix and label. Links at the connector and column links only on request.
    """
    equal = Window.partitionBy("ssd_id", "s", "p", "o").orderBy("link_id")
    return _by_names(nodes, links, include_all, include_columns).select("ssd_id", "s", "p", "o", (F.row_number().over(equal) - 1).alias("n"))


def compare(result: DataFrame, truth: DataFrame, key: str = "ssd_id") -> DataFrame:
    """(key, precision, recall, jaccard) of the triples of each description; a ratio without denominator is 0."""
    cols = [key, "s", "p", "o", "n"]
    sides = result.select(*cols, F.lit(1).alias("r"), F.lit(0).alias("t")).union(truth.select(*cols, F.lit(0).alias("r"), F.lit(1).alias("t")))
    per = sides.groupBy(*cols).agg(F.max("r").alias("r"), F.max("t").alias("t"))
    per = per.groupBy(key).agg(F.sum(F.col("r") * F.col("t")).alias("both"), F.sum("r").alias("r"), F.sum("t").alias("t"), F.count("*").alias("any"))
    ratio = lambda c: F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.round(F.col("both") / F.col(c), 6))
    return per.select(key, ratio("r").alias("precision"), ratio("t").alias("recall"), ratio("any").alias("jaccard"))


def compare_each(result: tuple[DataFrame, DataFrame], truth: tuple[DataFrame, DataFrame], choices: list[tuple[bool, bool]]) -> DataFrame:
    """(ssd_id, ignore_types, ignore_columns, precision, recall, jaccard) for each choice of the two flags.

    The names of both graphs (nodes, links) are looked up once and their triples counted once, each count with as many
    conditions as choices: equal triples match as often as both sides have them. Descriptions of which nothing is left to
    compare have 0 throughout.
    """
    type_ = F.col("type")
    sides = [_by_names(n, of_type(e, *(k for ks in KINDS for k in ks)), False, True).select("ssd_id", "s", "p", "o", "type", F.lit(i).alias("side")) for i, (n, e) in enumerate((result, truth))]
    kept = [type_.isin(*KINDS[0], *(() if types else KINDS[1]), *(() if columns else KINDS[2])) for types, columns in choices]
    per = sides[0].union(sides[1]).groupBy("ssd_id", "s", "p", "o").agg(*[F.count_if(keep & (F.col("side") == j)).alias(f"{side}{i}") for i, keep in enumerate(kept) for j, side in enumerate("rt")])
    sums = []
    for i in range(len(choices)):
        r, t = F.col(f"r{i}"), F.col(f"t{i}")
        sums += [F.sum(x).alias(f"{name}{i}") for name, x in (("both", F.least(r, t)), ("r", r), ("t", t), ("any", F.greatest(r, t)))]
    per = per.groupBy("ssd_id").agg(*sums)
    ids = result[0].select("ssd_id").union(truth[0].select("ssd_id")).distinct()
    ratio = lambda c, i: F.when(F.col(f"{c}{i}") > 0, F.round(F.col(f"both{i}") / F.col(f"{c}{i}"), 6)).otherwise(F.lit(0.0))
    each = [F.struct(F.lit(t).alias("ignore_types"), F.lit(c).alias("ignore_columns"), ratio("r", i).alias("precision"), ratio("t", i).alias("recall"), ratio("any", i).alias("jaccard")) for i, (t, c) in enumerate(choices)]
    return ids.join(per, "ssd_id", "left").select("ssd_id", F.explode(F.array(*each)).alias("x")).select("ssd_id", "x.*")


def compare_some(result: tuple[DataFrame, DataFrame], truth: tuple[DataFrame, DataFrame], ignore_types: bool = False, ignore_columns: bool = False) -> DataFrame:
    """(ssd_id, precision, recall, jaccard) of two graphs (nodes, links) each, on request without semantic types (links to data
    nodes) or without columns."""
    return compare_each(result, truth, [(ignore_types, ignore_columns)]).drop("ignore_types", "ignore_columns")
