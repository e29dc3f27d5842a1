"""Files of semantic descriptions and alignment graphs: JSON texts, one per description, to tables and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import uris

SCHEMA = """name string, attributes array<struct<id:long,name:string,columnIds:array<long>>>, ontologies array<long>,
 semanticModel struct<nodes:array<struct<id:long,label:string,type:string,prefix:string>>,links:array<struct<id:long,source:long,target:long,label:string,type:string,prefix:string>>>,
 mappings array<struct<attribute:long,node:long>>"""
ALIGNMENT = "nodes array<struct<id:string,type:string,label:struct<uri:string>>>, links array<struct<id:string,type:string,weight:double>>"
#: Nodes and data links of an alignment graph as rows of one kind.
KINDS = "array<struct<node:boolean,at:string,id:string,kind:string,uri:string>>"
#: Nodes of a description, and links that lead to its data nodes, as rows of one kind.
NODES = "array<struct<node:boolean,node_id:bigint,type:string,label:string,prefix:string,link_id:bigint>>"
#: Links that lead to a data node.
INTO = ("DataPropertyLink", "ClassInstanceLink")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(ssd_id, value): each file of a path, named by its path."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("ssd_id"), "value")


def parsed(texts: DataFrame) -> DataFrame:
    """(ssd_id, d): descriptions by SCHEMA; d's fields are null where a text lacks them or is no JSON."""
    return texts.select("ssd_id", F.from_json("value", SCHEMA).alias("d"))


def nodes(descriptions: DataFrame) -> DataFrame:
    """(ssd_id, node_id, type, label, class_label, prefix): a data node's label is parted at its last point."""
    n = descriptions.select("ssd_id", F.inline("d.semanticModel.nodes"))
    data = (F.col("type") == "DataNode") & F.contains(F.col("label"), F.lit("."))
    head = F.when(data, F.regexp_extract("label", r"(?s)^(.*)\.[^.]*$", 1))
    return n.select("ssd_id", F.col("id").alias("node_id"), "type", F.when(data, F.substring_index("label", ".", -1)).otherwise(F.col("label")).alias("label"), head.alias("class_label"), "prefix")


def links(descriptions: DataFrame) -> DataFrame:
    return descriptions.select("ssd_id", F.inline("d.semanticModel.links")).select("ssd_id", F.col("id").alias("link_id"), "source", "target", "label", "type", "prefix")


def attributes(descriptions: DataFrame) -> DataFrame:
    return descriptions.select("ssd_id", F.inline("d.attributes")).select("ssd_id", F.col("id").alias("attr_id"), "name", F.col("columnIds").alias("column_ids"))


def mapped(descriptions: DataFrame) -> DataFrame:
    return descriptions.select("ssd_id", F.inline("d.mappings")).select("ssd_id", F.col("attribute").alias("attr_id"), F.col("node").alias("node_id"))


def rebuilt(descriptions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, links, skipped) of graphs: a data node takes the label of the link that leads to it; mappings become column links.

    Links of other types than the four of descriptions are skipped, and data nodes without a link that isn't.
    """
    # what becomes nodes comes from one row of a text, so that texts are made and parsed once; nodes meet the links that lead to them by windows
    row = lambda node, at, type_, label, prefix, id_: F.struct(F.lit(node).alias("node"), at.alias("node_id"), type_.alias("type"), label.alias("label"), prefix.alias("prefix"), id_.alias("link_id"))
    null = lambda kind: F.lit(None).cast(kind)
    picked = lambda c, types, f: F.transform(F.filter(c, lambda x: x["type"].isin(*types)), f)
    parts = [
        picked("d.semanticModel.nodes", ("ClassNode", "DataNode"), lambda x: row(True, x["id"], x["type"], F.when(x["type"] == "ClassNode", x["label"]), x["prefix"], null("long"))),
        F.transform("d.attributes", lambda x: row(True, x["id"], F.lit("Column"), x["name"], null("string"), null("long"))),
        picked("d.semanticModel.links", INTO, lambda x: row(False, x["target"], null("string"), x["label"], null("string"), x["id"]))]
    n = descriptions.select("ssd_id", F.inline(F.concat(*[F.coalesce(x, F.array().cast(NODES)) for x in parts])))
    data, to = F.col("type") == "DataNode", Window.partitionBy("ssd_id", "node_id")
    n = n.withColumn("by", F.min_by(F.when(~F.col("node"), F.struct("label")), F.when(~F.col("node"), F.col("link_id"))).over(to)).withColumn("into", F.count_if(~F.col("node")).over(to))
    n = n.filter(F.col("node") & (~data | F.col("ssd_id").isNotNull() & F.col("node_id").isNotNull() & (F.col("into") > 0)))
    n = n.select("ssd_id", "node_id", "type", F.when(data, F.col("by.label")).otherwise(F.col("label")).alias("label"), "prefix")
    e, m = links(descriptions), mapped(descriptions)
    kinds = ("ObjectPropertyLink", "SubClassLink", *INTO)
    good, skipped = e.filter(F.col("type").isin(*kinds)), e.filter(~F.coalesce(F.col("type").isin(*kinds), F.lit(False)))
    after = e.groupBy("ssd_id").agg(F.max("link_id").alias("last"))
    nth = F.row_number().over(Window.partitionBy("ssd_id").orderBy("attr_id", "node_id"))
    to_column = m.join(after, "ssd_id", "left").select("ssd_id", (F.coalesce("last", F.lit(-1)) + nth).cast("long").alias("link_id"), F.col("node_id").alias("source"), F.col("attr_id").alias("target"), F.lit("connect").alias("label"), F.lit("ColumnLink").alias("type"), F.lit(None).cast("string").alias("prefix"))
    return n, good.union(to_column.select(*good.columns)), skipped


def _of_source(of_nodes: Column) -> Column:
    """For rows of nodes and links (node, at: the node's id or the link's source): what links learn from the nodes they leave.

    Looked up by windows within a description, not by joins, so that rows that are dealt by ssd_id aren't dealt again.
    """
    return F.when(~F.col("node") & F.col("at").isNotNull(), of_nodes.over(Window.partitionBy("ssd_id", "at")))


def _into(to: str, of_links: Column) -> Column:
    """For the same rows (to: the node's id or the link's target): what nodes learn from the links that lead to them."""
    return F.when(F.col(to).isNotNull(), of_links.over(Window.partitionBy("ssd_id", to)))


def node_row(node_id: Column, type_: Column, label: Column, prefix: Column) -> Column:
    """A node as `texts_of` takes it."""
    null = F.lit(None).cast("long")
    return F.struct(F.lit(True).alias("node"), node_id.alias("at"), node_id.alias("to"), node_id.alias("id"), null.alias("source"), null.alias("target"), label.alias("label"), type_.alias("type"), prefix.alias("prefix"))


def link_row(link_id: Column, source: Column, target: Column, label: Column, type_: Column, prefix: Column) -> Column:
    """A link likewise: one that leads to a data node is looked up by its ends."""
    end = lambda c: F.when(type_.isin(*INTO), c)
    return F.struct(F.lit(False).alias("node"), end(source).alias("at"), end(target).alias("to"), link_id.alias("id"), source.alias("source"), target.alias("target"), label.alias("label"), type_.alias("type"), prefix.alias("prefix"))


def texts(names: DataFrame, nodes_: DataFrame, links_: DataFrame) -> DataFrame:
    """(ssd_id, value): names(ssd_id, name, and ontologies array<long> if they have any) with their graphs as JSON.

    Column nodes become attributes and their links mappings; a data node goes by class and label. A text is one
    document, so that a description's nodes and links meet in one row.
    """
    cols = lambda df, row, *c: df.select("ssd_id", row(*map(F.col, c)).alias("r")).select("ssd_id", "r.*")
    rows = cols(nodes_, node_row, "node_id", "type", "label", "prefix").union(cols(links_, link_row, "link_id", "source", "target", "label", "type", "prefix"))
    return _written_out(names.join(_grouped(rows).hint("merge"), "ssd_id", "left"), names.columns[1:])  # texts aren't sent through the driver


def texts_of(rows: DataFrame, **heads: Column) -> DataFrame:
    """The same of all descriptions that rows(ssd_id, node_row and link_row) have; heads, name first, are made from ssd_id."""
    return _written_out(_grouped(rows).withColumns(heads), list(heads))


def _grouped(rows: DataFrame) -> DataFrame:
    """(ssd_id, nodes, attributes, links, mappings); a description without an id has none, as one without nodes or links."""
    rows = rows.withColumn("by", _of_source(F.min(F.when(F.col("node"), F.col("label")))))
    rows = rows.withColumn("owner", _into("to", F.min("by")))
    full = F.when((F.col("type") == "DataNode") & F.col("owner").isNotNull(), F.concat_ws(".", "owner", "label")).otherwise(F.col("label"))
    rows = rows.withColumn("full", full)
    listed = lambda ok, *cols: F.sort_array(F.collect_list(F.when(ok, F.struct(*cols))))
    node, column, to_column = F.col("node"), F.col("type") == "Column", F.col("type") == "ColumnLink"
    lists = {
        "nodes": listed(node & ~column, "id", F.col("full").alias("label"), "type", "prefix"),
        "attributes": listed(node & column, "id", F.col("label").alias("name"), F.array("id").alias("columnIds")),
        "links": listed(~node & ~to_column, "id", "source", "target", "label", "type", "prefix"),
        "mappings": listed(~node & to_column, F.col("target").alias("attribute"), F.col("source").alias("node"))}
    some = {"nodes": F.max("node"), "attributes": F.max("node"), "links": ~F.min("node"), "mappings": ~F.min("node")}
    return rows.groupBy("ssd_id").agg(*[F.when(F.col("ssd_id").isNotNull() & some[c], x).alias(c) for c, x in lists.items()])


def _written_out(out: DataFrame, heads: list[str]) -> DataFrame:
    return out.select("ssd_id", F.to_json(F.struct(*heads, "attributes", F.struct("nodes", "links").alias("semanticModel"), "mappings")).alias("value"))


def column_map(nodes_: DataFrame, mappings: DataFrame) -> DataFrame:
    """(ssd_id, column, semantic_type): class---property of each mapped column; mappings(ssd_id, column, node_id)."""
    return mappings.join(nodes_.filter("type = 'DataNode'"), ["ssd_id", "node_id"]).select("ssd_id", "column", F.concat_ws("---", "class_label", "label").alias("semantic_type"))


def write_column_map(rows: DataFrame, sources: DataFrame, path: str) -> None:
    """Column maps as CSV files (key, column_name, semantic_type), a folder for each source_name of sources(ssd_id, source_name)."""
    out = rows.join(sources, "ssd_id").select(F.concat_ws("-", "ssd_id", "column").alias("key"), F.col("column").alias("column_name"), "source_name", "semantic_type")
    out.write.partitionBy("source_name").option("header", True).csv(path)


def unmatched(*names: DataFrame) -> DataFrame:
    """(filename, missing): names that some of the one-column inputs lack, with the numbers of those inputs."""
    rows = None
    for i, n in enumerate(names):
        x = n.toDF("filename").select("filename", F.lit(i).alias("i")).distinct()
        rows = x if rows is None else rows.union(x)
    missing = F.array_except(F.array(*[F.lit(i) for i in range(len(names))]), F.collect_set("i"))
    return rows.groupBy("filename").agg(missing.alias("missing")).filter(F.size("missing") > 0)


def alignment(texts_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (ssd_id, id, type, label, prefix) and links (ssd_id, source, target, label, prefix, type, weight) of alignment graphs.

    A link's id holds source, URI and target, parted by ---. A data node takes its source's label and the link's.
    """
    g = texts_.select("ssd_id", F.from_json("value", ALIGNMENT).alias("g"))
    uri, inner = F.col("uri"), F.col("kind") == "InternalNode"
    part = F.split("id", "---")
    e = g.select("ssd_id", F.inline("g.links")).select("ssd_id", part[0].alias("source"), part[2].alias("target"), part[1].alias("uri"), "type", "weight")
    e = e.select("ssd_id", "source", "target", uris.local_name(uri).alias("label"), uris.namespace(uri).alias("prefix"), "type", "weight")
    # nodes and links of a text come from one row, so that it is parsed once
    row = lambda node, at, to, type_, uri: F.struct(F.lit(node).alias("node"), at.alias("at"), to.alias("id"), type_.alias("kind"), uri.alias("uri"))
    parts = lambda x: F.split(x["id"], "---")
    of_nodes = F.transform("g.nodes", lambda x: row(True, x["id"], x["id"], x["type"], x["label"]["uri"]))
    of_links = F.transform(F.filter("g.links", lambda x: x["type"].isin("DataPropertyLink", "ClassInstanceLink")), lambda x: row(False, parts(x)[0], parts(x)[2], x["type"], parts(x)[1]))
    n = g.select("ssd_id", F.inline(F.concat(F.coalesce(of_nodes, F.array().cast(KINDS)), F.coalesce(of_links, F.array().cast(KINDS)))))
    name = uris.local_name(uri)
    n = n.select("ssd_id", "node", "at", "id", F.when(inner, "ClassNode").otherwise("DataNode").alias("type"), F.when(inner, name).alias("label"), F.when(inner, uris.namespace(uri)).alias("prefix"), F.when(~F.col("node"), name).alias("p"))
    n = n.withColumn("from", _of_source(F.collect_list(F.when(F.col("node"), F.struct("label", "prefix")))))
    n = n.withColumn("by", F.array_min(F.transform("from", lambda x: F.struct(F.concat_ws("---", x["label"], F.col("p")).alias("label"), x["prefix"].alias("prefix")))))
    n = n.withColumn("m", _into("id", F.min("by"))).filter("node")
    return n.select("ssd_id", "id", "type", F.coalesce("m.label", "label", F.lit("")).alias("label"), F.coalesce("m.prefix", "prefix", F.lit("")).alias("prefix")), e
