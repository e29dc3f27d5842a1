"""Queries on files, timestamps, namespaces, top classes, removed classes, bound heads and merged profiles, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import uris
from ..operators import evaluation, graphs, ontology, profile, sampling
from ..sources import descriptions, tables
from ..sources.store import shared_path
from ..sources.tables import PROFILED, table
from .base import SQL, query
from .columns import CELLS
from .evaluation import _bound
from .semantics import BASE, LI, NODES, W, _chain, _graph, _triples


def _folder(spark, d) -> str:
    """All profiled tables and their labels as CSV files, a folder each."""
    base = shared_path(spark)
    for t in PROFILED:
        df = table(spark, d, t)
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.option("header", True).csv(f"{base}/{t}")
    return base


@query(f"WITH {CELLS} SELECT ds AS dataset_id, name, count(*) AS n_cells, count(value) AS n_values, CAST(sum(length(value)) AS BIGINT) AS n_chars FROM cells GROUP BY ALL")
def folder_cells(spark, d):
    """Cells of all CSV files of a folder, read in one job whatever the files' columns."""
    # a path is parted once per file and name, not per cell
    files = tables.read_cells(spark, _folder(spark, d)).groupBy("path", "name").agg(F.count("*").alias("n_cells"), F.count("value").alias("n_values"), F.sum(F.length("value").cast("long")).alias("n_chars"))
    return files.groupBy(F.element_at(F.split("path", "/"), -2).alias("dataset_id"), "name").agg(*[F.sum(c).alias(c) for c in ("n_cells", "n_values", "n_chars")])


@query("SELECT CAST(c_custkey AS VARCHAR) AS \"column\", c_mktsegment AS filename, c_name AS class FROM customer WHERE c_custkey % 5 <> 0")
def mapping_lines(spark, d):
    """A mapping file with comments, blank records and padded fields."""
    path, c = shared_path(spark), table(spark, d, "customer")
    line = F.concat(F.when(F.col("c_custkey") % 5 == 0, "# ").otherwise("  "), F.col("c_custkey").cast("string"), F.lit(" , "), "c_mktsegment", F.lit(" ,"), "c_name", F.lit("  "))
    lines = c.select("c_mktsegment", F.lit(1).alias("nth"), line.alias("value"))
    heads = c.select("c_mktsegment", F.lit(0).alias("nth"), F.lit("column,filename,class").alias("value")).distinct()
    blank = heads.select("c_mktsegment", F.lit(2), F.lit(" ,, "))
    files = heads.union(lines).union(blank).repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "nth")
    files.select("c_mktsegment", "value").write.partitionBy("c_mktsegment").text(path)
    return tables.read_lines(spark, f"{path}/c_mktsegment=*", ["column", "filename", "class"])


_TS = "CASE WHEN event_id % 7 = 0 THEN 'on ' || event_id WHEN event_id % 11 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(CAST(floor(date_part('microseconds', ts) / 1000) AS INTEGER) % 1000 AS VARCHAR), 3, '0') END"


@query(f"SELECT event_id, {_TS} AS text, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN date_trunc('milliseconds', ts) END AS at, event_id % 7 = 0 AS broken FROM events")
def server_timestamps(spark, d):
    """Times of events as server timestamps, every seventh of them broken, parsed again."""
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("on "), F.col("event_id").cast("string"))).when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    rows = table(spark, d, "events").select("event_id", text.alias("text"))
    broken = uris.broken_timestamps(rows, "text").select("event_id", F.lit(True).alias("broken"))
    return rows.join(broken, "event_id", "left").select("event_id", "text", uris.timestamp(F.col("text")).cast("timestamp_ntz").alias("at"), F.coalesce("broken", F.lit(False)).alias("broken"))


@query(f"SELECT l_orderkey AS ssd_id, coalesce(arg_min('{BASE}' || l_returnflag || '#', (l_linenumber, l_returnflag)) FILTER (l_quantity >= 25), '{uris.DEFAULT_NAMESPACE}') AS namespace FROM lineitem GROUP BY 1")
def default_namespaces(spark, d):
    """The namespace of each order's first large item, or the library's own."""
    li = table(spark, d, "lineitem")
    name = F.when(F.col("l_quantity") >= 25, F.concat(F.lit(BASE), "l_returnflag", F.lit("#"))).otherwise(F.when(F.col("l_quantity") >= 10, F.lit("")))
    return ontology.default_namespace(li.select(F.col("l_orderkey").alias("ssd_id"), F.struct("l_linenumber", "l_returnflag").alias("pos"), name.alias("namespace")))


@query(f"WITH {NODES}, tp AS (SELECT ssd_id, max(node_id) + 1 AS top FROM nodes GROUP BY 1) SELECT ssd_id, node_id AS source, top AS target, 'subClassOf' AS label, '{ontology.OWL}' AS prefix FROM nodes JOIN tp USING (ssd_id) WHERE type = 'ClassNode'")
def top_class_links(spark, d):
    """Links from all class nodes of an order to a node for the class of all things."""
    _, links = graphs.connector(*_graph(spark, d), label="Thing", link="subClassOf", kind="SubClassLink", prefix=ontology.OWL)
    return links.select("ssd_id", "source", "target", "label", "prefix")


@query("SELECT doc_id, lang, CAST(0 AS BIGINT) AS copy FROM documents")
def no_resampling(spark, d):
    return sampling.resample(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", "none")


@query(f"WITH {CELLS}, c AS (SELECT ds, count(*) AS n FROM cells GROUP BY 1) SELECT ds AS left_id, ds AS right_id FROM c WHERE ds NOT IN ('nation', 'region')")
def same_datasets_with_meta(spark, d):
    """Datasets that have the same columns, rows and description in two catalogues; those of nations and regions differ."""
    catalog = tables.column_catalog({t: table(spark, d, t) for t in PROFILED})
    meta = lambda note: catalog.groupBy("dataset_id").agg(F.max("size").alias("n_rows")).withColumn("description", F.when(F.col("dataset_id") == "nation", note))
    other = meta(F.lit("new")).withColumn("n_rows", F.col("n_rows") + F.when(F.col("dataset_id") == "region", 1).otherwise(0))
    return tables.same_datasets(catalog, catalog, meta(F.lit("old")), other)


@query(f"WITH {LI} SELECT ssd_id || '-' || pk AS key, pk AS column_name, l_returnflag || '---' || l_linestatus AS semantic_type, 'source' || (ssd_id % 3) AS source_name FROM li WHERE l % 2 = 1")
def column_map_files(spark, d):
    """Column maps written as CSV files by source, and read again."""
    nodes, links = _graph(spark, d)
    named = nodes.join(graphs.owners(links), ["ssd_id", "node_id"], "left").join(nodes.select("ssd_id", F.col("node_id").alias("owner"), F.col("label").alias("class_label")), ["ssd_id", "owner"], "left")
    sources = nodes.select("ssd_id").distinct().withColumn("source_name", F.concat(F.lit("source"), (F.col("ssd_id") % 3).cast("string")))
    path = shared_path(spark)
    descriptions.write_column_map(descriptions.column_map(named, graphs.mappings(nodes, links)), sources, path)
    return spark.read.schema("key string, column_name string, semantic_type string, source_name string").option("header", True).csv(path)


@query(f"{W}, gone AS (SELECT nu AS class FROM n WHERE n_regionkey = 1) SELECT 'link' AS kind, src AS class, label, dst FROM li WHERE src NOT IN (FROM gone) AND dst NOT IN (FROM gone) UNION ALL SELECT 'property', class, label, NULL FROM dp WHERE class NOT IN (FROM gone)")
def without_classes(spark, d):
    """Properties and links left once the nations of one region are no classes any more."""
    t = _triples(spark, d)
    gone = table(spark, d, "nation").filter("n_regionkey = 1").select(F.concat(F.lit(f"{BASE}nation#"), "n_name").alias("class"))
    properties, links = ontology.without(gone, ontology.data_properties(t), ontology.links(t))
    return links.select(F.lit("link").alias("kind"), F.col("src").alias("class"), "label", "dst").union(properties.select(F.lit("property"), "class", "label", F.lit(None).cast("string")))


@query(f"""{W}, nw AS (SELECT '{BASE}customer#' || c_custkey AS class, CASE WHEN c_custkey % 2 = 0 THEN '{BASE}customer#' || (c_custkey - 1) ELSE '{BASE}nation#' || n_name END AS parent FROM customer JOIN nation ON c_nationkey = n_nationkey),
 al AS (SELECT class, parent FROM pa UNION SELECT * FROM nw), e AS (SELECT class, class AS ancestor, 0 AS depth FROM (SELECT class FROM cl UNION SELECT class FROM nw) UNION ALL SELECT e.class, al.parent, depth + 1 FROM e JOIN al ON e.ancestor = al.class) SELECT * FROM e""")
def extended_ancestors(spark, d):
    """Ancestors once customers are classes under their nations, even ones under the customer before them: only their rows are new."""
    t = _triples(spark, d)
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    name = lambda k: F.concat(F.lit(f"{BASE}customer#"), k.cast("string"))
    k = F.col("c_custkey")
    new = c.select(name(k).alias("class"), F.when(k % 2 == 0, name(k - 1)).otherwise(F.concat(F.lit(f"{BASE}nation#"), "n_name")).alias("parent"))
    return ontology.extended_chain(_chain(t), new.select("class"), new)


@query(f"""WITH {LI}, al AS (SELECT DISTINCT ssd_id FROM li JOIN (SELECT DISTINCT l_orderkey AS k, CAST(l_partkey AS VARCHAR) AS p FROM lineitem WHERE l_quantity > 10) ON k = ssd_id AND p = pk WHERE l % 2 = 1),
 kn AS (SELECT string_agg(r_name, ',' ORDER BY r_name) AS o FROM region) SELECT 'order' || ssd_id AS name, CASE WHEN al.ssd_id IS NULL THEN '' ELSE o END AS ontologies FROM (SELECT DISTINCT ssd_id FROM li) x LEFT JOIN al USING (ssd_id), kn""")
def bound_heads(spark, d):
    """Names and ontologies of bound descriptions: regions as ontologies take the place of their own."""
    nodes = _graph(spark, d)[0]
    names = nodes.select("ssd_id").distinct().select("ssd_id", F.concat(F.lit("order"), F.col("ssd_id").cast("string")).alias("name"))
    out = graphs.bound_heads(names, table(spark, d, "region").select(F.col("r_name").alias("ontology")), _bound(spark, d)[2])
    return out.select("name", F.array_join("ontologies", ",").alias("ontologies"))


@query("SELECT 'user' || user_id AS dataset_id, event_type AS column_name, upper(event_type) AS label, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS INTEGER) AS position FROM (SELECT DISTINCT user_id, event_type FROM events)")
def sorted_event_labels(spark, d):
    """Event types of each user as columns, labelled and put in the order of their names."""
    e = table(spark, d, "events").select("user_id", "event_type").distinct()
    return evaluation.sorted_labels(e.select(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("dataset_id"), F.col("event_type").alias("column_name"), F.upper("event_type").alias("label")))


def _arrived(spark, d):
    """Value counts of two arrivals of items and orders, kept apart."""
    for odd in (0, 1):
        parts = {"lineitem": table(spark, d, "lineitem").filter(F.col("l_orderkey") % 2 == odd), "orders": table(spark, d, "orders").filter(F.col("o_orderkey") % 2 == odd)}
        path = shared_path(spark)
        profile.value_counts(tables.all_cells(parts)).write.parquet(path)
        yield spark.read.parquet(path)


@query(f"SELECT * FROM ({SQL['profile_numeric']}) WHERE column_id LIKE '%@lineitem' OR column_id LIKE '%@orders'")
def merged_numeric(spark, d):
    """Statistics of numbers of two arrivals from their stored counts."""
    return profile.numeric(profile.merged(*_arrived(spark, d)))


@query(f"SELECT * FROM ({SQL['profile_basic']}) WHERE column_id LIKE '%@lineitem' OR column_id LIKE '%@orders'")
def merged_basic(spark, d):
    """Distinct, missing and pattern shares of two arrivals from their stored counts."""
    return profile.basic(profile.merged(*_arrived(spark, d)))
