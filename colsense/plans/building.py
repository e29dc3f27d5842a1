"""Queries on description texts, bulk building, candidate models and classifiers, and the same in SQL.

All inputs are derived from the given tables: an order is a dataset or description, its items are columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import building, candidates, graphs, models, profile
from ..sources import descriptions, tables
from ..sources.store import dealt, written
from ..sources.tables import PROFILED, table
from .base import query
from .semantics import BASE, LI, _graph


def _described(spark, d) -> DataFrame:
    nodes, links = _graph(spark, d)
    names = nodes.select("ssd_id").distinct().withColumn("name", F.concat(F.lit("order"), F.col("ssd_id").cast("string")))
    return descriptions.parsed(descriptions.texts(names, nodes, links))


def _stored(spark, d) -> DataFrame:
    """The same, written once, for queries that take several tables from it."""
    return written(_described(spark, d))


@query(f"WITH {LI} SELECT DISTINCT ssd_id, CAST(0 AS BIGINT) AS node_id, 'ClassNode' AS type, 'order' AS label, NULL::VARCHAR AS class_label FROM li UNION ALL SELECT ssd_id, l, 'ClassNode', l_returnflag, NULL FROM li UNION ALL SELECT ssd_id, l + 100000, 'DataNode', l_linestatus, l_returnflag FROM li")
def description_nodes(spark, d):
    """Nodes of descriptions written as JSON and read again."""
    return descriptions.nodes(_described(spark, d)).drop("prefix")


@query(f"WITH {LI} SELECT ssd_id, l * 3 AS link_id, CAST(0 AS BIGINT) AS source, l AS target, 'has' AS label, 'ObjectPropertyLink' AS type, '{BASE}' AS prefix FROM li UNION ALL SELECT ssd_id, l * 3 + 1, l, l + 100000, l_linestatus, 'DataPropertyLink', '{BASE}' FROM li")
def description_links(spark, d):
    return descriptions.links(_described(spark, d))


@query(f"WITH {LI} SELECT ssd_id, pk AS name, l + 200000 AS attr_id, CASE WHEN l % 2 = 1 THEN l + 100000 END AS node_id FROM li")
def description_mappings(spark, d):
    """Attributes of the descriptions with the data nodes they are mapped to."""
    x = _stored(spark, d)
    return descriptions.attributes(x).join(descriptions.mapped(x), ["ssd_id", "attr_id"], "left").select("ssd_id", "name", "attr_id", "node_id")


@query(f"WITH {LI} SELECT ssd_id, pk AS \"column\", l_returnflag || '---' || l_linestatus AS semantic_type FROM li WHERE l % 2 = 1")
def column_map(spark, d):
    return descriptions.column_map(descriptions.nodes(_described(spark, d)), graphs.mappings(*_graph(spark, d)))


@query("""WITH z AS (SELECT o_custkey AS k, 0 AS i FROM orders UNION SELECT c_custkey, 1 FROM customer UNION SELECT c_custkey, 2 FROM customer WHERE c_acctbal > 0),
 g AS (SELECT k, max(CASE WHEN i = 0 THEN 1 ELSE 0 END) AS a, max(CASE WHEN i = 1 THEN 1 ELSE 0 END) AS b, max(CASE WHEN i = 2 THEN 1 ELSE 0 END) AS c FROM z GROUP BY 1)
SELECT CAST(k AS VARCHAR) AS filename, concat_ws(',', CASE WHEN a = 0 THEN '0' END, CASE WHEN b = 0 THEN '1' END, CASE WHEN c = 0 THEN '2' END) AS missing FROM g WHERE a + b + c < 3""")
def unmatched_names(spark, d):
    """Customers that orders, the customer table or those with a balance lack."""
    c = table(spark, d, "customer")
    name = lambda df, k: df.select(F.col(k).cast("string"))
    return descriptions.unmatched(name(table(spark, d, "orders"), "o_custkey"), name(c, "c_custkey"), name(c.filter("c_acctbal > 0"), "c_custkey")).withColumn("missing", F.array_join("missing", ","))


def _alignment(spark, d):
    nodes, links = _graph(spark, d)
    at = lambda c: F.concat(F.lit("n"), F.col(c).cast("string"))
    n = nodes.filter("type <> 'Column'").select("ssd_id", F.struct(at("node_id").alias("id"), F.when(F.col("type") == "ClassNode", "InternalNode").otherwise("ColumnNode").alias("type"), F.struct(F.concat("prefix", "label").alias("uri")).alias("label")).alias("n"))
    e = links.filter("type <> 'ColumnLink'").select("ssd_id", F.struct(F.concat_ws("---", at("source"), F.concat("prefix", "label"), at("target")).alias("id"), "type", F.col("link_id").cast("double").alias("weight")).alias("e"))
    g = n.groupBy("ssd_id").agg(F.collect_list("n").alias("nodes")).join(e.groupBy("ssd_id").agg(F.collect_list("e").alias("links")), "ssd_id")
    return descriptions.alignment(g.select("ssd_id", F.to_json(F.struct("nodes", "links")).alias("value")))


@query(f"WITH {LI} SELECT DISTINCT ssd_id, 'n0' AS id, 'ClassNode' AS type, 'order' AS label, '{BASE}' AS prefix FROM li UNION ALL SELECT ssd_id, 'n' || l, 'ClassNode', l_returnflag, '{BASE}' FROM li UNION ALL SELECT ssd_id, 'n' || (l + 100000), 'DataNode', l_returnflag || '---' || l_linestatus, '{BASE}' FROM li")
def alignment_nodes(spark, d):
    return _alignment(spark, d)[0]


@query(f"WITH {LI} SELECT ssd_id, 'n0' AS source, 'n' || l AS target, 'has' AS label, '{BASE}' AS prefix, 'ObjectPropertyLink' AS type, CAST(3 * l AS DOUBLE) AS weight FROM li UNION ALL SELECT ssd_id, 'n' || l, 'n' || (l + 100000), l_linestatus, '{BASE}', 'DataPropertyLink', CAST(3 * l + 1 AS DOUBLE) FROM li")
def alignment_links(spark, d):
    return _alignment(spark, d)[1]


def _maps(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ssd_id"), F.col("l_partkey").cast("string").alias("column"), F.col("l_returnflag").alias("class"), F.col("l_linestatus").alias("label"), "l_quantity")


@query("""WITH m AS (SELECT l_orderkey AS ssd_id, CAST(l_partkey AS VARCHAR) AS c, l_returnflag AS class, l_linestatus AS label FROM lineitem), k AS (SELECT DISTINCT l_orderkey AS ssd_id, CAST(l_partkey AS VARCHAR) AS c FROM lineitem WHERE l_quantity > 5)
SELECT m.ssd_id, m.c AS "column", class, label, CASE WHEN k.c IS NULL THEN 'no such column' WHEN class = 'A' THEN 'no such property' WHEN count(*) OVER (PARTITION BY m.ssd_id, m.c) > 1 THEN 'column mapped twice' WHEN count(*) OVER (PARTITION BY m.ssd_id, class, label) > 1 THEN 'data node used twice' END AS why FROM m LEFT JOIN k ON k.ssd_id = m.ssd_id AND k.c = m.c""")
def checked_map(spark, d):
    m = _maps(spark, d)
    return building.checked_map(m.drop("l_quantity"), m.filter("l_quantity > 5"), m.filter("class <> 'A'"))


def _built(spark, d):
    m = dealt(_maps(spark, d).drop("l_quantity"), "ssd_id").groupBy("ssd_id", "class", "label").agg(F.min("column").alias("column"))
    m = m.groupBy("ssd_id", "column").agg(F.min(F.struct("class", "label")).alias("p")).select("ssd_id", "column", "p.*")
    links = m.select("ssd_id", F.col("class").alias("src"), F.lit("in").alias("label"), F.lit("order").alias("dst")).distinct()
    return building.built(m, links)


BUILT = """m0 AS (SELECT l_orderkey AS ssd_id, l_returnflag AS class, l_linestatus AS label, min(CAST(l_partkey AS VARCHAR)) AS c FROM lineitem GROUP BY ALL),
 m AS (SELECT ssd_id, c, split_part(min(class || '|' || label), '|', 1) AS class, split_part(min(class || '|' || label), '|', 2) AS label FROM m0 GROUP BY ALL),
 x AS (SELECT ssd_id, 0 AS k, '' AS owner, class AS label FROM m UNION SELECT ssd_id, 0, '', 'order' FROM m UNION SELECT ssd_id, 1, class, label FROM m UNION SELECT ssd_id, 2, '', c FROM m),
 n AS (SELECT *, row_number() OVER (PARTITION BY ssd_id ORDER BY k, owner, label) - 1 AS node_id FROM x)"""


@query(f"WITH {BUILT} SELECT ssd_id, node_id, label, ['ClassNode', 'DataNode', 'Column'][k + 1] AS type FROM n")
def built_nodes(spark, d):
    return _built(spark, d)[0].drop("prefix")


@query(f"""WITH {BUILT}, e AS (SELECT m.ssd_id, a.node_id AS s, b.node_id AS t, c.node_id AS o, z.node_id AS top, m.label FROM m JOIN n a ON a.ssd_id = m.ssd_id AND a.k = 0 AND a.label = m.class JOIN n b ON b.ssd_id = m.ssd_id AND b.k = 1 AND b.owner = m.class AND b.label = m.label JOIN n c ON c.ssd_id = m.ssd_id AND c.k = 2 AND c.label = m.c JOIN n z ON z.ssd_id = m.ssd_id AND z.k = 0 AND z.label = 'order')
SELECT DISTINCT ssd_id, s AS source, top AS target, 'in' AS label, 'ObjectPropertyLink' AS type FROM e UNION ALL SELECT DISTINCT ssd_id, s, t, label, 'DataPropertyLink' FROM e UNION ALL SELECT ssd_id, t, o, 'connect', 'ColumnLink' FROM e""")
def built_links(spark, d):
    return _built(spark, d)[1].select("ssd_id", "source", "target", "label", "type")


def _removed(spark, d):
    nodes, links = _graph(spark, d)
    ids = nodes.select("ssd_id").distinct()
    target = F.explode(F.array(F.lit(None).cast("long"), F.lit(2).cast("long"))).alias("target")
    return building.remove_links(nodes, links, ids.select("ssd_id", F.lit("has").alias("label"), F.lit(0).cast("long").alias("source"), target))


@query(f"""WITH {LI}, c AS (SELECT ssd_id, count(*) AS n FROM li GROUP BY 1) SELECT ssd_id, 'has' AS label, CAST(0 AS BIGINT) AS source, CAST(NULL AS BIGINT) AS target, CASE WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS status FROM c
 UNION ALL SELECT ssd_id, 'has', 0, 2, CASE WHEN n > 1 THEN 'ok' ELSE 'missing' END FROM c""")
def remove_links_status(spark, d):
    return _removed(spark, d)[2]


@query(f"""WITH {LI}, c AS (SELECT ssd_id, count(*) AS n FROM li GROUP BY 1) SELECT ssd_id, CAST(0 AS BIGINT) AS node_id FROM c WHERE n > 1 UNION ALL SELECT ssd_id, l + k FROM li, (VALUES (0), (100000), (200000)) v(k)""")
def remove_links_nodes(spark, d):
    """Nodes left without the link to the order's only or second item: an order whose only item has gone goes too."""
    return _removed(spark, d)[0].select("ssd_id", "node_id")


@query("""WITH r AS (SELECT o_orderkey AS ref_id, o_custkey AS c, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS d, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS s FROM orders),
 j AS (SELECT ref_id, o_orderkey AS i, r.d IS NULL OR r.d = o_orderdate AS f1, (r.d IS NULL OR r.d = o_orderdate) AND (r.s IS NULL OR r.s = o_orderstatus) AS f2 FROM r LEFT JOIN orders ON c = o_custkey),
 g AS (SELECT ref_id, count(i) AS n0, min(i) AS i0, count(i) FILTER (f1) AS n1, min(i) FILTER (f1) AS i1, count(i) FILTER (f2) AS n2, min(i) FILTER (f2) AS i2 FROM j GROUP BY 1)
SELECT ref_id, CASE WHEN n0 <= 1 THEN i0 WHEN n1 <= 1 THEN i1 WHEN n2 <= 1 THEN i2 END AS item_id, CASE WHEN n0 > 1 AND n1 > 1 AND n2 > 1 THEN 'ambiguous' WHEN (CASE WHEN n0 <= 1 THEN n0 WHEN n1 <= 1 THEN n1 ELSE n2 END) = 0 THEN 'none' ELSE 'ok' END AS status FROM g""")
def resolve_references(spark, d):
    """Orders found again by customer, then date, then status, each of the last two not always given."""
    o = table(spark, d, "orders").filter("o_custkey IS NOT NULL")
    items = o.select(F.col("o_orderkey").alias("item_id"), "o_custkey", "o_orderdate", "o_orderstatus")
    refs = o.select(F.col("o_orderkey").alias("ref_id"), "o_custkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate")).alias("o_orderdate"), F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderstatus")).alias("o_orderstatus"))
    return building.resolve(refs, items, ["o_custkey", "o_orderdate", "o_orderstatus"])


def _scores(spark, d) -> DataFrame:
    return table(spark, d, "events").groupBy(F.col("user_id").alias("item"), F.col("event_type").alias("label")).agg(F.count("*").alias("score"))


@query("""WITH s AS (SELECT user_id AS item, event_type AS label, count(*) AS score FROM events GROUP BY ALL), t AS (SELECT DISTINCT event_type AS label FROM events),
 c AS (SELECT s.item, t.label AS predicted, CAST(sum(score * CASE WHEN s.label = t.label THEN 0 ELSE length(t.label) END) AS BIGINT) AS e FROM s, t GROUP BY ALL)
SELECT item, predicted, e AS expected_cost FROM c QUALIFY row_number() OVER (PARTITION BY item ORDER BY e, predicted) = 1""")
def decide_by_cost(spark, d):
    """Event type of each user by least expected cost, where a wrong type costs the length of its name."""
    s = _scores(spark, d)
    kinds = s.select("label").distinct().agg(F.collect_list("label").alias("l"))  # the few classes
    pairs = kinds.select(F.explode("l").alias("actual"), "l").select("actual", F.explode("l").alias("predicted"))
    return models.by_cost(s, pairs.withColumn("cost", F.when(F.col("actual") == F.col("predicted"), 0).otherwise(F.length("predicted")).cast("long")))


@query("""WITH s AS (SELECT user_id AS item, event_type AS label, count(*) AS score FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, label) AS k FROM s)
SELECT item, CASE WHEN score < 3 THEN 'Unknown' ELSE label END AS label, max(score) AS score, CAST(min(k) AS INTEGER) AS rank FROM r WHERE k <= 3 GROUP BY 1, 2""")
def semantic_types(spark, d):
    return candidates.semantic_types(_scores(spark, d), 3, 3)


def _uses(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ssd_id"), F.col("l_returnflag").alias("src"), F.col("l_linestatus").alias("label"), F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("dst"))


ALIGNED = """u AS (SELECT l_returnflag AS src, l_linestatus AS label, 'line' || l_linenumber AS dst, count(DISTINCT l_orderkey) AS support FROM lineitem GROUP BY 1, 2, 3),
 w AS (SELECT DISTINCT 'A' AS src, p_brand AS label, 'line1' AS dst FROM part), a AS (SELECT src, label, dst, coalesce(support, 0) AS support FROM u FULL JOIN w USING (src, label, dst))"""


def _aligned(spark, d) -> DataFrame:
    return candidates.alignment(_uses(spark, d), table(spark, d, "part").select(F.lit("A").alias("src"), F.col("p_brand").alias("label"), F.lit("line1").alias("dst")))


@query(f"WITH {ALIGNED} SELECT * FROM a")
def alignment_support(spark, d):
    return _aligned(spark, d)


@query(f"WITH {ALIGNED} SELECT src, dst, label, support FROM a QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY support DESC, label) = 1")
def best_links(spark, d):
    return candidates.best_links(_aligned(spark, d))


@query(f"""WITH RECURSIVE {LI.replace('l_linestatus, CAST', 'l_linestatus, l_quantity, CAST').replace('l_linestatus) AS l', 'l_linestatus, l_quantity) AS l')}, t AS (SELECT ssd_id, l - 1 AS p, 'a' || l_returnflag AS label, CAST(floor(l_quantity) AS DOUBLE) AS s FROM li UNION ALL SELECT ssd_id, l - 1, 'b' || l_linestatus, CAST(10 + l AS DOUBLE) FROM li),
 b AS (SELECT ssd_id, 0 AS p, label AS labels, s AS score FROM t WHERE p = 0 UNION ALL
 (SELECT b.ssd_id, b.p + 1, labels || ',' || t.label, score * t.s FROM b JOIN t ON t.ssd_id = b.ssd_id AND t.p = b.p + 1 QUALIFY row_number() OVER (PARTITION BY b.ssd_id ORDER BY score * t.s DESC, labels || ',' || t.label) <= 6))
SELECT ssd_id AS dataset, labels, score, CAST(row_number() OVER (PARTITION BY ssd_id ORDER BY score DESC, labels) AS INTEGER) AS rank FROM b WHERE p = (SELECT max(l) - 1 FROM li WHERE li.ssd_id = b.ssd_id) QUALIFY rank <= 3""")
def candidate_mappings(spark, d):
    """The three best combinations of types for the items of an order, by a beam of six."""
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity"))
    li = table(spark, d, "lineitem").withColumn("l", nth)
    two = F.array(F.struct(F.concat(F.lit("a"), "l_returnflag").alias("label"), F.floor("l_quantity").cast("double").alias("score")), F.struct(F.concat(F.lit("b"), "l_linestatus").alias("label"), (F.col("l") + 10).cast("double").alias("score")))
    types = li.select(F.col("l_orderkey").alias("dataset"), (F.col("l") - 1).alias("position"), F.inline(two))
    return candidates.candidate_mappings(types, 6, 3).withColumn("labels", F.array_join("labels", ","))


@query("""WITH m AS (SELECT o_custkey AS dataset, o_orderkey AS model, count(*) + 1 AS n_nodes, count(*) FILTER (l_linenumber % 2 = 1) AS n_mapped, 2 * count(*) AS n_columns,
 CAST(count(*) FILTER (l_returnflag = 'N') AS DOUBLE) / count(*) AS confidence, CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) / count(*) AS coherence, CAST(count(DISTINCT l_returnflag) AS DOUBLE) AS link_cost FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
 x AS (SELECT *, n_mapped / n_columns AS coverage, greatest(0, least(1, 1 - n_nodes / (2 * n_columns))) AS size_reduction FROM m), y AS (SELECT *, round((size_reduction * 1.0 + confidence * 2.0 + coherence * 1.0) / 4.0, 6) AS score FROM x)
SELECT dataset, model, round(coverage, 6) AS coverage, score, CAST(row_number() OVER (PARTITION BY dataset ORDER BY score DESC, link_cost, coverage DESC, model) AS INTEGER) AS rank FROM y""")
def rank_models(spark, d):
    """Orders as candidate models of their customer, scored and ranked."""
    j = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    n = F.count("*")
    m = j.groupBy(F.col("o_custkey").alias("dataset"), F.col("o_orderkey").alias("model")).agg(
        (n + 1).alias("n_nodes"), F.count_if(F.col("l_linenumber") % 2 == 1).alias("n_mapped"), (2 * n).alias("n_columns"), (F.count_if(F.col("l_returnflag") == "N") / n).alias("confidence"),
        (F.count_if(F.col("l_linestatus") == "F") / n).alias("coherence"), F.count_distinct("l_returnflag").cast("double").alias("link_cost"))
    return candidates.ranked(candidates.scored(m, 1.0, 2.0, 1.0)).select("dataset", "model", F.round("coverage", 6).alias("coverage"), "score", "rank")


FEATURES = ["prop_unique_vals", "prop_missing_vals", "prop_entries_with_hyphen", "is_discrete", "entropy_for_discrete_values", "ratio_alpha_chars", "prop_numerical_chars", "prop_whitespace_chars"]


def _labelled(spark, d) -> DataFrame:
    counts = profile.value_counts(tables.all_cells({t: table(spark, d, t) for t in PROFILED}))
    name, dataset = tables.split_column_id(F.col("column_id"))
    label = F.when(name.rlike("key$"), "key").when(name.rlike("name$|type$|brand$"), "text").otherwise("value")
    return profile.basic(counts).join(profile.chars(counts), "column_id").select("column_id", dataset.alias("dataset"), label.alias("label"), *FEATURES)


@query()
def predict_columns(spark, d):
    """Classes of the columns of all tables by a forest on their features."""
    rows = graphs.written(_labelled(spark, d))
    return models.predict(models.train(rows, FEATURES), rows, FEATURES).select("column_id", "label", "predicted", F.round("confidence", 6).alias("confidence"))
