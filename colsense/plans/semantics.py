"""Queries on ontologies and descriptions that Spark derives from the given tables, and the same in SQL.

Ontology: regions, nations and suppliers are classes under one another; each order priority is an object property from
the nations of its customers to their market segments; supplier name, balance and phone stand as data properties.
Descriptions: an order is a graph of its items and their parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import graphs, ontology
from ..operators.ontology import DOMAIN, OWL, RANGE, RDF_TYPE, SUBCLASS, XSD
from ..sources import descriptions, statements
from ..sources.store import dealt
from ..sources.tables import table
from .base import query

BASE = "http://data.test/"


def _uri(kind: str, c) -> F.Column:
    return F.concat(F.lit(f"{BASE}{kind}#"), F.col(c).cast("string"))


def _triples(spark, d) -> DataFrame:
    n, r, s = table(spark, d, "nation"), table(spark, d, "region"), table(spark, d, "supplier")
    nation, region = _uri("nation", "n_name"), _uri("region", "r_name")
    st = lambda df, a, p, o: df.select(a.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit("uri").alias("o_kind")).distinct()
    use = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderpriority", "c_nationkey", "c_mktsegment").distinct().join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    prop, number, named = _uri("priority", "o_orderpriority"), F.lit(BASE + "prop#balance"), F.lit(BASE + "prop#name")
    placed = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    parts = [
        st(r, region, RDF_TYPE, F.lit(OWL + "Class")), st(placed, nation, SUBCLASS, region),
        st(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")), _uri("supplier", "s_suppkey"), SUBCLASS, nation),
        st(use, prop, RDF_TYPE, F.lit(OWL + "ObjectProperty")), st(use, prop, DOMAIN, nation), st(use, prop, RANGE, _uri("segment", "c_mktsegment")),
        st(r, named, RDF_TYPE, F.lit(OWL + "DatatypeProperty")), st(r, named, DOMAIN, region), st(r, named, RANGE, F.lit(XSD + "string")),
        st(r, number, RDF_TYPE, F.lit(OWL + "DatatypeProperty")), st(n, number, DOMAIN, nation), st(n, number, RANGE, F.lit(XSD + "double")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


U = f"'{BASE}"
TRIPLES = f"""n AS (SELECT *, {U}nation#' || n_name AS nu FROM nation), r AS (SELECT *, {U}region#' || r_name AS ru FROM region),
 use AS (SELECT DISTINCT {U}priority#' || o_orderpriority AS pr, nu, {U}segment#' || c_mktsegment AS sg FROM orders JOIN customer ON o_custkey = c_custkey JOIN n ON c_nationkey = n_nationkey),
 t AS (SELECT ru AS s, '{RDF_TYPE}' AS p, '{OWL}Class' AS o FROM r UNION SELECT nu, '{SUBCLASS}', ru FROM n JOIN r ON n_regionkey = r_regionkey
 UNION SELECT {U}supplier#' || s_suppkey, '{SUBCLASS}', nu FROM supplier JOIN n ON s_nationkey = n_nationkey
 UNION SELECT pr, '{RDF_TYPE}', '{OWL}ObjectProperty' FROM use UNION SELECT pr, '{DOMAIN}', nu FROM use UNION SELECT pr, '{RANGE}', sg FROM use
 UNION SELECT {U}prop#name', '{RDF_TYPE}', '{OWL}DatatypeProperty' FROM r UNION SELECT {U}prop#name', '{DOMAIN}', ru FROM r UNION SELECT {U}prop#name', '{RANGE}', '{XSD}string' FROM r
 UNION SELECT {U}prop#balance', '{RDF_TYPE}', '{OWL}DatatypeProperty' FROM r UNION SELECT {U}prop#balance', '{DOMAIN}', nu FROM n UNION SELECT {U}prop#balance', '{RANGE}', '{XSD}double' FROM n),
 cl AS (SELECT s AS class FROM t WHERE p = '{RDF_TYPE}' AND o = '{OWL}Class' UNION SELECT s FROM t WHERE p = '{SUBCLASS}' UNION SELECT o FROM t WHERE p = '{SUBCLASS}' UNION SELECT o FROM t WHERE p = '{DOMAIN}' UNION SELECT sg FROM use),
 pa AS (SELECT s AS class, max(o) AS parent FROM t WHERE p = '{SUBCLASS}' GROUP BY 1),
 ch AS (SELECT class, class AS ancestor, 0 AS depth FROM cl UNION ALL SELECT ch.class, parent, depth + 1 FROM ch JOIN pa ON ancestor = pa.class),
 dp AS (SELECT ru AS class, 'name' AS label, 'string' AS dtype FROM r UNION SELECT nu, 'balance', 'double' FROM n),
 li AS (SELECT DISTINCT a.nu AS src, split_part(a.pr, '#', 2) AS label, b.sg AS dst, {U}priority#' AS prefix FROM use a JOIN use b USING (pr))"""
W = f"WITH RECURSIVE {TRIPLES}"


@query(f"{W} SELECT class FROM cl")
def ontology_classes(spark, d):
    return ontology.classes(_triples(spark, d))


@query(f"{W} SELECT class, parent FROM pa")
def ontology_parents(spark, d):
    return ontology.parents(_triples(spark, d))


@query(f"{W} SELECT src, label, dst, prefix FROM li")
def ontology_links(spark, d):
    return ontology.links(_triples(spark, d))


@query(f"{W} SELECT class, label, dtype, {U}prop#' AS prefix FROM dp")
def ontology_data_properties(spark, d):
    return ontology.data_properties(_triples(spark, d))


def _chain(t: DataFrame) -> DataFrame:
    return ontology.chain(ontology.classes(t), ontology.parents(t))


@query(f"{W} SELECT class, ancestor, depth FROM ch")
def class_ancestors(spark, d):
    return _chain(_triples(spark, d))


@query(f"{W} SELECT class, max(depth) AS depth FROM ch GROUP BY 1")
def class_order(spark, d):
    return ontology.ordered(_chain(_triples(spark, d)))


@query(f"{W} SELECT DISTINCT ch.class, label, dtype, {U}prop#' AS prefix FROM ch JOIN dp ON ancestor = dp.class")
def inherited_properties(spark, d):
    t = _triples(spark, d)
    return ontology.inherited(_chain(t), ontology.data_properties(t))


@query(f"{W} SELECT DISTINCT a.class AS src, label, b.class AS dst, prefix FROM li JOIN ch a ON a.ancestor = src JOIN ch b ON b.ancestor = dst")
def inferred_links(spark, d):
    t = _triples(spark, d)
    return ontology.inferred_links(ontology.links(t), _chain(t))


@query(f"{W} SELECT DISTINCT s, p, o FROM t")
def statements_round_trip(spark, d):
    """All statements written as lines and parsed again."""
    return statements.parsed(statements.lines(_triples(spark, d))).select("s", "p", "o").distinct()


def _items(spark, d) -> DataFrame:
    """Items numbered within their order, dealt by order."""
    nth = F.row_number().over(Window.partitionBy("ssd_id").orderBy("l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"))
    # the name is given before items are numbered, so that Spark knows them to be dealt by ssd_id
    li = dealt(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ssd_id"), "l_linenumber", "l_returnflag", "l_linestatus", "l_partkey"), "ssd_id")
    return li.withColumn("l", nth.cast("long")).drop("l_linenumber")


def _parts(node, link) -> tuple:
    """An item's nodes and links, of its row alone: the order, its own nodes, its own links, and the link to its column."""
    l, flag, status = F.col("l"), F.col("l_returnflag"), F.col("l_linestatus")
    zero, data, column, base = F.lit(0).cast("long"), l + 100000, l + 200000, F.lit(BASE)
    n = lambda i, t, label: node(i, F.lit(t), label.cast("string"), base)
    e = lambda k, a, b, label, t: link(l * 3 + k, a, b, label, F.lit(t), base)
    own = [n(l, "ClassNode", flag), n(data, "DataNode", status), n(column, "Column", F.col("l_partkey"))]
    ties = [e(0, zero, l, F.lit("has"), "ObjectPropertyLink"), e(1, l, data, status, "DataPropertyLink")]
    return n(zero, "ClassNode", F.lit("order")), own, ties, e(2, data, column, F.lit("connect"), "ColumnLink")


def _graph(spark, d) -> tuple[DataFrame, DataFrame]:
    """Node 0 is the order, node l of an item l, 100000 + l its data node, 200000 + l its column; items of even number aren't mapped."""
    li, l = _items(spark, d), F.col("l")
    named = lambda *names: lambda *c: F.struct(*[x.alias(name) for x, name in zip(c, names, strict=True)])
    order, own, ties, connect = _parts(named("node_id", "type", "label", "prefix"), named("link_id", "source", "target", "label", "type", "prefix"))
    nodes = li.select("ssd_id", F.inline(F.when(l == 1, F.array(order, *own)).otherwise(F.array(*own))))
    return nodes, li.select("ssd_id", F.inline(F.when(l % 2 == 1, F.array(*ties, connect)).otherwise(F.array(*ties))))


def _graph_rows(spark, d) -> DataFrame:
    """The same nodes and links as rows of one kind for `descriptions.texts_of`, so that items are numbered once."""
    order, own, ties, connect = _parts(descriptions.node_row, descriptions.link_row)
    l = F.col("l")
    return _items(spark, d).select("ssd_id", F.inline(F.when(l == 1, F.array(order, *own, *ties, connect)).when(l % 2 == 1, F.array(*own, *ties, connect)).otherwise(F.array(*own, *ties))))


LI = "li AS (SELECT l_orderkey AS ssd_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus) AS l, l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR) AS pk FROM lineitem)"
NODES = LI + f""", nodes AS (SELECT DISTINCT ssd_id, CAST(0 AS BIGINT) AS node_id, 'ClassNode' AS type, 'order' AS label FROM li UNION ALL SELECT ssd_id, l, 'ClassNode', l_returnflag FROM li
 UNION ALL SELECT ssd_id, l + 100000, 'DataNode', l_linestatus FROM li UNION ALL SELECT ssd_id, l + 200000, 'Column', pk FROM li),
 links AS (SELECT ssd_id, CAST(0 AS BIGINT) AS source, l AS target FROM li UNION ALL SELECT ssd_id, l, l + 100000 FROM li UNION ALL SELECT ssd_id, l + 100000, l + 200000 FROM li WHERE l % 2 = 1)"""
TR = LI + f""", x AS (SELECT ssd_id, 3 * l AS i, '{BASE}order' AS s, '{BASE}has' AS p, '{BASE}' || l_returnflag AS o FROM li UNION ALL SELECT ssd_id, 3 * l + 1, '{BASE}' || l_returnflag, '{BASE}' || l_linestatus, '{BASE}' || l_linestatus FROM li),
 tr AS (SELECT ssd_id, s, p, o, CAST(row_number() OVER (PARTITION BY ssd_id, s, p, o ORDER BY i) - 1 AS INTEGER) AS n FROM x)"""


@query(f"WITH {NODES}, o AS (SELECT *, CASE WHEN type = 'DataNode' THEN node_id - 100000 END AS own FROM nodes) SELECT ssd_id, node_id, type, label, CASE WHEN count(*) OVER w > 1 THEN CAST(row_number() OVER (PARTITION BY ssd_id, type, own, label ORDER BY node_id) - 1 AS INTEGER) END AS idx FROM o WINDOW w AS (PARTITION BY ssd_id, type, own, label)")
def node_instances(spark, d):
    """Data nodes are numbered within their class node, which is an item of its own here."""
    return graphs.instance_index(*_graph(spark, d)).drop("prefix")


@query(f"WITH {NODES}, e AS (SELECT ssd_id, source AS node_id FROM links UNION ALL SELECT ssd_id, target FROM links), g AS (SELECT ssd_id, node_id, count(*) AS degree FROM e GROUP BY ALL) SELECT ssd_id, node_id, coalesce(degree, 0) AS degree FROM nodes LEFT JOIN g USING (ssd_id, node_id)")
def node_degrees(spark, d):
    return graphs.degrees(*_graph(spark, d))


@query(f"WITH {LI} SELECT ssd_id, pk AS \"column\", l + 100000 AS node_id FROM li WHERE l % 2 = 1")
def graph_mappings(spark, d):
    return graphs.mappings(*_graph(spark, d))


@query(f"WITH {LI} SELECT ssd_id, l + 200000 AS node_id FROM li WHERE l % 2 = 0")
def unmapped_columns(spark, d):
    return graphs.unmapped(*_graph(spark, d)).select("ssd_id", "node_id")


@query(f"WITH {LI}, m AS (SELECT ssd_id, max(l) + 200000 AS top FROM li GROUP BY 1), k AS (SELECT ssd_id, CAST(row_number() OVER (PARTITION BY ssd_id ORDER BY l) AS BIGINT) AS i FROM li WHERE l % 2 = 0) SELECT ssd_id, top + 2 * i - j AS node_id, CASE j WHEN 1 THEN 'Unknown' ELSE 'unknown' END AS label FROM k JOIN m USING (ssd_id), (VALUES (0), (1)) v(j)")
def fill_unknown(spark, d):
    return graphs.fill_unknown(*_graph(spark, d), BASE)[0].select("ssd_id", "node_id", "label")


@query(f"WITH {LI}, m AS (SELECT ssd_id, max(l) + 200001 AS top FROM li GROUP BY 1) SELECT ssd_id, top AS source, l AS target FROM li JOIN m USING (ssd_id) UNION ALL SELECT ssd_id, top, 0 FROM m")
def connect_classes(spark, d):
    return graphs.connector(*_graph(spark, d))[1].select("ssd_id", "source", "target")


@query(f"WITH {LI} SELECT ssd_id, CAST(0 AS BIGINT) AS node_id FROM li WHERE l <> 1 GROUP BY 1 UNION ALL SELECT ssd_id, l + k FROM li, (VALUES (0), (100000), (200000)) v(k) WHERE l <> 1")
def remove_nodes(spark, d):
    """Graphs without the column of their first item: its data node goes too, then its item, then an order without others."""
    nodes, links = _graph(spark, d)
    return graphs.remove_nodes(nodes, links, nodes.filter("node_id = 200001").select("ssd_id", "node_id"))[0].select("ssd_id", "node_id")


@query(f"WITH {TR} SELECT * FROM tr")
def graph_triples(spark, d):
    return graphs.triples(*_graph(spark, d))


@query(f"""WITH {TR}, u AS (SELECT *, CASE WHEN s LIKE '%order' THEN p ELSE '{BASE}x' END AS q FROM tr WHERE o NOT LIKE '%R'), z AS (SELECT tr.ssd_id, s, p, o, n, 0 AS r, 1 AS t FROM tr UNION ALL SELECT ssd_id, s, q, o, n, 1, 0 FROM u),
 g AS (SELECT ssd_id, max(r) AS r, max(t) AS t FROM z GROUP BY ssd_id, s, p, o, n), h AS (SELECT ssd_id, sum(r * t) AS b, sum(r) AS r, sum(t) AS t, count(*) AS a FROM g GROUP BY 1)
SELECT ssd_id, CASE WHEN r = 0 THEN 0.0 ELSE round(b / r, 6) END AS precision, CASE WHEN t = 0 THEN 0.0 ELSE round(b / t, 6) END AS recall, round(b / a, 6) AS jaccard FROM h""")
def compare_graphs(spark, d):
    """Descriptions against copies without links to returned items and with other data properties."""
    truth = graphs.triples(*_graph(spark, d))
    changed = truth.filter(~F.col("o").endswith("R")).withColumn("p", F.when(F.col("s").endswith("order"), F.col("p")).otherwise(F.lit(BASE + "x")))
    return graphs.compare(changed, truth)
