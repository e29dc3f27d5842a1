"""Queries on evaluation over folds, views of predictions, bound descriptions, edited ontologies and parts of candidate models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import uris
from ..operators import building, candidates, evaluation, graphs, labels, metrics, ontology, profile, sampling
from ..sources import descriptions, tables
from ..sources.store import dealt, shared_path, written
from ..sources.tables import PROFILED, table
from .base import SQL as _LIBRARY, query
from .columns import CELLS, VC, _counts
from .semantics import BASE, LI, NODES, W, _graph, _graph_rows, _triples


FEATURES = ["ratio_alpha_chars", "prop_numerical_chars", "prop_whitespace_chars"]


def _folds(spark, d, by_dataset: bool = False) -> DataFrame:
    """Columns with shares of characters as features, a label by their names (none for dates), and a fold."""
    names = tables.column_names({t: table(spark, d, t) for t in PROFILED})
    label = F.when(F.col("name").endswith("key"), "key").when(F.col("name").endswith("name"), "name").when(~F.col("name").endswith("date"), "other")
    fold = names.select("column_id", F.col("dataset_id").alias("fold")) if by_dataset else sampling.kfold(names.select("column_id"), 5, "column_id")
    return written(profile.chars(_counts(spark, d)).join(names.select("column_id", label.alias("label")), "column_id").join(fold, "column_id"))


def _folds_sql(fold: str) -> str:
    mean = ", ".join(f"sum(o.{f}) / count(*) AS m_{f}" for f in FEATURES)
    away = " + ".join(f"pow(r.{f} - m_{f}, 2)" for f in FEATURES)
    return f"""WITH feat AS ({_LIBRARY["profile_chars"]}),
 r AS (SELECT *, split_part(column_id, '@', 1) AS nm, CASE WHEN nm LIKE '%key' THEN 'key' WHEN nm LIKE '%name' THEN 'name' WHEN nm NOT LIKE '%date' THEN 'other' END AS label, {fold} AS fold FROM feat),
 m AS (SELECT f.fold, o.label AS class, {mean} FROM (SELECT DISTINCT fold FROM r) f JOIN r o ON o.fold <> f.fold WHERE o.label IS NOT NULL GROUP BY ALL),
 best AS (SELECT r.fold, r.column_id, class FROM r JOIN m ON m.fold = r.fold QUALIFY row_number() OVER (PARTITION BY r.fold, r.column_id ORDER BY round({away}, 9), class) = 1),
 pred AS (SELECT r.column_id, r.fold, coalesce(label, 'unknown') AS actual, coalesce(class, 'unknown') AS predicted FROM r LEFT JOIN best ON best.fold = r.fold AND best.column_id = r.column_id)"""


_KFOLD, _DATASET = _folds_sql("CAST(ntile(5) OVER (ORDER BY column_id) - 1 AS INTEGER)"), _folds_sql("split_part(column_id, '@', 2)")


def _scored_sql(source: str) -> str:
    return _LIBRARY["mean_scores"].replace("SELECT month(l_shipdate) AS fold, l_returnflag AS a, CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'N' END AS p FROM lineitem", f"{source} SELECT fold, actual AS a, predicted AS p FROM pred")


@query(_KFOLD + " SELECT * FROM pred")
def cross_column_predictions(spark, d):
    """Classes of columns, each of five folds of all columns predicted from the others."""
    return evaluation.centroid_folds(_folds(spark, d), FEATURES)


@query(_scored_sql(_KFOLD))
def cross_column_scores(spark, d):
    """Mean scores of the five folds."""
    return evaluation.evaluated(cross_column_predictions(spark, d))[1]


@query(_scored_sql(_DATASET))
def cross_dataset_scores(spark, d):
    """Mean scores where each dataset is predicted from the others."""
    return evaluation.evaluated(evaluation.centroid_folds(_folds(spark, d, True), FEATURES))[1]


@query(f"WITH {VC}, fo AS (SELECT column_id, CAST(ntile(5) OVER (ORDER BY column_id) - 1 AS INTEGER) AS fold FROM (SELECT DISTINCT column_id FROM vc)) SELECT fold, column_id AS \"column\", count(*) AS n_values, CAST(sum(cnt) AS BIGINT) AS n_cells FROM vc JOIN fo USING (column_id) GROUP BY ALL")
def fold_columns(spark, d):
    """Cells of each fold's columns, counted."""
    all_ = {t: table(spark, d, t) for t in PROFILED}
    folds = sampling.kfold(tables.column_names(all_).select("column_id"), 5, "column_id")
    return evaluation.fold_columns(profile.value_counts(tables.all_cells(all_)), folds).groupBy("fold", "column").agg(F.count("*").alias("n_values"), F.sum("cnt").alias("n_cells"))


def _predictions(spark, d) -> DataFrame:
    """Event types of users as predictions: dataset, label, confidence, scores_ columns and a feature."""
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())  # the few types
    wide = evaluation.wide_scores(e.select("user_id", F.col("event_type").alias("label"), F.col("n").alias("score")), "user_id", kinds)
    best = e.groupBy("user_id").agg(F.min(F.struct((-F.col("n")).alias("m"), "event_type")).alias("b"), F.sum("n").alias("t"), F.max("last").alias("feature_last"))
    best = best.select("user_id", F.concat(F.lit("d"), (F.col("user_id") % 3).cast("string")).alias("dataset_id"), F.col("b.event_type").alias("label"), F.round(-F.col("b.m") / F.col("t"), 6).alias("confidence"), "feature_last")
    return best.join(wide, "user_id")


_EV = "e AS (SELECT user_id, event_type, count(*) AS n, max(event_id) AS last FROM events GROUP BY ALL)"


@query(f"WITH {_EV} SELECT user_id, 'd' || (user_id % 3) AS dataset_id, arg_min(event_type, (-n, event_type)) AS label, round(max(n) / sum(n), 6) AS confidence, max(last) AS feature_last FROM e WHERE user_id % 3 = 1 GROUP BY 1")
def prediction_of_dataset(spark, d):
    """Predictions of one dataset with a feature, without scores."""
    return evaluation.projected(_predictions(spark, d), ["user_id", "dataset_id", "label", "confidence"], features=["feature_last"], dataset="d1")


@query(f"WITH {_EV} SELECT u.user_id, t.event_type AS label, coalesce(e.n, 0) AS score FROM (SELECT DISTINCT user_id FROM e) u CROSS JOIN (SELECT DISTINCT event_type FROM e) t LEFT JOIN e ON e.user_id = u.user_id AND e.event_type = t.event_type")
def prediction_scores(spark, d):
    """The scores_ columns of all predictions as rows of labels without their prefix."""
    return evaluation.long_scores(evaluation.projected(_predictions(spark, d), ["user_id"], with_scores=True), "user_id")


@query(f"WITH {CELLS}, c AS (SELECT DISTINCT ds, name FROM cells) SELECT ds AS dataset_id, name AS column_name, upper(name) AS label, CAST(row_number() OVER (PARTITION BY ds ORDER BY name) - 1 AS INTEGER) AS position FROM c")
def sorted_labels(spark, d):
    names = tables.column_names({t: table(spark, d, t) for t in PROFILED})
    return evaluation.sorted_labels(names.select("dataset_id", F.col("name").alias("column_name"), F.upper("name").alias("label")))


@query("SELECT c_custkey, concat_ws(' ', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS who FROM customer")
def combined_columns(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return tables.combined(c, ["c_name", "c_mktsegment", "c_nationkey"], "who")


@query(f"""WITH {LI}, n AS (SELECT ssd_id, l, l_returnflag, l_linestatus, pk FROM li), big AS (SELECT DISTINCT l_orderkey AS ssd_id, CAST(l_partkey AS VARCHAR) AS pk FROM lineitem WHERE l_quantity > 10),
 ok AS (SELECT n.* FROM n JOIN big USING (ssd_id, pk) WHERE l % 2 = 1), al AS (SELECT DISTINCT ssd_id FROM ok), gone AS (SELECT ssd_id, l + 100000 AS node_id FROM n WHERE l % 2 = 1 AND NOT EXISTS (SELECT 1 FROM big WHERE big.ssd_id = n.ssd_id AND big.pk = n.pk)),
 nd AS (SELECT DISTINCT ssd_id, CAST(0 AS BIGINT) AS node_id, 'order' AS label FROM n UNION ALL SELECT ssd_id, l, l_returnflag FROM n UNION ALL SELECT ssd_id, l + 100000, l_linestatus FROM n)
SELECT ssd_id, node_id, label FROM nd JOIN al USING (ssd_id) WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.ssd_id = nd.ssd_id AND gone.node_id = nd.node_id)""")
def bound_nodes(spark, d):
    """Nodes of descriptions bound to those columns of theirs whose items are many."""
    return _bound(spark, d)[0].select("ssd_id", "node_id", "label")


@query(f"WITH {LI} SELECT ssd_id, l + 200000 AS attr_id, pk AS name FROM li WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = ssd_id AND CAST(x.l_partkey AS VARCHAR) = pk AND x.l_quantity > 10)")
def lost_attributes(spark, d):
    """Attributes of descriptions that no column is bound to."""
    return _bound(spark, d)[3]


def _texts(spark, d) -> DataFrame:
    heads = {"name": F.concat(F.lit("order"), F.col("ssd_id").cast("string")), "ontologies": F.array("ssd_id")}
    return descriptions.parsed(descriptions.texts_of(_graph_rows(spark, d), **heads))


def _bound(spark, d):
    x = written(_texts(spark, d))
    li = table(spark, d, "lineitem").filter("l_quantity > 10").select(F.col("l_orderkey").alias("ssd_id"), F.col("l_partkey").cast("string").alias("name")).distinct()
    columns = li.withColumn("column_id", F.concat_ws("@", "name", "ssd_id"))
    namespaces = x.select("ssd_id", F.lit(BASE).alias("namespace"))
    n, e, _ = descriptions.rebuilt(x)
    return graphs.bind(descriptions.attributes(x).drop("column_ids"), descriptions.mapped(x), n.filter("type <> 'Column'"), e.filter("type <> 'ColumnLink'"), columns, namespaces)


@query(f"WITH {LI} SELECT DISTINCT ssd_id, CAST(0 AS BIGINT) AS node_id, 'ClassNode' AS type, 'order' AS label FROM li UNION ALL SELECT ssd_id, l, 'ClassNode', l_returnflag FROM li UNION ALL SELECT ssd_id, l + 100000, 'DataNode', l_linestatus FROM li UNION ALL SELECT ssd_id, l + 200000, 'Column', pk FROM li")
def rebuilt_nodes(spark, d):
    """Graphs rebuilt from description texts; data nodes are named by their links."""
    return descriptions.rebuilt(_texts(spark, d))[0].drop("prefix")


@query(f"WITH {LI} SELECT ssd_id, 'order' || ssd_id AS name, CAST(ssd_id AS VARCHAR) AS ontology FROM li GROUP BY ALL")
def description_heads(spark, d):
    """Names and ontologies of descriptions written as JSON and read again."""
    return _texts(spark, d).select("ssd_id", "d.name", F.array_join("d.ontologies", ",").alias("ontology"))


_KINDS = [(False, False), (True, False), (False, True), (True, True)]


def _flags_sql() -> str:
    x = f"""x AS (SELECT ssd_id, 3 * l AS i, 0 AS k, '{BASE}order' AS s, '{BASE}has' AS p, '{BASE}' || l_returnflag AS o FROM li UNION ALL SELECT ssd_id, 3 * l + 1, 1, '{BASE}' || l_returnflag, '{BASE}' || l_linestatus, '{BASE}' || l_linestatus FROM li
 UNION ALL SELECT ssd_id, 3 * l + 2, 2, '{BASE}' || l_linestatus, 'ColumnLink', pk FROM li WHERE l % 2 = 1)"""
    parts = []
    for t, c in _KINDS:
        keep = "k = 0" + ("" if t else " OR k = 1") + ("" if c else " OR k = 2")
        parts.append(f"""SELECT ssd_id, {t} AS ignore_types, {c} AS ignore_columns, coalesce(CASE WHEN r = 0 THEN 0.0 ELSE round(b / r, 6) END, 0.0) AS precision, coalesce(CASE WHEN t = 0 THEN 0.0 ELSE round(b / t, 6) END, 0.0) AS recall, coalesce(round(b / a, 6), 0.0) AS jaccard
 FROM (SELECT DISTINCT ssd_id FROM li) LEFT JOIN (SELECT ssd_id, sum(r * t) AS b, sum(r) AS r, sum(t) AS t, count(*) AS a FROM (SELECT ssd_id, s, p, o, n, max(r) AS r, max(t) AS t FROM
 (SELECT ssd_id, s, p, o, row_number() OVER (PARTITION BY ssd_id, s, p, o ORDER BY i) AS n, 0 AS r, 1 AS t FROM x WHERE {keep} UNION ALL SELECT ssd_id, s, p, o, row_number() OVER (PARTITION BY ssd_id, s, p, o ORDER BY i), 1, 0 FROM x WHERE ({keep}) AND i % 5 <> 1) GROUP BY ALL) GROUP BY ALL) USING (ssd_id)""")
    return f"WITH {LI}, {x} " + " UNION ALL ".join(parts)


@query(_flags_sql())
def compare_graphs_flags(spark, d):
    """Descriptions against copies that lack some links, with and without semantic types and columns."""
    nodes, links = _graph(spark, d)
    return graphs.compare_each((nodes, links.filter("link_id % 5 <> 1")), (nodes, links), _KINDS)


@query(f"""WITH {LI}, z AS (SELECT ssd_id, '{BASE}order' AS s, '{BASE}has' AS p, '{BASE}' || l_returnflag AS o FROM li UNION ALL SELECT ssd_id, '{BASE}' || l_returnflag, '{BASE}' || l_linestatus, '{BASE}' || l_linestatus FROM li
 UNION ALL SELECT ssd_id, '{BASE}' || l_linestatus, 'ColumnLink', pk FROM li WHERE l % 2 = 1 UNION ALL SELECT ssd_id, 'All', 'connect', '{BASE}' || l_returnflag FROM li UNION ALL SELECT DISTINCT ssd_id, 'All', 'connect', '{BASE}order' FROM li)
SELECT ssd_id, s, p, o, count(*) AS n FROM z GROUP BY ALL""")
def triples_with_flags(spark, d):
    """Triples with the connector and with columns."""
    nodes, links = _graph(spark, d)
    top, ends = graphs.connector(nodes, links)
    t = graphs.triples(nodes.union(top), links.union(ends), include_all=True, include_columns=True)
    return t.groupBy("ssd_id", "s", "p", "o").agg(F.count("*").alias("n"))


@query(f"WITH {NODES} SELECT ssd_id, count(*) FILTER (type = 'ClassNode') AS class_nodes, count(*) FILTER (type = 'DataNode') AS data_nodes, count(*) FILTER (type = 'Column') AS columns, 2 * count(*) FILTER (type = 'DataNode') AS links FROM nodes GROUP BY 1")
def graph_summary(spark, d):
    return graphs.summary(*_graph(spark, d))


@query(f"WITH {LI} SELECT ssd_id, CASE WHEN pk LIKE '%7' THEN NULL ELSE 'part' || right(pk, 1) END AS dataset_id, CASE WHEN pk LIKE '%7' THEN 'unknown' ELSE 'ok' END AS status FROM li WHERE l = 1")
def dataset_of_graph(spark, d):
    """The dataset of each description's first mapped column; parts that end in 7 belong to none."""
    p = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("column")).filter(~F.col("column").endswith("7"))
    return graphs.dataset_of(*_graph(spark, d), p.select("column", F.concat(F.lit("part"), F.right("column", F.lit(1))).alias("dataset_id")))


@query(f"WITH {LI} SELECT l_returnflag AS class, l_linestatus AS label, ssd_id, pk AS \"column\" FROM li WHERE l % 2 = 1 AND l_returnflag = 'R'")
def data_node_columns(spark, d):
    """Columns of all descriptions that are mapped to data nodes of returned items."""
    nodes, links = _graph(spark, d)
    wanted = spark.createDataFrame([("R", "F"), ("R", "O")], "class string, label string")
    return graphs.columns_of_data_node(nodes, links, wanted)


@query(f"WITH {LI} SELECT ssd_id, 3 * l AS link_id, CAST(0 AS BIGINT) AS source, l AS target, 'has' AS label FROM li WHERE l = 2")
def edges_between(spark, d):
    nodes, links = _graph(spark, d)
    pairs = nodes.select("ssd_id", F.lit(0).cast("long").alias("source"), F.lit(2).cast("long").alias("target"))
    return graphs.edges_between(links, pairs).select("ssd_id", "link_id", "source", "target", "label")


@query("""WITH r AS (SELECT o_orderkey AS ref_id, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS c, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS d, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS s FROM orders),
 i AS (SELECT o_orderkey AS i, CASE WHEN o_orderkey % 11 > 0 THEN o_custkey END AS c, o_orderdate AS d, o_orderstatus AS s FROM orders),
 g AS (SELECT r.ref_id, count(i) FILTER (f0) AS n0, min(i) FILTER (f0) AS i0, count(i) FILTER (f0 AND f1) AS n1, min(i) FILTER (f0 AND f1) AS i1, count(i) FILTER (f0 AND f1 AND f2) AS n2, min(i) FILTER (f0 AND f1 AND f2) AS i2
 FROM (SELECT ref_id, i, r.c IS NULL OR i.c IS NULL OR r.c = i.c AS f0, r.d IS NULL OR r.d = i.d AS f1, r.s IS NULL OR r.s = i.s AS f2 FROM r, i) r GROUP BY 1)
SELECT ref_id, CASE WHEN n0 <= 1 THEN i0 WHEN n1 <= 1 THEN i1 WHEN n2 <= 1 THEN i2 END AS item_id, CASE WHEN n0 > 1 AND n1 > 1 AND n2 > 1 THEN 'ambiguous' WHEN (CASE WHEN n0 <= 1 THEN n0 WHEN n1 <= 1 THEN n1 ELSE n2 END) = 0 THEN 'none' ELSE 'ok' END AS status FROM g""")
def resolve_with_nulls(spark, d):
    """Orders found among all by customer, date and status, each of them missing in some, on either side."""
    o = table(spark, d, "orders")
    some = lambda ok, c: F.when(ok, F.col(c)).alias(c)
    k = F.col("o_orderkey")
    items = o.select(k.alias("item_id"), some(k % 11 > 0, "o_custkey"), "o_orderdate", "o_orderstatus")
    refs = o.select(k.alias("ref_id"), some(k % 5 > 0, "o_custkey"), some(k % 3 > 0, "o_orderdate"), some(k % 2 == 1, "o_orderstatus"))
    return building.resolve(refs, items, ["o_custkey", "o_orderdate", "o_orderstatus"])


def _new_classes(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    parent = F.concat(F.lit(f"{BASE}nation#"), F.when(F.col("p_size") % 2 == 0, "NATION").otherwise("NOWHERE"), (F.col("p_size") % 5).cast("string"))
    props = F.when(F.col("p_size") % 7 == 0, F.array(F.lit("size"), F.lit("size"))).otherwise(F.array(F.lit("size"), F.lit("kind")))
    return p.select(F.concat(F.lit(f"{BASE}part#"), F.col("p_partkey").cast("string")).alias("class"), F.when(F.col("p_size") % 3 > 0, parent).alias("parent"), props.alias("properties"))


_NEW = f"""nw AS (SELECT '{BASE}part#' || p_partkey AS class, CASE WHEN p_size % 3 > 0 THEN '{BASE}nation#' || CASE WHEN p_size % 2 = 0 THEN 'NATION' ELSE 'NOWHERE' END || (p_size % 5) END AS parent, p_size % 7 = 0 AS twice FROM part),
 bad AS (SELECT class, 'no such parent' AS why FROM nw WHERE parent IS NOT NULL AND parent NOT IN (SELECT class FROM cl) UNION ALL SELECT class, 'repeated property' FROM nw WHERE twice)"""


@query(f"{W}, {_NEW} SELECT class, why FROM bad")
def class_violations(spark, d):
    """Parts as new classes that can't be added, and why."""
    return ontology.class_violations(ontology.classes(_triples(spark, d)), _new_classes(spark, d))


@query(f"{W}, {_NEW} SELECT class, parent FROM pa UNION SELECT class, parent FROM nw WHERE parent IS NOT NULL AND class NOT IN (SELECT class FROM bad)")
def added_class_parents(spark, d):
    """Parents once parts are added as classes."""
    t = _triples(spark, d)
    return ontology.added_classes(ontology.classes(t), ontology.parents(t), ontology.data_properties(t), _new_classes(spark, d))[1]


def _new_links(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    u = lambda kind, c: F.concat(F.lit(f"{BASE}{kind}#"), F.col(c).cast("string"))
    return s.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(u("supplier", "s_suppkey").alias("src"), F.lit("in").alias("label"), F.when(F.col("s_suppkey") % 4 > 0, u("nation", "n_name")).otherwise(u("planet", "n_name")).alias("dst"))


@query(f"{W} SELECT src, label, dst FROM li UNION SELECT '{BASE}supplier#' || s_suppkey, 'in', '{BASE}nation#' || n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 > 0 EXCEPT SELECT src, label, dst FROM li WHERE label LIKE '1%'")
def edited_links(spark, d):
    """Links with suppliers put in their nations (those in planets aren't classes), without those of urgent orders."""
    t = _triples(spark, d)
    known = ontology.links(t)
    more = ontology.added_links(ontology.classes(t), known, _new_links(spark, d))
    return ontology.without_links(more, known.filter("label LIKE '1%'").select("src", "label", "dst")).select("src", "label", "dst")


@query(f"{W} SELECT src, label, dst, 'class' AS kind FROM li UNION ALL SELECT class, label, regexp_extract(class, '[^#]*$') || '.' || label, 'data' FROM dp")
def links_by_kind(spark, d):
    t = _triples(spark, d)
    return ontology.all_links(ontology.links(t), ontology.data_properties(t))


@query(f"{W}, w AS (SELECT DISTINCT n_name AS label, CASE WHEN n_nationkey % 2 = 0 THEN '{BASE}nation#' END AS prefix FROM nation UNION SELECT r_name, '{BASE}nation#' FROM region UNION SELECT DISTINCT CAST(s_suppkey AS VARCHAR), NULL FROM supplier), h AS (SELECT w.label, w.prefix, count(class) AS n, min(class) AS class FROM w LEFT JOIN cl ON regexp_extract(class, '[^#]*$') = label AND (prefix IS NULL OR class = prefix || label) GROUP BY ALL) SELECT label, prefix, CASE WHEN n = 1 THEN class END AS class, CASE n WHEN 0 THEN 'missing' WHEN 1 THEN 'ok' ELSE 'ambiguous' END AS status FROM h")
def found_classes(spark, d):
    n, r, s = table(spark, d, "nation"), table(spark, d, "region"), table(spark, d, "supplier")
    w = n.select(F.col("n_name").alias("label"), F.when(F.col("n_nationkey") % 2 == 0, f"{BASE}nation#").alias("prefix")).union(r.select("r_name", F.lit(f"{BASE}nation#"))).union(s.select(F.col("s_suppkey").cast("string"), F.lit(None).cast("string")))
    return ontology.found_classes(ontology.classes(_triples(spark, d)), w)


@query(f"{W} SELECT (SELECT count(*) FROM cl) AS class_nodes, (SELECT count(*) FROM dp) AS data_nodes, (SELECT count(*) FROM li) AS links")
def ontology_summary(spark, d):
    t = _triples(spark, d)
    return ontology.summary(ontology.classes(t), ontology.data_properties(t), ontology.links(t))


_PARTS = """mn AS (SELECT l_orderkey AS model, p_brand AS label, max(l_quantity) / 50 AS score FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
 ml AS (SELECT DISTINCT l_orderkey AS model, l_returnflag AS src, p_brand AS label, l_linestatus AS dst FROM lineitem JOIN part ON l_partkey = p_partkey),
 tl AS (SELECT DISTINCT month(l_shipdate) AS ssd_id, l_returnflag AS src, p_brand AS label, l_linestatus AS dst FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 49),
 sp AS (SELECT src, label, dst, count(*) AS support FROM tl GROUP BY ALL)"""


@query(f"""WITH {_PARTS}, a AS (SELECT model, avg(score) AS confidence, count(*) AS t FROM mn GROUP BY 1), b AS (SELECT model, max(n) AS n FROM (SELECT model, ssd_id, count(*) AS n FROM mn JOIN (SELECT DISTINCT ssd_id, label FROM tl) USING (label) GROUP BY ALL) GROUP BY 1),
 c AS (SELECT model, count(*) AS t, sum(1 / (1 + coalesce(support, 0))) AS cost FROM ml LEFT JOIN sp USING (src, label, dst) GROUP BY 1), e AS (SELECT model, max(n) AS n FROM (SELECT model, ssd_id, count(*) AS n FROM ml JOIN tl USING (src, label, dst) GROUP BY ALL) GROUP BY 1)
SELECT a.model, round(confidence, 6) AS confidence, round(coalesce(b.n, 0) / a.t, 6) AS node_coherence, round(coalesce(e.n, 0) / c.t, 6) AS link_coherence, round(cost, 6) AS link_cost FROM a LEFT JOIN b USING (model) LEFT JOIN c USING (model) LEFT JOIN e USING (model)""")
def model_parts(spark, d):
    """Orders as candidate models, months of large items as training descriptions."""
    li = table(spark, d, "lineitem")
    j = li.join(table(spark, d, "part").hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
    link = [F.col("l_returnflag").alias("src"), F.col("p_brand").alias("label"), F.col("l_linestatus").alias("dst")]
    # rows are dealt by model before they are grouped, and stay where they are
    model = F.col("l_orderkey").alias("model")
    nodes = dealt(j.select(model, link[1], "l_quantity"), "model", of=li).groupBy("model", "label").agg((F.max("l_quantity") / 50).alias("score"))
    training = written(j.filter("l_quantity > 49").select(F.month("l_shipdate").alias("ssd_id"), *link).distinct())
    out = candidates.model_parts(nodes, dealt(j.select(model, *link), "model", of=li), training.select("ssd_id", "label"), training, candidates.alignment(training))
    return out.select("model", *[F.round(c, 6).alias(c) for c in ("confidence", "node_coherence", "link_coherence", "link_cost")])


@query("""WITH m AS (SELECT o_custkey AS collection, 'ssd' AS kind, o_orderkey AS id FROM orders UNION SELECT o_custkey, 'ontology', o_orderkey % 40 FROM orders UNION SELECT c_custkey, 'ontology', c_nationkey FROM customer)
SELECT collection, kind, id FROM m WHERE NOT (kind = 'ssd' AND id % 9 = 0) AND NOT (kind = 'ssd' AND id % 2 = 0 OR kind = 'ontology' AND id < 25)""")
def unregistered_members(spark, d):
    """Collections of orders and nations, without every ninth order, whose members no catalogue has: odd orders, nations from 25."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    row = lambda df, a, kind, b: df.select(F.col(a).alias("collection"), F.lit(kind).alias("kind"), b.cast("long").alias("id"))
    members = row(o, "o_custkey", "ssd", F.col("o_orderkey")).union(row(o, "o_custkey", "ontology", F.col("o_orderkey") % 40))
    ninth = row(o.filter("o_orderkey % 9 = 0"), "o_custkey", "ssd", F.col("o_orderkey"))
    members = building.changed_members(members, row(c, "c_custkey", "ontology", F.col("c_nationkey")), ninth)
    known = o.filter("o_orderkey % 2 = 0").select(F.lit("ssd").alias("kind"), F.col("o_orderkey").alias("id")).union(spark.range(25).select(F.lit("ontology"), F.col("id")))
    return building.unregistered(members, known)


@query(f"WITH {CELLS}, c AS (SELECT DISTINCT ds, name FROM cells WHERE ds <> 'part'), s AS (SELECT ds, string_agg(name, ',' ORDER BY name) AS names FROM c GROUP BY 1) SELECT ds AS left_id, ds AS right_id FROM s")
def same_datasets(spark, d):
    """Datasets with the same columns in a catalogue and in one whose parts lack a column."""
    all_ = {t: table(spark, d, t) for t in PROFILED}
    return tables.same_datasets(tables.column_names(all_), tables.column_names(all_ | {"part": all_["part"].drop("p_name")}))


@query(f"""WITH {VC}, t AS ({_LIBRARY["infer_types"]}) SELECT column_id, {", ".join(f"CASE WHEN logical_type = '{k}' THEN 1 ELSE 0 END AS is_{k}" for k in ("integer", "float", "boolean", "date", "string"))} FROM t""")
def type_flags(spark, d):
    return profile.type_flags(profile.inferred_types(_counts(spark, d)))


def _labels(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels of documents as columns: old ones by quality, new ones by toxicity of every third, columns of even documents."""
    t = table(spark, d, "labels")
    old = t.select(F.col("doc_id").alias("column_id"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("label"))
    new = t.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("column_id"), F.concat(F.lit("t"), F.col("toxic").cast("string")).alias("label"))
    columns = table(spark, d, "documents").filter("doc_id % 2 = 0").select(F.col("doc_id").alias("column_id"), F.col("lang").alias("name"), F.col("source").alias("dataset_id"))
    return old, new, columns


_LAB = """old AS (SELECT doc_id AS column_id, 'q' || quality AS label FROM labels), nw AS (SELECT doc_id AS column_id, 't' || toxic AS label FROM labels WHERE doc_id % 3 = 0),
 ups AS (SELECT * FROM nw UNION ALL SELECT * FROM old WHERE column_id NOT IN (SELECT column_id FROM nw)), col AS (SELECT doc_id AS column_id, lang AS name, source AS dataset_id FROM documents WHERE doc_id % 2 = 0)"""


@query(f"WITH {_LAB} SELECT column_id, label, 'no such column' AS why FROM old WHERE column_id NOT IN (SELECT column_id FROM col) UNION ALL SELECT column_id, label, 'no such class' FROM old WHERE label <> 'q1'")
def label_violations(spark, d):
    old, _, columns = _labels(spark, d)
    return labels.violations(old, columns, old.filter("label = 'q1'").select("label").distinct())


@query(f"WITH {_LAB} SELECT * FROM ups")
def label_upsert(spark, d):
    old, new, _ = _labels(spark, d)
    return labels.upsert(old, new)


@query(f"WITH {_LAB} SELECT label AS user_label, name AS column_name, dataset_id, column_id FROM ups JOIN col USING (column_id)")
def label_listing(spark, d):
    old, new, columns = _labels(spark, d)
    return labels.listing(labels.upsert(old, new), columns)


@query(f"WITH {_LAB} SELECT old.column_id, old.label AS predicted, coalesce(nw.label, 'unknown') AS actual FROM old LEFT JOIN nw USING (column_id)")
def labels_with_truth(spark, d):
    old, new, _ = _labels(spark, d)
    return labels.with_truth(old, new)


@query(f"WITH {_LAB} SELECT DISTINCT label FROM ups UNION SELECT 'unknown'")
def label_universe(spark, d):
    old, new, _ = _labels(spark, d)
    return labels.class_universe(labels.upsert(old, new))


@query("SELECT coalesce(lang, 'unknown') AS actual, count(*) FILTER (source LIKE '%1') AS a, count(*) FILTER (source LIKE '%2') AS b, count(*) FILTER (source IS NULL OR source NOT LIKE '%1' AND source NOT LIKE '%2') AS c FROM documents GROUP BY 1")
def confusion_wide(spark, d):
    """Languages against three groups of sources, one column each."""
    rows = table(spark, d, "documents").select(F.col("lang").alias("actual"), F.when(F.col("source").endswith("1"), "a").when(F.col("source").endswith("2"), "b").otherwise("c").alias("predicted"))
    return metrics.confusion_wide(metrics.confusion(rows), ["a", "b", "c"])


@query(f"{W}, nl AS (SELECT '{BASE}supplier#' || s_suppkey AS src, CASE WHEN s_suppkey % 2 = 0 THEN '1-URGENT' ELSE 'none' END AS label, '{BASE}segment#BUILDING' AS dst, s_suppkey AS ssd_id FROM supplier), inf AS (SELECT DISTINCT a.class AS src, label, b.class AS dst FROM li JOIN ch a ON a.ancestor = src JOIN ch b ON b.ancestor = dst) SELECT nl.ssd_id, nl.src, nl.label, nl.dst, CASE WHEN inf.src IS NULL THEN 'no such link' END AS why FROM nl LEFT JOIN inf USING (src, label, dst)")
def checked_links(spark, d):
    """Links of suppliers, which inherit those of their nations, held against the ontology."""
    t = _triples(spark, d)
    allowed = ontology.inferred_links(ontology.links(t), ontology.chain(ontology.classes(t), ontology.parents(t)))
    label = F.when(F.col("s_suppkey") % 2 == 0, "1-URGENT").otherwise("none")
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("ssd_id"), F.concat(F.lit(f"{BASE}supplier#"), F.col("s_suppkey").cast("string")).alias("src"), label.alias("label"), F.lit(f"{BASE}segment#BUILDING").alias("dst"))
    return building.checked_links(rows, allowed)


@query(f"{W} SELECT class AS s, '{ontology.RDF_TYPE}' AS p, '{ontology.OWL}Class' AS o FROM cl UNION SELECT class, '{ontology.SUBCLASS}', parent FROM pa UNION SELECT prefix || label, '{ontology.RDF_TYPE}', '{ontology.OWL}ObjectProperty' FROM li UNION SELECT prefix || label, '{ontology.DOMAIN}', src FROM li UNION SELECT prefix || label, '{ontology.RANGE}', dst FROM li UNION SELECT '{BASE}prop#' || label, '{ontology.RDF_TYPE}', '{ontology.OWL}DatatypeProperty' FROM dp UNION SELECT '{BASE}prop#' || label, '{ontology.DOMAIN}', class FROM dp UNION SELECT '{BASE}prop#' || label, '{ontology.RANGE}', '{ontology.XSD}' || dtype FROM dp")
def ontology_statements(spark, d):
    """Classes, parents, links and properties as statements again."""
    t = _triples(spark, d)
    return ontology.to_statements(ontology.parents(t), ontology.classes(t), ontology.links(t), ontology.data_properties(t)).select("s", "p", "o")


@query(f"WITH {LI}, m AS (SELECT ssd_id, '{BASE}has' AS name, count(*) AS n FROM li GROUP BY 1) SELECT ssd_id, CASE WHEN n % 3 = 1 THEN '{BASE}o' || n END AS uri FROM m")
def ontology_uris(spark, d):
    """The one ontology that an order declares: orders of 1, 4, 7 items declare one, the others none or two."""
    m = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("ssd_id")).agg(F.count("*").alias("n"))
    own = F.concat(F.lit(f"{BASE}o"), F.col("n").cast("string"))
    declared = F.when(F.col("n") % 3 == 1, F.array(own)).when(F.col("n") % 3 == 2, F.array(own, F.concat(own, F.lit("x")))).otherwise(F.array(F.lit(None).cast("string")))
    rows = m.select("ssd_id", F.explode(declared).alias("s"))
    rows = rows.select("ssd_id", F.coalesce("s", F.lit(f"{BASE}y")).alias("s"), F.lit(ontology.RDF_TYPE).alias("p"), F.lit(ontology.OWL).alias("o_"), F.col("s").isNotNull().alias("is"))
    return ontology.ontology_uri(rows.select("ssd_id", "s", "p", F.concat("o_", F.when(F.col("is"), "Ontology").otherwise("Class")).alias("o")), "ssd_id")


@query("SELECT event_id, coalesce(regexp_extract(CAST(user_id AS VARCHAR) || '@' || event_type || '@d' || (event_id % 4), '^(.*)@[^@]*$', 1), '') AS name, 'd' || (event_id % 4) AS dataset FROM events")
def split_names(spark, d):
    """Full names parted at their last @."""
    e = table(spark, d, "events")
    name, dataset = tables.split_column_id(F.concat_ws("@", F.col("user_id").cast("string"), "event_type", F.concat(F.lit("d"), (F.col("event_id") % 4).cast("string"))))
    return e.select("event_id", name.alias("name"), dataset.alias("dataset"))


@query("SELECT o_orderkey, o_orderstatus || '.' || o_orderpriority AS short, o_orderstatus AS class, o_orderpriority AS property FROM orders")
def class_and_property(spark, d):
    o = table(spark, d, "orders")
    class_, prop = uris.class_and_property(F.concat_ws(".", "o_orderstatus", "o_orderpriority"))
    return o.select("o_orderkey", F.concat_ws(".", "o_orderstatus", "o_orderpriority").alias("short"), class_.alias("class"), prop.alias("property"))


@query(f"WITH {LI} SELECT ssd_id, CAST(0 AS BIGINT) AS source, min(l) AS target, 'has' AS label, min(3 * l) AS link_id FROM li GROUP BY ssd_id, l_returnflag")
def distinct_links(spark, d):
    """Of an order's links to items of one return flag, taken as one node, the first."""
    _, links = _graph(spark, d)
    flags = _graph(spark, d)[0].filter("type = 'ClassNode'").select("ssd_id", F.col("node_id").alias("target"), F.col("label").alias("flag"))
    same = F.min("target").over(Window.partitionBy("ssd_id", "flag"))
    one = links.filter("label = 'has'").join(flags, ["ssd_id", "target"]).withColumn("target", same).select(*links.columns)
    return graphs.distinct_links(one).select("ssd_id", "source", "target", "label", "link_id")


@query("SELECT c.ds AS dataset_id, w.name, CASE WHEN c.name IS NULL THEN 'missing' ELSE 'ok' END AS status, c.name || '@' || c.ds AS column_id FROM (SELECT 'orders' AS dataset_id, 'o_' || event_type AS name FROM (SELECT DISTINCT event_type FROM events) UNION SELECT 'orders', 'o_custkey') w LEFT JOIN (SELECT 'orders' AS ds, 'o_custkey' AS name) c ON c.name = w.name".replace("c.ds AS dataset_id", "w.dataset_id"))
def column_lookup(spark, d):
    names = tables.column_names({"orders": table(spark, d, "orders")})
    wanted = table(spark, d, "events").select(F.lit("orders").alias("dataset_id"), F.concat(F.lit("o_"), "event_type").alias("name")).distinct()
    return tables.column_lookup(names, wanted.union(spark.createDataFrame([("orders", "o_custkey")], wanted.schema)))


@query("SELECT count(*) AS n_rows, count(c_acctbal) AS n_balance, CAST(sum(c_custkey) AS BIGINT) AS keys, count(DISTINCT c_name) AS names FROM customer")
def csv_round_trip(spark, d):
    """Customers written as CSV and read as a dataset whose key is a number and whose balance is a text."""
    path = shared_path(spark)
    table(spark, d, "customer").write.option("header", True).csv(path)
    df = tables.read_csv(spark, path, {"c_custkey": "long"})
    return df.agg(F.count("*").alias("n_rows"), F.count("c_acctbal").alias("n_balance"), F.sum("c_custkey").alias("keys"), F.count_distinct("c_name").alias("names"))


@query("WITH c AS (SELECT n_nationkey AS row_id, unnest(['n_nationkey', 'n_name', 'n_regionkey']) AS name, unnest([CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)]) AS value FROM nation) SELECT row_id, name || '@nation' AS column_id, value FROM c")
def cells_of_rows(spark, d):
    """Cells of nations with the row that they come from."""
    return tables.cells(table(spark, d, "nation"), "nation", F.col("n_nationkey")).select("row_id", "column_id", "value")


@query(f"WITH {CELLS}, c AS (SELECT ds, name, count(*) AS size FROM cells GROUP BY ALL) SELECT ds AS dataset_id, max(size) AS n_rows, count(*) AS n_cols, ds || '.csv' AS name, 'rows of ' || ds AS description FROM c GROUP BY 1")
def described_datasets(spark, d):
    catalog = tables.column_catalog({t: table(spark, d, t) for t in PROFILED})
    meta = catalog.select("dataset_id").distinct().select("dataset_id", F.concat("dataset_id", F.lit(".csv")).alias("name"), F.concat(F.lit("rows of "), "dataset_id").alias("description"))
    return tables.dataset_summary(catalog, meta)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k, CAST(json_extract(props, '$.none') AS BIGINT) AS props_none FROM events")
def flatten_maps(spark, d):
    e = table(spark, d, "events").select("event_id", F.from_json("props", "map<string, long>").alias("props"))
    return e.select(*tables.flattened(e, keys={"props": ["k", "none"]}))
