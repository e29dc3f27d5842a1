"""Statements, ontologies, descriptions and labels on small rows."""


from colsense.operators import graphs, labels, ontology
from colsense.sources import statements


def test_lines_that_are_no_statements(spark):
    rows = spark.createDataFrame([('<a:x> <a:p> "v"@en .',), ("_:b <a:p> <a:o> .",), ("",), ("# note",), ("<a:x> <a:p>",)], "value string")
    assert {tuple(r) for r in statements.parsed(rows).collect()} == {("a:x", "a:p", '"v"@en', "literal"), ("_:b", "a:p", "a:o", "uri")}
    assert [r["value"] for r in statements.broken(rows).collect()] == ["<a:x> <a:p>"]


def test_chain_and_cycle(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "class string")
    parent = spark.createDataFrame([("a", "b"), ("b", "c")], "class string, parent string")
    assert {tuple(r) for r in ontology.ordered(ontology.chain(names, parent)).collect()} == {("a", 2), ("b", 1), ("c", 0)}
    assert ontology.chain(names.limit(0), parent).count() == 0


def test_removal_follows_what_is_left_without_links(spark):
    nodes = spark.createDataFrame([(1, 0, "ClassNode", "A", ""), (1, 1, "DataNode", "x", ""), (1, 2, "Column", "c", "")], "ssd_id long, node_id long, type string, label string, prefix string")
    links = spark.createDataFrame([(1, 0, 0, 1, "x", "DataPropertyLink", ""), (1, 1, 1, 2, "connect", "ColumnLink", "")], "ssd_id long, link_id long, source long, target long, label string, type string, prefix string")
    left, kept = graphs.remove_nodes(nodes, links, nodes.filter("node_id = 2").select("ssd_id", "node_id"))
    assert left.count() == 0 and kept.count() == 0
    t = graphs.triples(nodes, links, include_columns=True)
    assert {tuple(r)[1:] for r in t.collect()} == {("A", "x", "x", 0), ("x", "ColumnLink", "c", 0)}
    assert tuple(graphs.compare(t, t).first())[1:] == (1.0, 1.0, 1.0)


def test_labels(spark):
    cols = spark.createDataFrame([("a@d", "a", "d"), ("b@d", "b", "d")], "column_id string, name string, dataset_id string")
    old = spark.createDataFrame([("a@d", "x"), ("b@d", "y")], "column_id string, label string")
    new = spark.createDataFrame([("b@d", "z")], "column_id string, label string")
    assert {tuple(r) for r in labels.upsert(old, new).collect()} == {("a@d", "x"), ("b@d", "z")}
    assert labels.violations(new, cols, old.select("label")).first()["why"] == "no such class"
    assert labels.listing(old, cols).count() == 2
    assert {r["actual"] for r in labels.with_truth(old, new).collect()} == {"unknown", "z"}
