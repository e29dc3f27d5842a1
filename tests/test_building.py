"""Descriptions as texts, bulk building, references, candidates and classifiers on small rows."""

import json
import random
from collections import Counter
from itertools import product

import pytest

from colsense.operators import building, candidates, graphs, models
from colsense.sources import descriptions

TEXT = """{"name": "a.csv", "attributes": [{"id": 0, "name": "c", "columnIds": [7]}], "ontologies": [1], "semanticModel": {"nodes": [
 {"id": 0, "label": "City", "type": "ClassNode"}, {"id": 1, "label": "City.name", "type": "DataNode"}], "links": [
 {"id": 0, "source": 0, "target": 1, "label": "name", "type": "DataPropertyLink"}]}, "mappings": [{"attribute": 0, "node": 1}]}"""


def test_texts(spark, tmp_path):
    for name, text in (("a", TEXT), ("b", '{"name": "no model"}'), ("c", "no json")):
        (tmp_path / f"{name}.ssd").write_text(text)
    d = descriptions.parsed(descriptions.read_texts(spark, str(tmp_path)))
    assert d.count() == 3
    assert {tuple(r)[1:] for r in descriptions.nodes(d).collect()} == {(0, "ClassNode", "City", None, None), (1, "DataNode", "name", "City", None)}
    assert descriptions.mapped(d).first()["node_id"] == 1 and descriptions.attributes(d).first()["column_ids"] == [7]
    assert descriptions.links(d).count() == 1


def test_names(spark):
    n = lambda *x: spark.createDataFrame([(v,) for v in x], "f string")
    assert {tuple(r) for r in descriptions.unmatched(n("a", "b"), n("a"), n("a", "b", "b")).select("filename", "missing").rdd.map(lambda r: (r[0], tuple(r[1]))).collect()} == {("b", (1,))}


def test_map_checks(spark):
    maps = spark.createDataFrame([(1, "c", "A", "x"), (1, "d", "A", "y"), (1, "e", "A", "x"), (1, "f", "B", "x"), (2, "c", "A", "x")], "ssd_id long, column string, class string, label string")
    cols = spark.createDataFrame([(1, "c"), (1, "e"), (1, "f"), (2, "c")], "ssd_id long, column string")
    props = spark.createDataFrame([("A", "x"), ("A", "y")], "class string, label string")
    found = {(r["ssd_id"], r["column"]): r["why"] for r in building.checked_map(maps, cols, props).collect()}
    assert found == {(1, "c"): "data node used twice", (1, "d"): "no such column", (1, "e"): "data node used twice", (1, "f"): "no such property", (2, "c"): None}
    links = spark.createDataFrame([(1, "A", "p", "B"), (1, "A", "q", "B")], "ssd_id long, src string, label string, dst string")
    assert [r["why"] for r in building.checked_links(links, links.filter("label = 'p'")).orderBy("label").collect()] == [None, "no such link"]


def test_built_and_removed(spark):
    maps = spark.createDataFrame([(1, "c", "A", "x")], "ssd_id long, column string, class string, label string")
    links = spark.createDataFrame([(1, "A", "p", "B")], "ssd_id long, src string, label string, dst string")
    nodes, edges = building.built(maps, links)
    assert [tuple(r)[1:4] for r in nodes.orderBy("node_id").collect()] == [(0, "ClassNode", "A"), (1, "ClassNode", "B"), (2, "DataNode", "x"), (3, "Column", "c")]
    assert {(r["source"], r["target"], r["type"]) for r in edges.collect()} == {(0, 1, "ObjectPropertyLink"), (0, 2, "DataPropertyLink"), (2, 3, "ColumnLink")}
    wanted = spark.createDataFrame([(1, "p", None, 1), (1, "p", 1, None)], "ssd_id long, label string, source long, target long")
    left, kept, status = building.remove_links(nodes, edges, wanted)
    assert {r["label"] for r in left.collect()} == {"A", "x", "c"} and kept.count() == 2
    assert sorted(r["status"] for r in status.collect()) == ["missing", "ok"]


def test_references(spark):
    items = spark.createDataFrame([(1, "a", 0), (2, "a", 1), (3, "b", None), (4, "c", 1), (5, "c", 1)], "item_id long, label string, idx int")
    refs = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, "b", 9), (4, "z", None), (5, "c", 1), (6, "a", 7)], "ref_id long, label string, idx int")
    found = {r["ref_id"]: (r["item_id"], r["status"]) for r in building.resolve(refs, items, ["label", "idx"]).collect()}
    assert found == {1: (2, "ok"), 2: (None, "ambiguous"), 3: (3, "ok"), 4: (None, "none"), 5: (None, "ambiguous"), 6: (None, "none")}
    exact = {r["ref_id"]: r["status"] for r in building.resolve(refs, items, ["label", "idx"], exact=True).collect()}
    assert exact[1] == "ok" and exact[3] == "none"


def test_combinations(spark):
    scores = {0: {"a": 0.5, "b": 0.25}, 1: {"c": 0.5, "d": 0.75}, 2: {"e": 1.0, "f": 0.5}}
    rows = [("d", p, l, s) for p, x in scores.items() for l, s in x.items()]
    found = candidates.candidate_mappings(spark.createDataFrame(rows, "dataset string, position int, label string, score double"), 8, 3).orderBy("rank").collect()
    want = sorted(((-scores[0][x] * scores[1][y] * scores[2][z], [x, y, z]) for x, y, z in product("ab", "cd", "ef")))[:3]
    assert [(-r["score"], r["labels"]) for r in found] == want


def test_forest(spark):
    rows = spark.createDataFrame([(i, i % 3, "abc"[i % 3], float(i % 3), None) for i in range(60)], "id int, fold int, label string, x double, y double")
    out = models.predict(models.train(rows, ["x", "y"], trees=5), rows, ["x", "y"])
    assert out.filter("label = predicted").count() == 60
    assert all(abs(sum(r["scores"].values()) - 1) < 1e-9 for r in out.collect())


def test_binding(spark):
    attributes = spark.createDataFrame([(1, 0, "c"), (1, 1, "gone")], "ssd_id long, attr_id long, name string")
    mapped = spark.createDataFrame([(1, 0, 5), (1, 1, 6)], "ssd_id long, attr_id long, node_id long")
    columns = spark.createDataFrame([(1, "c", "c@d")], "ssd_id long, name string, column_id string")
    found, lost = graphs.bound(attributes, mapped, columns)
    assert [tuple(r) for r in found.collect()] == [(1, "c@d", 5)] and [tuple(r) for r in lost.collect()] == [(1, 6)]


def test_beam_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    from colsense.plans.building import candidate_mappings

    found = []
    for quantities in ((7.0, 3.0), (3.0, 7.0)):  # two items that differ by their quantity alone
        rows = [(1, 1, 5, "A", "F", q) for q in quantities]
        at = tmp_path / str(len(found))
        spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string, l_quantity double").coalesce(1).write.parquet(f"{at}/lineitem.parquet")
        found.append([tuple(r) for r in candidate_mappings(spark, str(at)).orderBy("rank").collect()])
    assert found[0] == found[1] == [(1, "bF,bF", 132.0, 1), (1, "bF,aA", 77.0, 2), (1, "aA,bF", 36.0, 3)]


def test_texts_are_made_where_items_are_numbered(spark):
    """Items are dealt by description once; neither texts nor alignment graphs are dealt again by nodes."""
    from colsense.plans import building as plans, evaluation

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (evaluation.description_heads(spark, "/root/testdata/sf0.001"), plans.alignment_nodes(spark, "/root/testdata/sf0.001")):
            dealt = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
            assert dealt and all(x.split("hashpartitioning(")[1].startswith("ssd_id") and "node_id" not in x and ", id#" not in x for x in dealt)
            assert not any("at#" in x for x in dealt)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_of_parts(spark):
    """Of several owners the first label counts; links without a node, or null ends, give none; a description without links has no list of them."""
    nodes = spark.createDataFrame(
        [(1, 0, "ClassNode", "B", None), (1, 1, "ClassNode", "A", None), (1, 2, "DataNode", "x", None), (1, 3, "DataNode", "y", None), (2, 0, "DataNode", "z", None), (3, 0, "Column", "c", None)],
        "ssd_id long, node_id long, type string, label string, prefix string")
    links = spark.createDataFrame(
        [(1, 0, 0, 2, "p", "DataPropertyLink", None), (1, 1, 1, 2, "p", "DataPropertyLink", None), (1, 2, 9, 3, "p", "DataPropertyLink", None), (1, 3, None, 3, "p", "DataPropertyLink", None)],
        "ssd_id long, link_id long, source long, target long, label string, type string, prefix string")
    names = spark.createDataFrame([(i, f"d{i}") for i in (1, 2, 3, 4)], "ssd_id long, name string")
    x = descriptions.parsed(descriptions.texts(names, nodes, links))
    assert sorted((r["ssd_id"], r["node_id"], r["class_label"], r["label"]) for r in descriptions.nodes(x).filter("type = 'DataNode'").collect()) == [(1, 2, "A", "x"), (1, 3, None, "y"), (2, 0, None, "z")]
    assert {r["ssd_id"]: (r["a"], r["l"]) for r in x.selectExpr("ssd_id", "size(d.attributes) a", "size(d.semanticModel.links) l").collect()} == {1: (0, 4), 2: (0, None), 3: (1, None), 4: (None, None)}


def test_built_deals_rows_once_and_keeps_what_joins_kept(spark):
    maps = [(1, "c", "A", "x"), (1, "d", "A", "x"), (1, "d", "A", "x"), (1, "e", "B", "x"), (1, None, "B", "y"), (1, "f", None, "y"), (2, "c", "Z", None), (2, "g", "C", "z")]
    links = [(1, "A", "p", "B"), (1, "A", "p", "B"), (1, "B", "q", "D"), (1, None, "q", "D"), (1, "D", None, "D"), (2, "C", "p", "C")]
    m = spark.createDataFrame(maps, "ssd_id long, column string, class string, label string")
    o = spark.createDataFrame(links, "ssd_id long, src string, label string, dst string")
    nodes, edges = building.built(m, o)
    low = lambda x: (x is not None, x or "")  # noqa: E731 - nulls come first
    want, wires = set(), []
    for s in (1, 2):
        mine, ties = [x[1:] for x in maps if x[0] == s], {x[1:] for x in links if x[0] == s}
        names = {x[1] for x in mine} | {x[i] for x in ties for i in (0, 2)}
        keys = [(0, None, x) for x in names] + [(1, *x[1:]) for x in {(0, a, b) for _, a, b in mine}] + [(2, None, x) for x in {x[0] for x in mine}]
        at = {key: i for i, key in enumerate(sorted(keys, key=lambda x: (x[0], low(x[1]), low(x[2]))))}
        want |= {(s, i, ("ClassNode", "DataNode", "Column")[k], name) for (k, _, name), i in at.items()}
        whole = [x for x in mine if None not in x]
        wires += [(s, at[0, None, a], at[0, None, b], p, "ObjectPropertyLink") for a, p, b in ties if a and b]
        wires += [(s, at[0, None, a], at[1, a, b], b, "DataPropertyLink") for a, b in {x[1:] for x in whole}]
        wires += [(s, at[1, a, b], at[2, None, c], "connect", "ColumnLink") for c, a, b in whole]
    assert {tuple(r) for r in nodes.drop("prefix").collect()} == want and nodes.count() == len(want)
    got = edges.orderBy("ssd_id", "link_id").collect()
    full = lambda rows: sorted(tuple((x is not None, x) if isinstance(x, (str, type(None))) else x for x in r) for r in rows)
    assert full((r["ssd_id"], r["source"], r["target"], r["label"], r["type"]) for r in got) == full(wires)
    assert [r["link_id"] for r in got if r["ssd_id"] == 1] == list(range(sum(w[0] == 1 for w in wires)))
    for df in (nodes, edges):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 4


def test_links_are_removed_without_broadcasts(spark, tmp_path):
    """Links, nodes and what is asked meet where items are numbered: nothing goes through the driver, items are dealt once."""
    from colsense.plans import building as plans

    rows = [(o, n, 10 * o + n, "ANR"[n % 3], "OF"[n % 2]) for o in range(1, 40) for n in range(1, o % 4 + 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    sizes = {o: o % 4 + 1 for o in range(1, 40)}
    want = {(o, 0) for o, n in sizes.items() if n > 1} | {(o, k + i) for o, n in sizes.items() for i in range(1, n + 1) for k in (0, 100000, 200000)}
    df = plans.remove_links_nodes(spark, str(tmp_path))
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(want) and set(found) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "hashpartitioning(" in plan
    assert all(x.split("hashpartitioning(")[1].startswith("ssd_id") and x.split("hashpartitioning(")[1].count("#") == 1 for x in plan.split("\n") if "hashpartitioning(" in x and x.lstrip(" :+-*").startswith("Exchange"))


def test_removed_links_of_odd_rows(spark):
    """Null ends, on either side, equal links and nodes, null names, links of one id, loops."""
    rng = random.Random(4)
    some = lambda *x: rng.choice(x)
    links = [(some(1, 1, 2, 3, None), some(0, 1, 2, 3, 4, 5, 6, None), some(0, 1, 2, 3, None), some(0, 1, 2, 3, 4, None), some("p", "p", "q", None)) for _ in range(60)]
    links += [(s, i, i % 4, some(i, 6, None), f"r{i}") for s in range(4, 12) for i in range(6)]
    wanted = [(some(1, 2, 3, None), some("p", "q", "z", None), some(0, 1, 2, 3, None), some(0, 1, 2, 3, None)) for _ in range(60)]
    wanted += [(s, f"r{i}", some(i % 4, None), some(i, 6, None)) for s in range(4, 12) for i in range(1, 7, 2)]
    nodes = [(some(1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, None), some(0, 1, 2, 3, 4, 5, 6, 7, 8, None), some("ClassNode", "DataNode", "Column", None), "x") for _ in range(150)]
    e = spark.createDataFrame(links, "ssd_id long, link_id long, source long, target long, label string")
    n = spark.createDataFrame(nodes, "ssd_id long, node_id long, type string, label string")
    w = spark.createDataFrame(wanted, "ssd_id long, label string, source long, target long")
    fits = lambda x, y: x is None or y is None or x == y
    low = lambda x: tuple((v is not None, v or 0) for v in x)  # noqa: E731 - nulls come first
    status, hits = {}, []
    for ask in set(wanted):
        s, label, a, b = ask
        met = [(i, x, y) for z, i, x, y, name in links if None not in (s, label) and (z, name) == (s, label) and fits(a, x) and fits(b, y)]
        status[ask] = "missing" if not met else "ambiguous" if len(met) > 1 else "ok"
        hits += [(s, *min(met, key=low))] if len(met) == 1 else []
    gone = {(s, i) for s, i, _, _ in hits if i is not None}
    left = [x for x in links if x[:2] not in gone]
    still = {(x[0], at) for x in left for at in x[2:4]}
    lonely = {(s, at) for s, _, a, b in hits for at in (a, b) if at is not None} - still
    lonely &= {x[:2] for x in nodes if x[2] not in ("Column", None)}
    assert lonely and any(x[:2] in gone for x in links) and set(status.values()) == {"ok", "missing", "ambiguous"}
    out = building.remove_links(n, e, w)
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    assert rows(out[0]) == Counter(x for x in nodes if x[:2] not in lonely)
    assert rows(out[1]) == Counter(left)
    assert rows(out[2]) == Counter((*ask, s) for ask, s in status.items())


def test_rebuilt_reads_texts_once(spark, tmp_path):
    from colsense.plans import evaluation

    rows = [(o, n, 10 * o + n, "ANR"[n % 3], "OF"[n % 2]) for o in range(1, 40) for n in range(1, o % 4 + 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = evaluation.rebuilt_nodes(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan and plan.count("Exchange ") == 1
    want = {(o, 0, "ClassNode", "order") for o, *_ in rows} | {(o, k + n, t, x) for o, n, p, f, s in rows for k, t, x in ((0, "ClassNode", f), (100000, "DataNode", s), (200000, "Column", str(p)))}
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(want) and set(found) == want


def test_rebuilt_of_odd_descriptions(spark):
    """The first of several links names a data node; those that are of other types, or lead nowhere, don't; null ids and labels stay."""
    node = lambda i, label, type_: {"id": i, "label": label, "type": type_, "prefix": "p"}
    link = lambda i, to, label, type_="DataPropertyLink": {"id": i, "source": 0, "target": to, "label": label, "type": type_, "prefix": "q"}
    nodes = [node(0, "A.b", "ClassNode"), node(None, "B", "ClassNode"), node(0, "A.b", "ClassNode"), node(1, "A.x", "DataNode"), node(2, "y", "DataNode"), node(3, "z", "DataNode"), node(4, "u", "DataNode"), node(None, "v", "DataNode"), node(5, "w", "Other"), node(6, "m", "DataNode"), node(7, None, None)]
    links = [link(5, 1, "later"), link(4, 1, "first", "ClassInstanceLink"), link(1, 1, "other", "ObjectPropertyLink"), link(6, 3, None), link(7, 4, "odd", "Odd"), link(8, None, "nowhere"), link(9, 5, "other"), link(None, 6, "unnumbered"), link(10, 7, "none")]
    texts = [(1, {"name": "a", "semanticModel": {"nodes": nodes, "links": links}, "attributes": [{"id": 1, "name": "c"}, {"id": None, "name": None}]}), (2, {"name": "b", "attributes": [{"id": 0, "name": "d"}]}), (3, {"name": "c"}), (4, {"semanticModel": {"nodes": nodes[:5]}}), (None, {"semanticModel": {"nodes": nodes, "links": links}})]
    d = descriptions.parsed(spark.createDataFrame([(i, json.dumps(x)) for i, x in texts] + [(5, "no json")], "ssd_id long, value string"))
    got = Counter(tuple(r) for r in descriptions.rebuilt(d)[0].collect())
    classes = [(0, "ClassNode", "A.b", "p"), (None, "ClassNode", "B", "p"), (0, "ClassNode", "A.b", "p")]
    data = [(1, "DataNode", "first", "p"), (3, "DataNode", None, "p"), (6, "DataNode", None, "p")]
    want = Counter((1, *x) for x in [*classes, *data, (1, "Column", "c", None), (None, "Column", None, None)])
    assert got == want + Counter([(2, 0, "Column", "d", None)]) + Counter((4, *x) for x in classes) + Counter((None, *x) for x in classes)


def plain_parts(nodes, links, training_nodes, training_links, support):
    """model_parts in plain Python."""
    costs, out = {tuple(x[:3]): x[3] for x in support}, {}
    for m in {x[0] for x in nodes} - {None}:
        scores = [s for model, _, s in nodes if model == m and s is not None]
        mine, ties = {(x[1],) for x in nodes if x[0] == m}, {tuple(x[1:]) for x in links if x[0] == m}
        best = lambda own, theirs: max([len({o for o in own if None not in o} & {tuple(x[1:]) for x in theirs if x[0] == s}) for s in {x[0] for x in theirs}], default=0) / len(own) if own else 0.0  # noqa: E731, B023
        out[m] = (sum(scores) / len(scores), best(mine, training_nodes), best(ties, training_links), sum(1 / (1 + (costs.get(t) or 0)) for t in ties))
    return out


@pytest.mark.parametrize("near", [100_000, 0])
def test_parts_of_models_stay_where_models_are(spark, monkeypatch, near):
    monkeypatch.setattr(candidates, "NEAR", near, raising=False)
    rng = random.Random(8)
    pick = lambda x: rng.choice([*x, None])
    models = [None, *(f"m{i}" for i in range(30))]
    nodes = [(rng.choice(models), pick("abcdef"), rng.random()) for _ in range(200)] + [("m1", "a", None), ("m99", "zz", 0.5)]
    links = [(rng.choice(models[:25]), pick("abc"), pick("pq"), pick("abc")) for _ in range(200)]
    ends = [(s, pick("abcdef")) for s in (1, 2, 3, None) for _ in range(5)]
    ties = [(s, pick("abc"), pick("pq"), pick("abc")) for s in (1, 2, 3, None) for _ in range(6)]
    support = [("a", "p", "b", 3), ("b", "p", "c", 0), ("c", "q", "a", 7)]
    link = "src string, label string, dst string"
    n = spark.createDataFrame(nodes, "model string, label string, score double").repartition(4, "model")
    e = spark.createDataFrame(links, f"model string, {link}").repartition(4, "model")
    df = candidates.model_parts(n, e, spark.createDataFrame(ends, "ssd_id int, label string"), spark.createDataFrame(ties, f"ssd_id int, {link}"), spark.createDataFrame(support, f"{link}, support long"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    got = {r[0]: tuple(round(x, 9) for x in r[1:]) for r in df.collect()}
    want = plain_parts(nodes, links, ends, ties, support)
    assert got == {m: tuple(round(x, 9) for x in v) for m, v in want.items()} and df.count() == len(want)
    if near:  # rows of models are dealt once, by this test
        assert all("REPARTITION_BY_NUM" in x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
