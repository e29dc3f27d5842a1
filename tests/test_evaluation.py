"""Folds, bound descriptions, comparison flags, references and ranks against plain versions."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from colsense.operators import building, evaluation, graphs, profile, ranks, sampling
from colsense.sources import descriptions, tables


def test_centroid_folds(spark):
    rng = random.Random(1)
    rows = [(i, i % 4, rng.choice(["a", "b", None]), rng.random(), rng.random()) for i in range(60)] + [(99, 7, "c", 9.0, 9.0)]
    df = spark.createDataFrame(rows, "column_id int, fold int, label string, x double, y double")
    found = {r["column_id"]: (r["actual"], r["predicted"]) for r in evaluation.centroid_folds(df, ["x", "y"]).collect()}
    for i, fold, label, x, y in rows:
        by = defaultdict(list)
        for _, f, k, u, v in rows:
            if f != fold and k is not None:
                by[k].append((u, v))
        away = {k: (x - sum(u for u, _ in p) / len(p)) ** 2 + (y - sum(v for _, v in p) / len(p)) ** 2 for k, p in by.items()}
        assert found[i] == (label or "unknown", min(away, key=away.get))


def test_columns_of_folds_stay_dealt(spark):
    """A column's cells are those of its fold, nulls too, and no task gets all values of a column."""
    rows = [("a", str(i % 300)) for i in range(900)] + [("b", x) for x in (None, None, "", "x")] + [("c", "x"), ("no fold", "x")]
    cells = spark.createDataFrame(rows, "column_id string, value string").repartition(3)
    folds = sampling.kfold(spark.createDataFrame([("a",), ("b",), ("c",), ("empty",)], "column_id string"), 2, "column_id")
    of = {"a": 0, "b": 0, "c": 1}
    assert sorted(map(tuple, evaluation.fold_columns(cells, folds).collect()), key=str) == sorted([(of[c], c, v) for c, v in rows if c in of], key=str)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        for counted in (
            evaluation.fold_columns(cells, folds).groupBy("fold", "column", "value").agg(F.count("*").alias("cnt")),
            evaluation.fold_columns(profile.value_counts(cells), folds),
        ):
            at = counted.select("*", F.spark_partition_id().alias("at")).collect()
            assert {(r["fold"], r["column"], r["value"]): r["cnt"] for r in at} == {**{(0, "a", str(i)): 3 for i in range(300)}, (0, "b", None): 2, (0, "b", ""): 1, (0, "b", "x"): 1, (1, "c", "x"): 1}
            sizes = Counter(r["at"] for r in at if r["column"] == "a")
            assert len(sizes) == 4 and max(sizes.values()) < 150
    finally:
        spark.conf.unset(conf)


def test_predictions_views(spark):
    long = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "b", 2)], "item int, label string, score int")
    wide = evaluation.wide_scores(long, "item", ["a", "b"]).withColumn("dataset_id", F.lit("d")).withColumn("feature", F.lit(1))
    assert wide.columns == ["item", "scores_a", "scores_b", "dataset_id", "feature"]
    assert sorted(map(tuple, evaluation.long_scores(wide, "item").collect())) == [(1, "a", 3), (1, "b", 1), (2, "a", 0), (2, "b", 2)]
    assert evaluation.projected(wide, ["item"]).columns == ["item"]
    assert evaluation.projected(wide, ["item"], True, ["feature"], "d").columns == ["item", "scores_a", "scores_b", "feature"]
    assert evaluation.projected(wide, ["item"], dataset="e").count() == 0


def test_references_with_nulls(spark):
    rng = random.Random(3)
    value = lambda: rng.choice([None, "p", "q", "r"])
    items = [(i, value(), value(), value()) for i in range(25)]
    refs = [(i, value(), value(), value()) for i in range(80)]
    schema = "{} int, a string, b string, c string"
    for some in (items, items[:1], []):
        r, i = spark.createDataFrame(refs, schema.format("ref_id")), spark.createDataFrame(some, schema.format("item_id"))
        for exact in (False, True):
            found = {x["ref_id"]: (x["item_id"], x["status"]) for x in building.resolve(r, i, ["a", "b", "c"], exact=exact).collect()}
            for ref in refs:
                left, want = some, None
                for k in (1, 2, 3):
                    left = [x for x in left if ref[k] is None or x[k] is None or x[k] == ref[k]]
                    if len(left) <= 1:
                        hit = [x for x in left if not exact or x[1:] == ref[1:]]
                        want = (hit[0][0], "ok") if hit else (None, "none")
                        break
                assert found[ref[0]] == (want or (None, "ambiguous")), (ref, some)


def test_ranks(spark):
    rng = random.Random(4)
    rows = [(g, rng.randint(0, 50), rng.randint(1, 4)) for g in "abc" for _ in range(200)]
    by = defaultdict(int)
    for g, x, n in rows:
        by[g, x] += n
    flat = {g: [x for (h, x), n in sorted(by.items()) if h == g for _ in range(n)] for g in "abc"}
    wanted = [(g, at) for g in "abc" for at in (1, 2, len(flat[g]) // 2, len(flat[g]))]
    df = spark.createDataFrame([(g, x, n) for (g, x), n in by.items()], "g string, x int, cnt int").repartition(5)
    found = {(r["g"], r["at"]): r["x"] for r in ranks.in_order(df, ["g"], ["x"], "cnt", spark.createDataFrame(wanted, "g string, at int")).collect()}
    assert found == {(g, at): flat[g][at - 1] for g, at in wanted}
    many = spark.range(5000).select("id", (F.col("id") % 3).cast("string").alias("g"))
    goals = spark.createDataFrame([("0", 0), ("1", 700), ("2", 1666)], "g string, goal long")
    first = ranks.among_first(many, "g", F.md5(F.col("id").cast("string")), goals).filter("first")
    assert {r["g"]: r["count"] for r in first.groupBy("g").count().collect()} == {"1": 700, "2": 1666}
    keyed = many.withColumn("k", F.md5(F.col("id").cast("string")))
    assert first.join(keyed, ["id", "g"]).filter("g = '1'").agg(F.max("k")).first()[0] <= keyed.filter("g = '1'").orderBy("k").limit(700).agg(F.max("k")).first()[0]


def test_bind_and_rebuild(spark, tmp_path):
    text = """{"name": "a", "attributes": [{"id": 10, "name": "c"}, {"id": 11, "name": "gone"}], "semanticModel": {"nodes": [
     {"id": 0, "label": "City", "type": "ClassNode"}, {"id": 1, "label": "City.name", "type": "DataNode"}, {"id": 2, "label": "City.size", "type": "DataNode"}], "links": [
     {"id": 0, "source": 0, "target": 1, "label": "called", "type": "DataPropertyLink", "prefix": "p"}, {"id": 1, "source": 0, "target": 2, "label": "size", "type": "DataPropertyLink"},
     {"id": 2, "source": 0, "target": 0, "label": "x", "type": "DataProperty"}]}, "mappings": [{"attribute": 10, "node": 1}, {"attribute": 11, "node": 2}]}"""
    d = descriptions.parsed(spark.createDataFrame([("s", text), ("none", text)], "ssd_id string, value string"))
    nodes, links, skipped = descriptions.rebuilt(d)
    assert {(r["node_id"], r["label"]) for r in nodes.filter("ssd_id = 's'").collect()} == {(0, "City"), (1, "called"), (2, "size"), (10, "c"), (11, "gone")}
    assert {(r["source"], r["target"], r["type"]) for r in links.filter("ssd_id = 's' AND type = 'ColumnLink'").collect()} == {(1, 10, "ColumnLink"), (2, 11, "ColumnLink")}
    assert [r["type"] for r in skipped.filter("ssd_id = 's'").collect()] == ["DataProperty"]
    columns = spark.createDataFrame([("s", "c", "c@d")], "ssd_id string, name string, column_id string")
    namespaces = spark.createDataFrame([("s", "ns"), ("none", "ns")], "ssd_id string, namespace string")
    model = nodes.filter("type <> 'Column'"), links.filter("type <> 'ColumnLink'")
    n, e, m, lost = graphs.bind(descriptions.attributes(d).drop("column_ids"), descriptions.mapped(d), *model, columns, namespaces)
    assert {(r["ssd_id"], r["node_id"], r["prefix"]) for r in n.collect()} == {("s", 0, "ns"), ("s", 1, "ns")}
    assert [(r["link_id"], r["prefix"]) for r in e.collect()] == [(0, "p")] and [tuple(r) for r in m.collect()] == [("s", "c@d", 1)]
    assert {(r["ssd_id"], r["name"]) for r in lost.collect()} == {("s", "gone"), ("none", "c"), ("none", "gone")}


def test_compare_with_nothing_left(spark):
    nodes = spark.createDataFrame([(1, 0, "ClassNode", "A", ""), (1, 1, "DataNode", "x", "")], "ssd_id long, node_id long, type string, label string, prefix string")
    links = spark.createDataFrame([(1, 0, 0, 1, "x", "DataPropertyLink", "")], "ssd_id long, link_id long, source long, target long, label string, type string, prefix string")
    one = lambda **k: tuple(graphs.compare_some((nodes, links), (nodes, links), **k).first())
    assert one() == (1, 1.0, 1.0, 1.0) and one(ignore_types=True, ignore_columns=True) == (1, 0.0, 0.0, 0.0)


def test_compare_each_choice(spark):
    """Equal triples match as often as both sides have them; one call gives what a call for each choice gives."""
    node, link = "ssd_id long, node_id long, type string, label string, prefix string", "ssd_id long, link_id long, source long, target long, label string, type string, prefix string"
    nodes = spark.createDataFrame([(1, 0, "ClassNode", "A", None), (1, 1, "ClassNode", "B", "p"), (1, 2, "DataNode", "x", ""), (1, 3, "Column", "c", None), (2, 0, "ClassNode", "A", None)], node)
    rows = [(1, 0, 0, 1, "r", "ObjectPropertyLink", ""), (1, 1, 0, 1, "r", "ObjectPropertyLink", ""), (1, 2, 1, 2, "x", "DataPropertyLink", ""), (1, 3, 2, 3, "m", "ColumnLink", None), (1, 4, 0, 1, "other", "connect", "")]
    truth, result = spark.createDataFrame(rows, link), spark.createDataFrame([rows[0], rows[2]], link)
    choices = [(False, False), (True, False), (False, True), (True, True)]
    found = {tuple(r)[:3]: tuple(r)[3:] for r in graphs.compare_each((nodes, result), (nodes, truth), choices).collect()}
    assert found[1, False, False] == (1.0, 0.5, 0.5) and found[1, True, False] == (1.0, 0.333333, 0.333333)
    assert found[1, False, True] == (1.0, 0.666667, 0.666667) and found[1, True, True] == (1.0, 0.5, 0.5)
    assert all(found[2, t, c] == (0.0, 0.0, 0.0) for t, c in choices) and len(found) == 8


def test_directory(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text('z\n"one\ntwo"\n')
    (tmp_path / "labels.csv").write_text("dataset,column,label\na.csv,x,k\n")
    datasets, labels = tables.read_directory(spark, str(tmp_path), "labels.csv")
    assert {k: v.columns for k, v in datasets.items()} == {"a.csv": ["x", "y"], "b.csv": ["z"]} and datasets["b.csv"].count() == 1
    assert [tuple(r) for r in labels.collect()] == [("a.csv", "x", "k")]
