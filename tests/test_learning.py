"""Forests, class features, chosen features, connecting trees, hierarchies and removal on small rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from colsense.operators import candidates, forest, graphs, ontology, profile, ranks, sampling, trees
from colsense.sources import tables


def test_forest_of_folds(spark):
    rng = random.Random(4)
    rows = [(f"i{i}", i % 3, "ab"[i % 2], float(i % 2) + rng.random() / 4, rng.random(), None if i % 5 else 1.0) for i in range(60)] + [("u", 1, None, 1.1, 0.5, None)]
    df = spark.createDataFrame(rows, "item string, fold int, label string, x double, y double, z double")
    out = {r["item"]: r for r in forest.predicted(forest.scores(df, df, ["x", "y", "z"], trees=9, depth=3), df).collect()}
    assert all(out[f"i{i}"]["predicted"] == "ab"[i % 2] for i in range(60)) and out["u"]["actual"] == "unknown" and out["u"]["predicted"] == "b"


def test_forest_tests_a_fold_by_the_others_alone(spark):
    """Labels of a fold don't reach its own trees; a fold without other rows is unknown."""
    rows = [(f"i{i}", i % 2, "ab"[i % 2], float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "item string, fold int, label string, x double")
    out = forest.predicted(forest.scores(df, df, ["x"], trees=3), df)
    assert out.filter("actual = predicted").count() == 0 and out.count() == 20
    one = df.filter("fold = 0")
    assert {(r["predicted"], r["confidence"]) for r in forest.predicted(forest.scores(one, one, ["x"], trees=2), one).collect()} == {("unknown", 0.0)}
    assert forest.predicted(forest.scores(df.limit(0), df, ["x"], trees=2), df).filter("predicted <> 'unknown'").count() == 0


def test_split_is_the_purest(spark):
    rng = random.Random(8)
    rows = [(0, 0, 0, rng.choice("abc"), rng.randint(1, 3), [rng.randint(0, 5) for _ in range(3)]) for _ in range(80)]
    df = spark.createDataFrame(rows, "fold int, tree int, node long, label string, w int, bins array<int>")
    allowed = spark.createDataFrame([(0, f) for f in range(3)], "tree int, feature int")
    found = tuple(forest.splits(df, allowed).first())[3:]

    def score(f, b):
        parts = [[r for r in rows if (r[5][f] <= b) == side] for side in (True, False)]
        of = lambda p, c: sum(r[4] for r in p if r[3] == c)
        return sum(sum(of(p, c) ** 2 for c in "abc") / sum(r[4] for r in p) for p in parts) if all(parts) else 0

    assert found == min(itertools.product(range(3), range(6)), key=lambda x: (-round(score(*x), 9), x))


def test_resample_within_groups(spark):
    rows = [(g, label, f"{g}{label}{i}") for g, label, n in (("g", "a", 5), ("g", "b", 1), ("h", "a", 2), ("h", "b", 8)) for i in range(n)]
    out = sampling.resample_within(spark.createDataFrame(rows, "g string, label string, k string"), "g", "label", "k", "resample_to_mean").groupBy("g", "label").count().collect()
    assert {tuple(r) for r in out} == {("g", "a", 3), ("g", "b", 3), ("h", "a", 5), ("h", "b", 5)}


def test_chosen_features_prune_the_plan(spark):
    counts = profile.value_counts(tables.cells(spark.createDataFrame([("a-b", 1), ("c", 2)], "x string, y int"), "d"))
    few = profile.selected(counts, ["prop_missing_vals"], ["inferred_data_type"])
    assert few.columns == ["column_id", "prop_missing_vals", "is_integer", "is_float", "is_boolean", "is_date", "is_string"]
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and "log2" not in plan.lower()
    assert "Generate" in profile.selected(counts, ["shannon_entropy"])._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError, match="no such features: nothing"):
        profile.selected(counts, ["nothing"])


def least_cost(terminals: set, edges: dict) -> float:
    """The least cost of edges that connect the terminals, by trying every set of further nodes."""
    names = {x for e in edges for x in e}
    best = float("inf")
    for more in itertools.chain.from_iterable(itertools.combinations(sorted(names - terminals), n) for n in range(4)):
        at, cost, inside = {min(terminals)}, 0, terminals | set(more)
        while at != inside:
            near = [(w, b if a in at else a) for (a, b), w in edges.items() if (a in at) != (b in at) and {a, b} <= inside]
            if not near:
                break
            cost, at = cost + min(near)[0], at | {min(near)[1]}
        else:
            best = min(best, cost)
    return best


def test_connecting_trees(spark):
    rng = random.Random(5)
    names = [f"n{i}" for i in range(9)]
    links = [(a, f"l{k}", b, rng.randint(0, 6)) for k, (a, b) in enumerate(rng.sample(list(itertools.permutations(names, 2)), 22))] + [("x", "l", "y", 1), ("n0", "loop", "n0", 9)]
    models = {m: rng.sample(names, 2 + m % 4) for m in range(12)} | {12: ["n0"], 13: ["x", "n1"]}
    graph = spark.createDataFrame(links, "src string, label string, dst string, support long")
    nodes = spark.createDataFrame([(m, c) for m, cs in models.items() for c in cs], "model long, label string")
    found = {}
    for r in trees.connecting(nodes, graph).collect():
        assert (r["src"], r["label"], r["dst"], r["support"]) in links
        found.setdefault(r["model"], []).append((r["src"], r["dst"]))
    cost = {}
    for a, _, b, s in links:
        if a != b:
            e = (min(a, b), max(a, b))
            cost[e] = min(cost.get(e, 10**9), trees.UNIT // (1 + s))
    for m in range(12):
        edges = found[m]
        ends = {x for e in edges for x in e}
        assert set(models[m]) <= ends and len(edges) == len(ends) - 1  # all classes, and a tree
        assert sum(cost[min(e), max(e)] for e in edges) <= 2 * least_cost(set(models[m]), cost)
    assert 12 not in found and 13 not in found


def test_recommended_models(spark):
    scores = spark.createDataFrame([(1, 0, "a", 0.9), (1, 0, "b", 0.1), (1, 1, "c", 0.8), (1, 1, "a", 0.2)], "dataset long, position int, label string, score double")
    training = spark.createDataFrame([(7, "a", "r", "m"), (7, "m", "s", "c"), (8, "a", "r", "m")], "ssd_id long, src string, label string, dst string")
    models, links = candidates.recommended(scores, training, types=2, branch=4, most=2, size_weight=0.0)
    first = models.orderBy("rank").first()
    assert first["labels"] == ["a", "c"] and first["n_nodes"] == 3 and first["coverage"] == 1.0 and first["node_coherence"] == 1.0
    assert {tuple(r)[1:4] for r in links.filter("model = '1#1'").collect()} == {("a", "r", "m"), ("m", "s", "c")}
    with pytest.raises(ValueError, match="size_weight must be in"):
        candidates.recommended(scores, training, size_weight=2.0)
    with pytest.raises(ValueError, match="branch must be above 0"):
        candidates.recommended(scores, training, branch=0)


def test_chain_of_ninety_levels(spark, monkeypatch):
    names = spark.createDataFrame([(f"c{i}",) for i in range(91)], "class string")
    parent = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(90)], "class string, parent string")
    rounds, kept = [], ontology.written
    monkeypatch.setattr(ontology, "written", lambda df: rounds.append(1) or kept(df))
    out = ontology.chain(names, parent)
    assert out.count() == 91 * 92 // 2 and out.filter("class = 'c0'").agg(F.max("depth")).first()[0] == 90
    assert len(rounds) <= 2 * 8
    with pytest.raises(ValueError, match="own ancestor"):
        ontology.chain(names, parent.union(spark.createDataFrame([("c90", "c0")], parent.schema)))
    new = spark.createDataFrame([("n1",), ("n2",)], "class string")
    more = spark.createDataFrame([("n1", "c88"), ("n2", "n1")], "class string, parent string")
    assert {tuple(r)[1:] for r in ontology.extended_chain(out, new, more).filter("class = 'n2'").collect()} == {("n2", 0), ("n1", 1), ("c88", 2), ("c89", 3), ("c90", 4)}


def test_removal_by_frontiers(spark):
    """The same as by removing and looking again, on random graphs."""
    rng = random.Random(9)
    nodes = [(g, i, rng.choice(["ClassNode", "DataNode", "Column"]), "n", "") for g in range(6) for i in range(12)]
    links = [(g, k, rng.randrange(12), rng.randrange(12), "l", rng.choice(["ColumnLink", "ObjectPropertyLink"]), "") for g in range(6) for k in range(14)]
    gone = {(g, rng.randrange(12)) for g in range(6)}
    dn = spark.createDataFrame(nodes, "ssd_id long, node_id long, type string, label string, prefix string")
    dl = spark.createDataFrame(links, "ssd_id long, link_id long, source long, target long, label string, type string, prefix string")
    left, kept = graphs.remove_nodes(dn, dl, spark.createDataFrame(sorted(gone), "ssd_id long, node_id long"))
    kind = {(n[0], n[1]): n[2] for n in nodes}
    go, alive, live = gone | {(g, a) for g, _, a, b, _, t, _ in links if t == "ColumnLink" and (g, b) in gone}, set(kind), list(links)
    while go:
        near = {(g, b) for g, _, a, b, *_ in live if (g, a) in go} | {(g, a) for g, _, a, b, *_ in live if (g, b) in go}
        alive -= go
        live = [x for x in live if (x[0], x[2]) in alive and (x[0], x[3]) in alive]
        go = {n for n in near & alive if kind[n] != "Column" and not any((x[0], x[2]) == n for x in live)}
    assert {(r["ssd_id"], r["node_id"]) for r in left.collect()} == alive and {tuple(r) for r in kept.collect()} == set(live)


def test_places_by_histograms(spark, monkeypatch):
    """Exact places of numbers of any spread, also where the passes end early."""
    rng = random.Random(3)
    rows = [("a", float(rng.randint(0, 50)), rng.randint(1, 4)) for _ in range(200)] + [("b", 10.0**rng.randint(-300, 300) * rng.choice([-1, 1]), 1) for _ in range(300)] + [("c", 7.0, 5), ("d", -1.7e308, 1), ("d", 1.7e308, 1)]
    df = spark.createDataFrame(rows, "g string, x double, n long").groupBy("g", "x").agg(F.sum("n").alias("n"))
    order = {g: sorted(x for h, x, n in rows if h == g for _ in range(n)) for g in "abcd"}
    wanted = [(g, at) for g, xs in order.items() for at in {1, len(xs) // 2 + 1, len(xs)}]
    for passes in (6, 2):
        monkeypatch.setattr(ranks, "PASSES", passes)
        found = {(r["g"], r["at"]): r["found"] for r in ranks.by_histogram(df, "g", "x", "n", spark.createDataFrame(wanted, "g string, at long")).collect()}
        assert found == {(g, at): order[g][at - 1] for g, at in wanted}


def test_cells_of_unlike_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text('x,"y\nz",x\n1,"a\nb",\n2\n')
    (tmp_path / "sub" / "b.csv").write_text('k\n"say ""hi"", you"\n')
    (tmp_path / "c.csv").write_text(",".join(f"c{i}" for i in range(40)) + "\n" + "\n".join(",".join(["v"] * 40) for _ in range(3)) + "\n")
    (tmp_path / "d.csv").write_text('"' + "\n,".join(["l"] * 30) + '",' + ",\n".join(f'"m{i}"' for i in range(1)) + "\n1,2\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("no,csv\n")
    found = [(r["path"].rsplit("/", 1)[-1], r["row"], r["col_index"], r["name"], r["value"]) for r in tables.read_cells(spark, str(tmp_path)).collect()]
    a = {f[1:] for f in found if f[0] == "a.csv"}
    assert a == {(0, 0, "x", "1"), (0, 1, "y\nz", "a\nb"), (0, 2, "x", None), (1, 0, "x", "2"), (1, 1, "y\nz", None), (1, 2, "x", None)}
    assert [f[1:] for f in found if f[0] == "b.csv"] == [(0, 0, "k", 'say "hi", you')]
    assert len([f for f in found if f[0] == "c.csv"]) == 120 and {f[4] for f in found if f[0] == "d.csv"} == {"1", "2"}
    assert {f[0] for f in found} == {"a.csv", "b.csv", "c.csv", "d.csv"}


def test_cells_of_files_need_no_sort(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    df = tables.read_cells(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sorted(df.select("row", "name", "value").collect()) == [(0, "x", "1"), (0, "y", "2"), (1, "x", "3"), (1, "y", "4")]
    assert "Sort" not in plan and "transform(" not in plan


def test_models_meet_without_the_driver(spark):
    scores = spark.createDataFrame([("d", 0, "A", 0.9), ("d", 1, "B", 0.8), ("e", 0, "A", 0.7)], "dataset string, position int, label string, score double")
    training = spark.createDataFrame([(1, "A", "p", "B")], "ssd_id int, src string, label string, dst string")
    models, _ = candidates.recommended(scores, training, types=1, branch=2, most=1)
    plan = models._jdf.queryExecution().executedPlan().toString()
    assert {(r["dataset"], r["n_nodes"], r["n_mapped"], r["n_columns"]) for r in models.collect()} == {("d", 2, 2, 2), ("e", 1, 1, 1)}
    assert "BroadcastHashJoin [model" not in plan and "BroadcastHashJoin [dataset" not in plan and "ExistingRDD" not in plan
