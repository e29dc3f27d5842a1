"""The pruned search for nearest columns against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from colsense.operators import nearest, profile
from colsense.sources import tables


def cells(spark, rows):
    return profile.value_counts(spark.createDataFrame(rows, "column_id string, value string"))


def clustered(n, seed=3):
    """Columns of ten kinds, each over an alphabet of its own that overlaps the next one's."""
    rng = random.Random(seed)
    kinds = ["".join(rng.sample(nearest.CODES, 8)) for _ in range(10)]
    return [(f"c{i:04d}", "".join(rng.choices(kinds[i % 10], range(1, 9), k=60))) for i in range(n)]


def plain(pairs, k, left_out=None, group=None):
    """{column: [others]} from all pairs."""
    out = {}
    for c, other, cosine in pairs:
        if group is None or group[other] != left_out:
            out.setdefault(c, []).append((-round(cosine, 9), other))
    return {c: [o for _, o in sorted(found)[:k]] for c, found in out.items()}


def all_pairs(counts, labelled):
    return [tuple(r) for r in profile.cosine_pairs(counts, labelled).collect()]


def chosen(rows, k=None):
    out = {}
    for r in rows.collect():
        out.setdefault(r["column_id"], []).append((-round(r["cosine"], 9), r["other"]))
    return {c: [o for _, o in sorted(found)[:k]] for c, found in out.items()}


def test_nearest_is_that_of_all_pairs(spark, monkeypatch):
    rows, seen, kept = clustered(400), [], nearest._pairs
    counts = cells(spark, rows + [("none", "é"), ("null", None), ("alone", "a")])
    labelled = counts.select("column_id").distinct().filter("column_id NOT LIKE '%7'")

    def counted(*args):
        out = kept(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(nearest, "_pairs", counted)
    found = chosen(nearest.nearest(nearest.vectors(counts), labelled, 3))
    pairs = all_pairs(counts, labelled)
    assert found == plain(pairs, 3) and "none" not in found and "null" not in found
    assert sum(seen) < len(pairs) / 3  # most blocks aren't read


def test_nearest_of_equal_columns(spark):
    """A third of the columns are equal: their smallest ids are enough, whatever the block's keys are."""
    rows = clustered(60) + [(f"e{i:03d}", "abcabcd") for i in range(40)] + [(f"f{i:03d}", "aabbccdabcabcd") for i in range(5)]
    counts = cells(spark, rows)
    labelled = counts.select("column_id").distinct()
    assert chosen(nearest.nearest(nearest.vectors(counts), labelled, 4)) == plain(all_pairs(counts, labelled), 4)


def test_nearest_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CHUNK", 3)
    monkeypatch.setattr(nearest, "PIVOTS", 2)
    monkeypatch.setattr(nearest, "ROWS", 7)
    counts = cells(spark, clustered(80, 6))
    labelled = counts.select("column_id").distinct()
    assert chosen(nearest.nearest(nearest.vectors(counts), labelled, 2)) == plain(all_pairs(counts, labelled), 2)


def test_nearest_of_few(spark):
    counts = cells(spark, [("a", "xy"), ("b", "x"), ("c", "z")])
    vectors = nearest.vectors(counts)
    labelled = counts.select("column_id").distinct()
    assert chosen(nearest.nearest(vectors, labelled, 50)) == {"a": ["b"], "b": ["a"]}
    assert nearest.nearest(vectors, labelled.limit(0), 3).count() == 0 and nearest.nearest(vectors.limit(0), labelled, 3).count() == 0
    with pytest.raises(ValueError, match="k must be above 0"):
        nearest.nearest(vectors, labelled, 0)


@pytest.mark.parametrize("hot", [False, True])
def test_nearest_whichever_group_goes(spark, hot):
    rng = random.Random(9)
    rows = clustered(150, 4) + [(f"e{i:03d}", "abcabcd") for i in range(20)]
    group = {c: "a" if hot and rng.random() < 0.7 else rng.choice("abcd") for c, _ in rows}
    counts = cells(spark, rows)
    labelled = spark.createDataFrame(list(group.items()), "column_id string, fold string")
    out = nearest.nearest(nearest.vectors(counts), labelled, 3, "fold")
    pairs = all_pairs(counts, labelled)
    for fold in "abcde":
        mine = labelled.filter(F.col("fold") != fold).select(F.col("column_id").alias("other"))
        assert chosen(out.join(mine, "other"), 3) == plain(pairs, 3, fold, group)
    assert out.groupBy("column_id").count().filter("count > 6").count() == 0


def test_class_shares_by_nearest(spark):
    counts = profile.value_counts(tables.cells(spark.createDataFrame([("ab", "ab", "12", "13")], "p string, q string, r string, s string"), "d"))
    labelled = spark.createDataFrame([("p@d", "x"), ("q@d", "x"), ("r@d", "y"), ("s@d", "y")], "column_id string, label string")
    shares = profile.knn_class_share(nearest.nearest(nearest.vectors(counts), labelled, 1), labelled, 1)
    assert {tuple(r) for r in shares.collect()} == {("p@d", "x", 1.0), ("q@d", "x", 1.0), ("r@d", "y", 1.0), ("s@d", "y", 1.0)}


def test_only_the_nearest_of_a_matrix_leave_its_task(spark, monkeypatch):
    rng, seen, kept = random.Random(5), [], nearest._pairs
    alike = [(f"c{i:03d}", "".join(rng.choices("abcdef", k=40))) for i in range(120)]  # one kind, which no bound parts
    counts = cells(spark, alike)
    labelled = counts.select("column_id").distinct()

    def counted(asked, *args):
        out = kept(asked, *args)
        seen.append((asked.count(), out.count()))
        return out

    monkeypatch.setattr(nearest, "_pairs", counted)
    monkeypatch.setattr(nearest, "ROWS", 7)
    found = chosen(nearest.nearest(nearest.vectors(counts), labelled, 2))
    assert found == plain(all_pairs(counts, labelled), 2)
    assert all(pairs <= 2 * asks for asks, pairs in seen)


def test_vectors_of_odd_values(spark, monkeypatch):
    """Characters by value counts and by cells; long values in pieces, bytes of other characters left out."""
    monkeypatch.setattr(nearest, "LONG", 3)
    rows = [("a", "xyxyxyxé~ "), ("a", "xyxyxyxé~ "), ("a", ""), ("a", None), ("b", "😀ÿ\x7f\n\x1f"), ("b", "~😀~\n~é"), ("c", None), ("d", "ü"), ("e", " a\nb\n" * 50)]
    want = {}
    for c, value in rows:
        for ch in value or "":
            if " " <= ch <= "~":
                want.setdefault(c, [0.0] * 95)[ord(ch) - 32] += 1
    want = {c: [x / sum(y * y for y in v) ** 0.5 for x in v] for c, v in want.items()}
    raw = spark.createDataFrame(rows, "column_id string, value string")
    for counts in (cells(spark, rows), raw):
        got = {r["column_id"]: r["v"] for r in nearest.vectors(counts).collect()}
        assert got.keys() == want.keys() and all(abs(x - y) < 1e-12 for c in want for x, y in zip(got[c], want[c], strict=True))


def test_cells_are_counted_where_a_suppliers_items_are(spark, tmp_path):
    from colsense.plans import columns as plans

    rows = [(i % 3 or None, i, 1.0 + i % 2, 0.05, "A", "F", "2020-01-01") for i in range(20)]
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_quantity double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string").write.parquet(f"{tmp_path}/lineitem.parquet")
    counts = plans._of_suppliers(spark, str(tmp_path))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert [x.split("hashpartitioning(")[1].split("#")[0] for x in plan.splitlines() if "Exchange" in x] == ["l_suppkey"]
    want = {}
    for s, *values in rows:
        for name, value in zip(("l_partkey", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"), values, strict=True):
            key = (f"{name}@{s}" if s else name, str(value))
            want[key] = want.get(key, 0) + 1
    assert {(r["column_id"], r["value"]): r["cnt"] for r in counts.collect()} == want and counts.count() == len(want)


def test_matrices_are_dealt_by_columns_not_bytes(spark, monkeypatch):
    seen, kept = [], nearest._pairs

    def counted(*args):
        out = kept(*args)
        seen.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(nearest, "_pairs", counted)
    monkeypatch.setattr(nearest, "SHARE", 4, raising=False)
    counts = cells(spark, clustered(80))
    labelled = counts.select("column_id").distinct()
    assert chosen(nearest.nearest(nearest.vectors(counts), labelled, 2)) == plain(all_pairs(counts, labelled), 2)
    assert seen == [20, 20]
