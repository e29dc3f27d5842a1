"""Merkle manifest, hard negatives and quality rules against plain versions and on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from colsense.llm import merkle, negatives, quality_rules, topk

DOCS = "doc_id long, source string, lang string, n_chars long, text string, key string, k int, pos int, proof string"


def documents(n: int) -> list[tuple]:
    rng = random.Random(n)
    rows = [(i, "hot" if i % 3 else rng.choice([None, "", "-", "=", "é", "z", "Z"]), rng.choice([None, "en"]), rng.choice([None, i]), rng.choice([None, "", f"Text {i}"])) for i in range(n)]
    return rows + rows[:2] + [(None, "hot", None, None, "x"), (None, None, "", 0, ""), (3, "lone", None, 5, "y" * 300_000)]


@pytest.mark.parametrize("n", [0, 40, 800])
def test_merkle(spark, n):
    rows = documents(n)
    df = spark.createDataFrame([(*r, "k", 1, 2, "p") for r in rows], DOCS).repartition(5)
    found = [tuple(r) for r in merkle.manifest(df).select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), merkle.folded(F.col("leaf"), F.col("proof"))).collect()]
    want = brute.merkle(rows)
    assert len(found) == len(rows) and {f[:2] for f in found} == set(want)
    # of equal leaves each has a proof of its own, which lead to one root
    once = [k for k in want if sum(f[:2] == k for f in found) == 1]
    assert {f[:2]: f[2:5] for f in found if f[:2] in once} == {k: want[k] for k in once}
    assert all(f[3] == f[5] for f in found) and len({f[3] for f in found}) == 1


def test_merkle_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], DOCS)
    assert merkle.manifest(none).count() == 0
    one = merkle.manifest(none.union(spark.createDataFrame([(1, None, None, None, None, None, None, None, None)], DOCS))).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof"] == []


def test_merkle_tells_tampered_rows(spark):
    df = spark.createDataFrame([(i, "s", None, None, "Aé" if i % 2 else "aé") for i in range(40)], "doc_id long, source string, lang string, n_chars long, text string")
    new = merkle.leaf(*[merkle.lowered(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS])
    rows = merkle.manifest(df, carry={"new": new})
    ok = {r["doc_id"]: r["ok"] for r in rows.select("doc_id", (merkle.folded(F.col("new"), F.col("proof")) == F.col("root")).alias("ok")).collect()}
    assert ok == {i: i % 2 == 0 for i in range(40)}


def vectors(n: int, size: int, ties: bool) -> list[tuple]:
    rng = random.Random(n)
    one = lambda: [rng.randint(0, 1) if ties else rng.randint(-size, size) for _ in range(6)]
    hot = one()
    return [(i, rng.randint(0, 2), hot if i % 3 == 0 else one()) for i in range(n)]


@pytest.mark.parametrize(("size", "ties"), [(9, False), (9, True), (1 << 28, False), (1 << 30, False)])
def test_negatives(spark, monkeypatch, size, ties):
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(topk, "TILE", 3)
    rows = vectors(1500, size, ties)
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>")
    found = [tuple(r) for r in negatives.mine(df, F.col("vec_id") % 100 == 0).collect()]
    want = brute.negatives(rows, 100)
    assert len(found) == len(want) and set(found) == want


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [10.0]), (2, 2, [5.0, 0.0]), (2, 2, [5.0, 0.0]), (3, None, [9.0]), (4, 2, None), (5, 2, [nan]), (6, 2, [None]), (8, 2, [inf]), (None, 2, [5.0]), (9, 2, [9.5]), (10, 2, [3.0]), (11, 2, [])]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").withColumn("j", F.lit("x"))
    q = topk.quantised(df.filter("label IS NOT NULL"), 1, label=F.col("label"))
    found = [tuple(r) for r in negatives.mine(q, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert found == [(0, 1, 1, 9, 10, 9), (0, 1, 2, 2, 10, 5), (0, 1, 3, 2, 10, 5), (0, 1, 4, 10, 10, 3)]
    assert negatives.mine(q.filter("vec_id < 0"), F.col("vec_id") == 0).count() == 0
    assert negatives.mine(q, F.col("vec_id") == 77).count() == 0


def test_keys_sort_like_their_parts():
    rng = random.Random(1)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1, 1]
    parts = [(rng.choice(ends), rng.choice(ends), rng.randint(0, 1), rng.choice(ends)) for _ in range(300)]
    assert [negatives.unpacked(k) for k in sorted(negatives.packed(*p) for p in parts)] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))


def texts() -> list[str | None]:
    rng = random.Random(2)
    word = lambda: rng.choice(["one", "two", "é", "\U0001f600", "a#b", "$$"])
    out = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(60)]
    prose = " ".join(f"word{i} goes on" for i in range(15)) + "."
    return out + [
        None, "", " \n\t", "one", prose, f"{prose}\n{prose}", f"Home | About | Contact\n{prose}\nAll rights reserved.", "a b c d e f g h " * 50, "a b c d e f g h",
        "a b c d e f g h a b c d e f g h", "x\n" * 30, "w " * 200_000, "\n".join(f"line {i} ends here." for i in range(5_000)), "z" * 300_000]


def test_quality_rules_base(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id long, text string, of string, w int")
    found = quality_rules.judged(df).collect()
    want = {i: brute.base_quality(t) for i, t in rows}
    assert {r["doc_id"]: tuple(r)[1:6] for r in found} == want
    assert {r["doc_id"]: r["base_failed"] for r in found} == {i: w[0] < 20 or 100 * w[4] > 30 * w[0] for i, w in want.items()}
    assert {r["doc_id"] for r in quality_rules.cleaned(df).select("doc_id").collect()} == {r["doc_id"] for r in found if r["kept"]}
    assert quality_rules.judged(df.filter("doc_id < 0")).count() == 0


def test_quality_rules_of_lines(spark):
    prose = [f"Line{i} of{i} words{i} that{i} say{i} some{i} thing{i} here{i}." for i in range(6)]
    bad = ["Home | News | About | Contact", "log in register", "Copyright (c) 2020 by us. All rights reserved.", "this one goes on and on without any end", "so*** many### marks$$$ in*** here&&& now%%%", prose[0]]
    rows = [(0, "\n".join(prose + bad)), (1, "\n".join(prose[:2] + bad * 3)), (None, "\n".join(prose)), (3, " ".join(prose))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_clean", F.lit(1))
    clean = {r["doc_id"]: r["text"] for r in quality_rules.cleaned(df).collect()}
    assert clean == {0: "\n".join(prose), None: "\n".join(prose), 3: " ".join(prose)}
    of = {r["doc_id"]: r for r in quality_rules.judged(df).collect()}
    assert (of[0]["n_lines"], of[0]["punctuation_lines"], of[0]["navigation_lines"], of[0]["boilerplate_lines"], of[0]["n_dup_lines"]) == (12, 3, 2, 1, 1)
    assert not of[1]["kept"] and of[3]["kept"]
