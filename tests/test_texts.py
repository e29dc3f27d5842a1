"""Value counts by digests against those of whole values."""

import hashlib
import random

import pytest

from colsense.operators import profile

PASSES = (profile.basic, profile.chars, profile.inferred_types, profile.text_length, profile.numeric, profile.value_entropy)


def rows(n=400, seed=5):
    """Short and long values, repeated ones, odd ones, and a short value that is a long one's digest."""
    rng = random.Random(seed)
    long_ = ["word " * k + str(k) for k in (60, 61, 4000)] + [" " * 300, "7" * 300, "a@b-" * 100, "é\U0001f986" * 90]
    short = ["", " ", "1", "-2.50", "1e3", "true", "2020-01-02", "10 - 20", "x@y.z", "a" * 256, None, hashlib.sha256(long_[0].encode()).hexdigest()]
    mixed = [(rng.choice("ab"), rng.choice(long_ + short)) for _ in range(n)]
    return mixed + [("nulls", None), ("digits", "7" * 300), ("digits", "12"), ("long", long_[2])] + [("a", None)] * 3


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame(rows(), "column_id string, value string")


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("f", PASSES)
def test_features_of_digests(cells, f):
    assert same(f(profile.digested_counts(cells)), f(profile.value_counts(cells)))


def test_digests_hold_no_long_value(cells):
    found = profile.digested_counts(cells).collect()
    assert max(len(r["value"].encode()) for r in found if r["value"] is not None) == 256
    plain = {}
    for c, v in rows():
        plain[c, v] = plain.get((c, v), 0) + 1
    keyed = {(c, hashlib.sha256(v.encode()).hexdigest() if v is not None and len(v.encode()) > 256 else v, v is not None and len(v.encode()) > 256): n for (c, v), n in plain.items()}
    assert {(r["column_id"], r["value"], r["hashed"]): r["cnt"] for r in found} == keyed


def test_merged_digests(spark, cells):
    parts = [spark.createDataFrame(rows()[i::3], "column_id string, value string") for i in range(3)]
    merged = profile.merged(*map(profile.digested_counts, parts))
    for f in PASSES:
        assert same(f(merged), f(profile.value_counts(cells)))


def test_characters_come_from_cells(cells):
    digests, counts = profile.digested_counts(cells), profile.value_counts(cells)
    assert same(profile.char_distribution(cells), profile.char_distribution(counts))
    names = ["num_unique_vals", "shannon_entropy"]
    assert same(profile.selected(digests, names, cells=cells), profile.selected(counts, names))
    with pytest.raises(ValueError, match="char_counts of the cells"):
        profile.char_entropy(digests)


def test_facts_that_no_feature_needs_are_pruned(cells):
    plan = profile.value_entropy(profile.digested_counts(cells))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower() and "rlike" not in plan.lower()


def test_no_cells(spark):
    none = profile.digested_counts(spark.createDataFrame([], "column_id string, value string"))
    assert all(f(none).count() == 0 for f in PASSES)
