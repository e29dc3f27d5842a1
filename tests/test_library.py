"""Metrics, folds and column features on rows small enough to work out by hand."""

from pyspark.sql import functions as F

from colsense.functions import uris
from colsense.operators import metrics, profile, sampling
from colsense.sources import tables


def test_scores(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "b")], "actual string, predicted string")
    s = metrics.scores(metrics.confusion(rows)).first()
    assert s["precision_micro"] == s["recall_micro"] == s["fscore_micro"] == 0.5
    assert abs(s["average_accuracy"] + s["error_rate"] - 1) < 1e-9
    assert abs(s["precision_macro"] - round((1 + 1 / 3 + 0) / 3, 6)) < 1e-6


def test_precision_at_k_stops_at_the_hit(spark):
    ranks = spark.createDataFrame([(1, "x", 3.0), (1, "y", 2.0), (2, "x", 1.0), (2, "y", 5.0)], "item int, label string, score double")
    truth = spark.createDataFrame([(1, "x"), (2, "x"), (3, "z")], "item int, actual string")
    found = metrics.rank_of_truth(metrics.ranked(ranks), truth)
    assert metrics.precision_at_k(found, 2).first()["micro"] == round(2 / 3, 6)
    assert metrics.mrr(found).first()["micro"] == 0.5


def test_features_of_nulls_and_blanks(spark):
    df = spark.createDataFrame([("1",), ("2",), (" ",), (None,), ("2",)], "x string")
    counts = profile.value_counts(tables.cells(df, "d"))
    b = profile.basic(counts).first()
    assert (b["n_rows"], b["num_unique_vals"], b["prop_missing_vals"]) == (5, 2, 0.4)
    assert profile.inferred_types(counts).first()["logical_type"] == "integer"
    assert profile.numeric(counts).first()["median"] == 2.0


def test_folds_and_uris(spark):
    folds = sampling.kfold(spark.range(7).select(F.format_string("%02d", "id").alias("c")), 3, "c").groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == [3, 2, 2]
    row = spark.createDataFrame([("http://a/b#c",)], "u string").select(uris.local_name(F.col("u")), uris.namespace(F.col("u"))).first()
    assert tuple(row) == ("c", "http://a/b#")
