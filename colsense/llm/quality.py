"""Operator 9: a quality classifier, hashed word n-gram logistic regression trained by follow-the-regularised-leader."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BYTE, SPACE, given_back, mix, pieces, span_keys, text_or_empty, word_hashes, words
from .language import held_out

#: Weights, the bound of the labelled sample, trainers whose weights are averaged, and passes of each.
BITS, ROWS, SHARDS, EPOCHS = 18, 20_000, 4, 4
#: Byte classes that a word's shape is made of: lower, upper, digit, other ASCII, beyond ASCII.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 4


def _features(array: pa.Array):
    """Of each text: (indices of its hashed word n-grams, their values; the values' squares sum to 1).

    n-grams are words and word pairs; words are also hashed by their shape (runs of byte classes) and their last bytes,
    and a pair of equal words has an index of its own, so that junk of unseen words is met too. A value is the share of
    the text's words of that kind, square-rooted.
    """
    mask = np.uint64((1 << BITS) - 1)
    for _, _, buf, starts in pieces(array):
        w, at = word_hashes(buf, starts, lower=False)
        first, end = words(buf, starts)
        kind = _CLASS[buf]
        new = np.ones(len(buf), bool)
        new[1:] = kind[1:] != kind[:-1]
        new[first] = True
        runs = np.cumsum(new & ~SPACE[buf])
        shape = span_keys(kind[new & ~SPACE[buf]], runs[first] - 1, runs[end - 1]) if len(w) else w
        tail = mix(_BYTE[buf[end - 1]] * np.uint64(3) + np.where(end - first > 1, _BYTE[buf[np.maximum(end - 2, 0)]], 0)) if len(w) else w
        same = np.zeros(len(w), np.uint64)
        same[1:] = (w[1:] == w[:-1]) + np.uint64(1)
        pair, shapes = w.copy(), shape.copy()
        pair[1:] = mix(w[1:] * np.uint64(31) + w[:-1])
        shapes[1:] = mix(shape[1:] * np.uint64(37) + shape[:-1])
        kinds = [w, pair ^ np.uint64(0xABCDEF), shape ^ np.uint64(0x1234567), shapes ^ np.uint64(0x7654321), tail ^ np.uint64(0x55AA55AA), mix(same + np.uint64(99))]
        index = np.stack([mix(k + np.uint64(i)) & mask for i, k in enumerate(kinds)]).astype(np.int64)
        for i in range(len(at) - 1):
            lo, hi = at[i], at[i + 1]
            if hi == lo:
                yield np.zeros(0, np.int64), np.zeros(0)
                continue
            ids, n = np.unique(index[:, lo:hi], return_counts=True)
            yield ids, np.sqrt(n / (len(kinds) * (hi - lo)))


def ftrl(rows, epochs: int = EPOCHS, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-proximal over (indices, values, label) rows, in order, `epochs` times."""
    z, n, zb, nb = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0
    weights = lambda z, n: np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    for _ in range(epochs):
        for ids, x, y in rows:
            w = weights(z[ids], n[ids])
            bias = -zb / ((beta + nb**0.5) / alpha + l2)
            g = 1 / (1 + np.exp(-np.clip(bias + w @ x, -35, 35))) - y
            gx = g * x
            more = n[ids] + gx * gx
            z[ids] += gx - (np.sqrt(more) - np.sqrt(n[ids])) / alpha * w
            n[ids] = more
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / alpha * bias
            nb += g * g
    return weights(z, n), -zb / ((beta + nb**0.5) / alpha + l2)


def _trained(batches):
    rows = []
    for batch in batches:
        rows += [(i.astype(np.int32), x.astype(np.float32), y) for (i, x), y in zip(_features(batch.column("text")), batch.column("label").to_pylist())]
    if rows:
        w, b = ftrl(rows)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], b)), pa.array(np.full(len(at) + 1, len(rows), np.int64))], ["i", "w", "n"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, label: str = "quality") -> tuple[np.ndarray, float]:
    """(weights, bias) learned from texts of docs whose doc_id has a 0/1 label.

    Labels that are null or another number don't count; of several for one document the largest does. Trained on a
    bounded sample of about `rows` labelled rows (all, if fewer), the same on each run, which are dealt to SHARDS
    trainers; their weights are averaged by rows seen. Without any labelled row all weights are 0.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    total = known.count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 40)) < int((1 << 40) * rows / total))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(known), "doc_id")
    texts = texts.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(SHARDS))).repartition(SHARDS, "shard").sortWithinPartitions(F.xxhash64("doc_id", F.lit(7)), "text")
    parts = texts.select("text", "label").mapInArrow(given_back(_trained), "i long, w double, n long")
    found = parts.groupBy("i").agg(F.sum(F.col("w") * F.col("n")).alias("w"), F.sum("n").alias("n")).toArrow()  # 2**BITS rows at most
    i, w, n = (found.column(c).to_numpy() for c in ("i", "w", "n"))
    out = np.zeros(1 << BITS)
    if not len(i):
        return out, 0.0
    seen = n[i == -1].sum()  # each trainer has a bias
    out[i[i >= 0]] = w[i >= 0] / seen
    return out, float(w[i == -1].sum() / seen)


def _scores(text: pa.Array, model: tuple[np.ndarray, float]) -> np.ndarray:
    w, bias = model
    s = np.array([bias + (w[i] @ x if len(i) else 0.0) for i, x in _features(text.cast(pa.string()).fill_null(""))], float)
    return 1 / (1 + np.exp(-np.clip(s, -35, 35)))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id and score (0 to 1) of each row, from its whole text alone; null, empty and blank texts score the bias.

    Repeated rows score alike; a null doc_id stays null; other columns are ignored; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def f(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), held.value), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(given_back(f), "doc_id long, score double")


THRESHOLD = 0.3


def of_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs, all columns of any name, without those that the classifier rejects (score under THRESHOLD). Learns as op9 does.

    Every row is judged by its text alone: null, empty and blank texts by the bias, repeated rows alike.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs.filter(~held_out(5, 0)), labels.filter(~held_out(5, 0))))

    def f(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column("text"), held.value) >= THRESHOLD))

    return docs.mapInArrow(given_back(f), docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    out = score(docs, fit(docs.filter(~held_out(5, 0)), labels.filter(~held_out(5, 0))))
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
