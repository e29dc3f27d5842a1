"""Operator 12: hard-negative mining by a secondary-sort shuffle of pair scores."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, shared_dir, written
from .topk import BLOCK_BYTES, LEAST, MOST, best, blocks_of, quantised, scored, vector_bounds

#: Anchors of a block at most.
BLOCK_ANCHORS = 8192
PAIR = "anchor_id long, j int, score long, vec_id long"
KEY = struct.Struct(">QQBQ")
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def packed(anchor: int, score: int, kind: int, vec_id: int) -> bytes:
    """A key whose bytes sort by anchor, falling score, kind, id."""
    return KEY.pack(anchor + (1 << 63), MOST - score, kind, vec_id + (1 << 63))


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, vec_id = KEY.unpack(key)
    return anchor - (1 << 63), MOST - score, kind, vec_id - (1 << 63)


class _Lists:
    """The best `need` pairs so far of each list, by falling score and rising id; a list is an anchor and a number j."""

    def __init__(self, need: int):
        self.need, self.rows = need, np.zeros((0, 4), np.int64)

    def add(self, anchor: np.ndarray, j: int, score: np.ndarray, vec_id: np.ndarray) -> None:
        x = np.concatenate([self.rows, np.stack([anchor, np.full(len(anchor), j), score, vec_id], axis=1)])
        x = x[np.lexsort((x[:, 3], ~x[:, 2], x[:, 1], x[:, 0]))]
        new = np.append(True, (x[1:, :2] != x[:-1, :2]).any(axis=1)) if len(x) else np.zeros(0, bool)
        nth = np.arange(len(x)) - np.maximum.accumulate(np.where(new, np.arange(len(x)), 0)) if len(x) else np.zeros(0, int)
        self.rows = x[nth < self.need]

    def batch(self, ids: np.ndarray) -> pa.RecordBatch:
        a, j, s, v = self.rows.T
        return pa.record_batch({"anchor_id": pa.array(ids[a], pa.int64()), "j": pa.array(j, pa.int32()), "score": pa.array(s, pa.int64()), "vec_id": pa.array(v, pa.int64())})


def _positives(held, width: int, kind: str, most: int):
    """Of a task's rows, the best `most` of each anchor's label."""

    def f(batches):
        anchors, lists = held.value, _Lists(most)
        for at, s, ids, (labels,) in scored(batches, anchors, width, kind, "label"):
            r, c = best(s, (anchors["label"][at, None] == labels) & (anchors["vec_id"][at, None] != ids), most)
            lists.add(r + at.start, 0, s[r, c], ids[c])
        yield lists.batch(anchors["vec_id"])

    return f


def _negatives(held, width: int, kind: str, most: int):
    """Of a task's rows, the best `most` of another label in each positive's window; no task passes more on."""

    def f(batches):
        anchors, lists = held.value, _Lists(most)
        low, high = anchors["low"], anchors["high"]  # an empty window where an anchor has no such positive
        for at, s, ids, (labels,) in scored(batches, anchors, width, kind, "label"):
            other = (anchors["label"][at, None] != labels) & (anchors["vec_id"][at, None] != ids)
            for j in range(low.shape[1]):
                r, c = best(s, other & (s >= low[at, j, None]) & (s <= high[at, j, None]), most)
                lists.add(r + at.start, j, s[r, c], ids[c])
        yield lists.batch(anchors["vec_id"])

    return f


def _opened(low: int, high: int, most: int):
    """A partition's sorted records: a positive opens a window, negatives that fall into it are passed on, a new anchor shuts all."""

    def f(records):
        anchor, windows = None, {}
        for key, j in records:
            a, score, kind, vec_id = unpacked(key)
            if a != anchor:
                anchor, windows = a, {}
            if kind == 0:
                windows[j] = [vec_id, score, 0]
            elif (w := windows.get(j)) and w[2] < most and low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield a, w[0], w[2], vec_id, w[1], score

    return f


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: each anchor's positives with negatives near them.

    rows(vec_id long, label, v array<long>); anchors says which rows are anchors. An anchor's positives are the first
    `positives` other rows of its label, by falling inner product, then id; a positive's negatives the first `negatives`
    rows of another label with low % to high % of its score.

    Blocks of anchors, bounded in bytes, are broadcast to the tasks that hold the rows: one pass finds each anchor's
    positives, one the negatives in their windows. Every row is scored; of each list a task passes on its best alone,
    which is enough. The pairs then go by keys of (anchor, falling score, positives first, id) through
    repartitionAndSortWithinPartitions; an iterator over the sorted pairs opens a window at each positive and passes its
    negatives on as they come, so that nothing holds an anchor's pairs. The two passes over rows are repeated for each
    block of anchors.

    Rows with a null id, label or vector, or with null or non-finite components, take no part; shorter vectors count as
    padded with 0. Of anchor rows that repeat an id one counts (the smallest label, then vector); as candidates rows that
    repeat an id count each. A positive without negatives gives no row; empty tables give none. Other columns are ignored.
    Scores are exact at any size; one that is used and exceeds a long is an error.
    """
    spark, base = rows.sparkSession, f"{shared_dir(rows.sparkSession)}/pairs"
    n, width, bound, kind = vector_bounds(rows)
    rows = written(rows.repartition(max(1, min(2 * partitions(spark), math.ceil(n / 1024)))), "rows")
    asked = rows.filter(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.label", "x.v")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    schema = "anchor_id long, j int, score long, vec_id long, kind int"
    spark.createDataFrame([], schema).write.parquet(base)
    for t, block in blocks_of(asked, width, BLOCK_BYTES, BLOCK_ANCHORS):
        block["label"] = t.column("label").to_numpy()
        held = spark.sparkContext.broadcast(block)
        found = rows.mapInArrow(_positives(held, width, kind, positives), PAIR)
        found = found.withColumn("j", F.row_number().over(first) - 1).filter(F.col("j") < positives)
        found = written(found.select("anchor_id", F.col("j").cast("int").alias("j"), "score", "vec_id", F.lit(0).alias("kind")), "positives")
        found.write.mode("append").parquet(base)
        p = found.toArrow()  # at most `positives` a row of the block
        at, j, s = np.searchsorted(block["vec_id"], p.column("anchor_id").to_numpy()), p.column("j").to_numpy(), p.column("score").to_numpy()
        if kind == "wide" and np.isin(s, (LEAST, MOST)).any():
            raise OverflowError("a score is too large for a long")
        window = {"low": np.full((len(t), positives), MOST), "high": np.full((len(t), positives), LEAST)}
        window["low"][at, j] = [min(MOST, -(-low * x // 100)) for x in s.tolist()]
        window["high"][at, j] = [max(LEAST, high * x // 100) for x in s.tolist()]
        held.unpersist()
        held = spark.sparkContext.broadcast(block | window)
        rows.mapInArrow(_negatives(held, width, kind, negatives), PAIR).withColumn("kind", F.lit(1)).write.mode("append").parquet(base)
        held.unpersist()
    pairs = spark.read.schema(schema).parquet(base)
    keyed = pairs.rdd.map(lambda r: (packed(r[0], r[2], r[4], r[3]), r[1]))
    parts = keyed.repartitionAndSortWithinPartitions(partitions(spark), lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(parts.mapPartitions(_opened(low, high, negatives)), OUT)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter("label IS NOT NULL")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(quantised(rows, 256, label=label.cast("long")), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS a, c.vec_id AS id, q.label = c.label AS same, CAST(list_sum([x[1] * x[2] FOR x IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
p AS (SELECT a, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= 5)
SELECT p.a AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.id ORDER BY s.score DESC, s.id) <= 10
"""
