"""Operator 1: exact top-k search by distributed histogram selection."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, shared_dir, written

#: Bytes of queries' vectors that are broadcast at a time, and queries that they are at most; queries scored at a time.
BLOCK_BYTES, BLOCK_QUERIES, TILE = 16 << 20, 8192, 256
#: Bins of a histogram are 2**STEP at most.
STEP = 7
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, scale: int = 64, **more: Column) -> DataFrame:
    """(vec_id, v array<long>, ..): floor(scale * x) of each component; rows that may not take part are dropped.

    A component that no long holds once it is scaled is an error.
    """
    x = F.col("embedding")
    ok = F.col("vec_id").isNotNull() & x.isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf")))
    )
    large = F.exists(x, lambda c: F.abs(c.cast("double") * scale) >= F.lit(2.0**63))
    v = F.when(large, F.raise_error(F.lit("a component is too large for a long"))).otherwise(F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")))
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<long>").alias("v"), *[c.alias(k) for k, c in more.items()])


def padded(v: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; short ones are padded with 0."""
    size = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(v), width), np.int64)
    out[np.repeat(np.arange(len(v)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = v.flatten().to_numpy()
    return out


def vector_bounds(*tables: DataFrame) -> tuple[int, int, int, str]:
    """(rows of the first table, width of vectors, a bound of all inner products, the kind of numbers that hold these exactly)."""
    long_ = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    found = [t.agg(F.count("*"), F.max(F.size("v")), F.max(long_)).first() for t in tables]
    bound = int((found[0][2] or 0.0) * (found[-1][2] or 0.0) * (1 + 1e-9)) + 1
    return found[0][0], max(1, *(f[1] or 0 for f in found)), bound, "float" if bound < 2**52 else "long" if bound < 2**62 else "wide"


def scored(batches, block: dict, width: int, kind: str, *more: str):
    """Of each batch: (slice of the block's queries, their scores by rows, ids of the rows, further columns), in the order of ids."""
    number = {"float": np.float64, "long": np.int64, "wide": object}[kind]
    for batch in batches:
        ids = batch.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        v = np.ascontiguousarray(padded(batch.column("v"), width)[order].T.astype(number))
        for lo in range(0, len(block["vec_id"]), TILE):
            at = slice(lo, lo + TILE)
            s = block["v"][at].astype(number) @ v
            if kind == "wide":  # exact integers of any size: what a long can't hold is marked by its ends
                s = np.minimum(np.maximum(s, LEAST), MOST)
            yield at, s.astype(np.int64), ids[order], [batch.column(c).to_numpy()[order] for c in more]


def best(scores: np.ndarray, take: np.ndarray, need: int | np.ndarray, kth: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's `need` greatest scores among take, ties to the first columns; kth: the last score that counts, if known."""
    n = scores.shape[1]
    if kth is None:
        kth = np.partition(np.where(take, scores, LEAST), n - need, axis=1)[:, n - need] if n > need else np.full(len(scores), LEAST)
    over = take & (scores > kth[:, None])
    r, c = np.nonzero(over | take & (scores == kth[:, None]))
    tie = ~over[r, c]
    left = need - over.sum(axis=1) if np.isscalar(need) else need
    nth = np.cumsum(tie) - 1
    before = np.concatenate([[0], np.cumsum(tie)])[np.searchsorted(r, np.arange(len(scores)))]
    keep = ~tie | (nth - before[r] < left[r])
    return r[keep], c[keep]


def blocks_of(asked: DataFrame, width: int, bytes_: int, most: int):
    """asked(vec_id, v, ..) in blocks of bounded size for the driver to broadcast, one after the other: tables in the order of ids."""
    blocks = max(1, math.ceil(asked.count() / max(1, min(most, bytes_ // (8 * width)))))
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "asked")
    for b in range(blocks):
        t = asked.filter(F.col("block") == b).orderBy("vec_id").toArrow()
        if len(t):
            yield t, {"vec_id": t.column("vec_id").to_numpy(), "v": padded(t.column("v").combine_chunks(), width)}


def _counted(held, width: int, kind: str, shift: int, bins: int):
    """Histograms of a task's rows: (place of the query in its block, bin, n)."""

    def f(batches):
        block = held.value
        low, out = block["low"], np.zeros((len(block["vec_id"]), bins), np.int64)
        for at, s, ids, _ in scored(batches, block, width, kind):
            # differences wrap around, so that scores far apart keep their bits
            x = (s.view(np.uint64) - low[at, None].view(np.uint64)) >> np.uint64(shift)
            r, c = np.nonzero((s >= low[at, None]) & (x < np.uint64(bins)) & (block["vec_id"][at, None] != ids))
            out[at] += np.bincount(r * bins + x[r, c].astype(np.int64), minlength=len(s) * bins).reshape(-1, bins)
        q, b = np.nonzero(out)
        yield pa.record_batch({"q": pa.array(q, pa.int32()), "bin": pa.array(b, pa.int32()), "n": pa.array(out[q, b], pa.int64())})

    return f


def _chosen(held, width: int, kind: str):
    """Of a batch, the rows above each query's last score and, of those equal to it, the smallest ids that may be needed."""

    def f(batches):
        block = held.value
        for at, s, ids, _ in scored(batches, block, width, kind):
            r, c = best(s, block["vec_id"][at, None] != ids, block["need"][at], block["low"][at])
            if kind == "wide" and np.isin(s[r, c], (LEAST, MOST)).any():
                raise OverflowError("a score is too large for a long")
            yield pa.record_batch({"query_id": pa.array(block["vec_id"][at][r], pa.int64()), "vec_id": pa.array(ids[c], pa.int64()), "score": pa.array(s[r, c], pa.int64())})

    return f


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64) -> DataFrame:
    """The k highest integer inner products of each query row with every row of another id, ties to smaller vec_id.

    Blocks of queries, bounded in bytes, are broadcast one after the other to the tasks that hold the rows, which never
    move. Each pass scores a block against all rows, counts scores by bin of each query's current range, sums the counts
    over all tasks and keeps the bin that holds the k-th score; when a bin is one score wide, the k-th score is known. A
    last pass returns what lies above it and, of the scores equal to it, the smallest ids. No list of scores is kept or moved.

    vectors, queries: columns vec_id, embedding (others are ignored). Rows whose id or vector is null, or that hold null
    or non-finite components, take no part. Each row of vectors is a candidate, also if it repeats an id; of query rows that
    repeat an id one counts (the smallest vector); shorter vectors count as padded with 0. Fewer than k candidates: all are
    returned. Empty inputs give an empty result. Scores are exact: by doubles or longs where a bound from the vectors'
    lengths shows that these hold them, else by integers of any size. A score that is returned and exceeds a long is an
    error. Returns query_id long, rank int, vec_id long, score long.
    """
    spark, base = vectors.sparkSession, f"{shared_dir(vectors.sparkSession)}/found"
    rows, asked = quantised(vectors, scale), quantised(queries, scale)
    n, width, bound, kind = vector_bounds(rows, asked)
    rows = written(rows.repartition(max(1, min(2 * partitions(spark), math.ceil(n / 1024)))), "rows")
    bits = min(64, (2 * bound + 2).bit_length())
    step = math.ceil(bits / math.ceil(bits / STEP))
    schema = "query_id long, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(base)
    for _, block in blocks_of(asked.groupBy("vec_id").agg(F.min("v").alias("v")), width, BLOCK_BYTES, BLOCK_QUERIES):
        low, need = np.full(len(block["vec_id"]), -(1 << (bits - 1)), np.int64), np.full(len(block["vec_id"]), k, np.int64)
        shift = bits
        while shift > 0:
            wide, shift = shift, max(0, shift - step)  # the bin in question is 2**wide scores wide
            held = spark.sparkContext.broadcast(block | {"low": low})
            counts = rows.mapInArrow(_counted(held, width, kind, shift, 1 << (wide - shift)), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
            down = Window.partitionBy("q").orderBy(F.desc("bin"))
            above = counts.withColumn("above", F.sum("n").over(down) - F.col("n")).filter(F.col("above") < k)
            found = above.groupBy("q").agg(F.collect_list(F.struct("bin", "above")).alias("x")).toArrow()  # at most k bins a query of the block
            for q, x in zip(found.column("q").to_pylist(), found.column("x").to_pylist()):
                # the bin that reaches `need`; with fewer scores than that, the lowest bin that has any
                at = min((e for e in x if e["above"] < need[q]), key=lambda e: e["bin"])
                low[q], need[q] = int(low[q]) + (at["bin"] << shift), need[q] - at["above"]
            held.unpersist()
        held = spark.sparkContext.broadcast(block | {"low": low, "need": need})
        rows.mapInArrow(_chosen(held, width, kind), schema).write.mode("append").parquet(base)
        held.unpersist()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(schema).parquet(base)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(rows, rows.filter(F.col("vec_id") % 20 == 0))


SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
