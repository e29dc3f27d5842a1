"""Operator 5: mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_RE, bitmap, fresh, in_map, located, text_or_empty, written

#: Rows of one source that a task balances at a time, and sources up to which the table of targets is broadcast.
BLOCK, RESERVE, MANY_SOURCES = 4096, 128, 100_000
WEIGHTS = (5, 2, 1)


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: float = 3.0) -> dict[str | None, float]:
    """Words that each source shall give: shares of the total by weight, at most `most` times what the source has."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    left, total, out = float(sum(n for _, n in order)), sum(weight.values()), {}
    for s, n in sorted(order, key=lambda x: most * x[1] / weight[x[0]]):  # those that stop first come first
        out[s] = min(most * n, left * weight[s] / total)
        left -= out[s]
        total -= weight[s]
    return out


def flight(size: np.ndarray, chance: np.ndarray, seed: int) -> np.ndarray:
    """The flight phase: chances move through the null space of (token total, document total) until at most two are fractional.

    Three fractional rows at a time leave a direction that changes neither total; a random step along it, fair in
    expectation, brings at least one of them to 0 or 1.
    """
    p, rng, eps = chance.astype(float).copy(), np.random.default_rng(seed), 1e-9
    x = size.astype(float)
    held: list[int] = []
    for i in np.flatnonzero((p > eps) & (p < 1 - eps)).tolist():
        held.append(i)
        while len(held) == 3:
            a, b, c = held
            u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
            if u == (0.0, 0.0, 0.0):  # equal sizes: any two trade
                u = (1.0, -1.0, 0.0)
            up = min(((1 - p[i]) / d if d > 0 else p[i] / -d) for i, d in zip(held, u) if d)
            down = min((p[i] / d if d > 0 else (1 - p[i]) / -d) for i, d in zip(held, u) if d)
            step = up if rng.random() * (up + down) < down else -down
            for i, d in zip(held, u):
                p[i] += step * d
                p[i] = 0.0 if p[i] < eps else 1.0 if p[i] > 1 - eps else p[i]
            held = [i for i in held if 0 < p[i] < 1]
    return p


def landing(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The few chances that are left become 0 or 1 so that the token total moves least, then the document total."""
    at = np.flatnonzero((p > 0) & (p < 1))
    if not len(at):
        return p
    off = lambda c: (abs(float(size[at] @ (np.array(c) - p[at]))), abs(float(sum(c) - p[at].sum())), c)
    p = p.copy()
    p[at] = min(itertools.product((0.0, 1.0), repeat=len(at)), key=off)
    return p


def _flown(last: bool):
    """Flight over a block; its reserve of small documents waits for the last block, where it takes up what landing moves."""

    def f(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "doc_id", "size"], kind="stable")
        size, p = pdf["size"].to_numpy(), pdf["chance"].to_numpy().astype(float)
        open_ = (p > 0) & (p < 1) & (size > 0)
        small = np.flatnonzero(open_ & (size <= np.quantile(size[open_], 0.75)))[:RESERVE] if open_.any() else np.zeros(0, int)
        large = np.setdiff1d(np.arange(len(p)), small)
        p[large] = flight(size[large], p[large], 7 + int(0 if last else key[-1]))
        if last:
            aim = float(size[large] @ p[large])
            p[large] = landing(size[large], p[large])
            for _ in range(4):  # what landing has moved, spread over the reserve
                off = aim - float(size[large] @ p[large]) + float(size[small] @ (pdf["chance"].to_numpy()[small] - p[small]))
                free = small[(p[small] > 0.02) & (p[small] < 0.98)]
                if len(free):
                    p[free] = np.clip(p[free] + off / size[free].sum(), 0.02, 0.98)
            p[small] = landing(size[small], flight(size[small], p[small], 8))
        return pdf.assign(chance=p)

    return f


def _plan(docs: DataFrame, weights, most: float) -> tuple[DataFrame, DataFrame, str, str]:
    """(docs with their places; per row: doc_id, source, size, source_size, target, copies, place, row; names of places)."""
    spark = docs.sparkSession
    docs, path, row = located(docs)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text_or_empty(), F.lit(WORD_RE)).cast("long").alias("size"),
        F.xxhash64(path).alias("place"), F.col(row).alias("row"))
    rows = written(rows, "sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).collect()
    aim = targets([(r["source"], r["source_size"]) for r in per], weights, most)
    table = spark.createDataFrame(
        [(r["source"], r["source_size"], float(aim[r["source"]]), max(1, math.ceil(r["n"] / BLOCK))) for r in per],
        "source string, source_size long, target double, blocks int")
    table = F.broadcast(table) if len(per) <= MANY_SOURCES else table
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + 1e-12)
    # rows that repeat id and size are told apart by their places, so that they don't share a block; all others by themselves
    rows = rows.withColumn("h", F.xxhash64("doc_id", "size"))
    again = rows.groupBy("h").count().filter("count > 1")
    held = spark.sparkContext.broadcast(bitmap(again, "h"))
    h = F.when(in_map("h", held), F.xxhash64("h", "place", "row")).otherwise(F.col("h"))
    same = rows["source"].eqNullSafe(table["source"])
    rows = rows.join(table, same).select(
        "doc_id", rows["source"], "size", "source_size", "target", whole.cast("int").alias("whole"),
        F.greatest(rate - whole, F.lit(0.0)).alias("chance"), h.alias("h"), "blocks", "place", "row")
    schema = rows.schema
    done, level = [], 0
    open_ = rows
    while True:
        block = F.pmod(F.xxhash64("h", F.lit(level)), F.col("blocks"))
        out = written(open_.groupBy("source", block.alias("block")).applyInPandas(_flown(False), schema), f"flight{level}")
        undecided = F.col("chance").between(1e-9, 1 - 1e-9)
        done.append(out.filter(~undecided))
        open_ = out.filter(undecided)
        if (open_.groupBy("source").count().agg(F.max("count")).first()[0] or 0) <= BLOCK:
            break
        counts = open_.groupBy(F.col("source").alias("source_")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks_"))
        open_ = open_.join(F.broadcast(counts) if len(per) <= MANY_SOURCES else counts, F.col("source").eqNullSafe(F.col("source_"))).select(
            *[c if c != "blocks" else F.col("blocks_").alias("blocks") for c in schema.names])
        level += 1
    done.append(open_.groupBy("source").applyInPandas(_flown(True), schema))
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    copies = (F.col("whole") + F.round("chance")).cast("long").alias("copies")
    return docs, out.select("doc_id", "source", "size", "source_size", "target", copies, "place", "row"), path, row


def mix(docs: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies: how many words the mix takes of each document, repeats counted.

    A source that shall give r times its size takes each document floor(r) times, and once more with the fraction as
    its chance; the cube method picks these so that each source's word and document totals hold. Sources are balanced in
    hashed blocks of bounded size; of a block at most two rows and a reserve of small documents stay undecided. These are
    balanced again until a source's rest fits one block: there the last two rows are landed, and the reserve, balanced
    last, takes up what that has moved. Reruns agree: draws depend on data alone.

    Null texts have size 0; null is a source of its own, the last. Sources without words have target 0 and their
    documents (size 0) take 0 words. One row per input row, repeated rows included, whose draws may differ; a null doc_id
    stays null; other columns are ignored; an empty table gives no rows.
    """
    plan = _plan(docs, weights, most)[1]
    return plan.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """docs after the mix: each row as often as it is taken, with all its columns, whatever their names."""
    placed, plan, path, row = _plan(docs, weights, most)
    mark, copy = fresh(placed, "_mark"), fresh(placed, "_copy")
    placed = placed.withColumn(mark, F.xxhash64(path))
    taken = plan.filter("copies > 0").select(F.col("place").alias(fresh(placed, "_place")), F.col("row").alias(fresh(placed, "_of")), F.col("copies").alias(fresh(placed, "_copies")))
    place, of, copies = taken.columns
    out = placed.join(taken, (placed[mark] == taken[place]) & (placed[row] == taken[of]))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), taken[copies]))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op5_source_mix's result that SQL can express: sizes and targets, rounded to thousandths of a word."""
    return op5_source_mix(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


#: Sources that stop at three times their size come first by size over weight; the first that doesn't stop gives the words by weight for all later ones.
SQL_TARGETS = r"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY 1),
 w AS (SELECT *, CAST(CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w FROM s),
 k AS (SELECT *, row_number() OVER (ORDER BY 3.0 * n / w, i) AS k, sum(n) OVER () AS t FROM w),
 l AS (SELECT *, 3.0 * n / w AS stop, (t - 3.0 * coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS each FROM k),
 m AS (SELECT arg_min(each, k) FILTER (stop > each) AS each FROM l)
SELECT doc_id, size, n AS source_size, round(least(3.0 * n, coalesce(m.each * w, 3.0 * n)), 3) AS target FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source, m"""
