"""Ranks within groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written


def runs(rows: DataFrame, group: list[str], order: list[Column | str], count: str) -> tuple[DataFrame, DataFrame]:
    """(rows, totals): rows with `part`, dealt by range of group and order; totals(group, part, before, upto): how much of
    `count` the group has in earlier parts, and with this one. As many totals as groups and partitions, not as rows."""
    dealt = written(rows.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy(*group, "part").agg(F.sum(count).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("part"))
    return dealt, sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n")).drop("n")


def placed(dealt: DataFrame, totals: DataFrame, group: list[str], order: list[Column | str], count: str) -> DataFrame:
    """Rows of the parts that totals has, with lo and hi: they stand for the numbers lo < number <= hi of their group."""
    within = F.sum(count).over(Window.partitionBy(*group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("hi", within).join(totals, [*group, "part"]).withColumn("hi", F.col("hi") + F.col("before")).withColumn("lo", F.col("hi") - F.col(count)).drop("before", "upto")


def in_order(rows: DataFrame, group: list[str], order: list[Column | str], count: str, wanted: DataFrame) -> DataFrame:
    """wanted(group, at, ..) with the row of its group that has number `at`, from 1, in the order; a row stands for `count` numbers."""
    dealt, totals = runs(rows, group, order, count)
    asked = wanted.join(totals, group).filter((F.col("at") > F.col("before")) & (F.col("at") <= F.col("upto"))).drop("before", "upto")
    some = dealt.join(asked.select(*group, "part").distinct(), [*group, "part"], "left_semi")
    found = placed(some, totals, group, order, count)
    return asked.join(found, [*group, "part"]).filter((F.col("at") > F.col("lo")) & (F.col("at") <= F.col("hi"))).drop("lo", "hi", "part")


def among_first(rows: DataFrame, group: str, key: Column, goals: DataFrame) -> DataFrame:
    """rows with `first`: whether a row is among its group's first `goal` by the hexadecimal digest `key`; goals(group, goal).

    Digests are counted by their first four digits; only the rows of the one range in which a group's goal falls are numbered.
    """
    rows = rows.withColumn("_key", key).withColumn("_range", F.substring("_key", 1, 4))
    sums = rows.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(group).orderBy("_range"))
    sums = sums.withColumn("_upto", upto).join(goals, group)
    edge = sums.filter((F.col("_upto") > F.col("goal")) & (F.col("_upto") - F.col("_n") < F.col("goal")))
    edge = edge.select(group, F.col("_range").alias("_edge"), (F.col("goal") - F.col("_upto") + F.col("_n")).alias("_left"))
    last = sums.filter(F.col("_upto") <= F.col("goal")).groupBy(group).agg(F.max("_range").alias("_last"))
    out = rows.join(last, group, "left").join(edge, group, "left")
    at_edge = F.coalesce(F.col("_range") == F.col("_edge"), F.lit(False))
    below = out.filter(~at_edge).withColumn("first", F.coalesce(F.col("_range") <= F.col("_last"), F.lit(False)))
    nth = F.row_number().over(Window.partitionBy(group, "_range").orderBy("_key"))
    numbered = out.filter(at_edge).withColumn("first", nth <= F.col("_left"))
    return below.unionByName(numbered).drop("_key", "_range", "_edge", "_left", "_last")


#: Ranges that a pass of by_histogram deals a group's numbers to, and passes after which what is left is sorted.
RANGES, PASSES = 1024, 6


def by_histogram(rows: DataFrame, group: str, x: str, count: str, wanted: DataFrame) -> DataFrame:
    """wanted(group, at) with `found`: the number x that has place `at`, from 1, in its group's rising order; a row stands for `count` places.

    Each pass deals what may hold the place to RANGES equal ranges, adds up counts and goes on with the one range in which
    the place falls, from its least to its greatest number, until these are equal: no row is sorted or moved, and only
    counts by range are shuffled. After PASSES passes, for numbers that are spread very unevenly, the rest goes by in_order.
    """
    ends = rows.groupBy(group).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    state, done = written(wanted.join(ends, group).withColumn("left", F.col("at"))), None  # a row for each place
    for _ in range(PASSES):
        sure = state.filter("lo = hi").select(*wanted.columns, F.col("lo").alias("found"))
        done = sure if done is None else done.union(sure)
        state = state.filter("lo < hi")
        if state.isEmpty():
            return done
        some = rows.join(state, group).filter((F.col(x) >= F.col("lo")) & (F.col(x) <= F.col("hi")))
        # halves, so that the difference of two doubles is one
        part = F.least(F.lit(RANGES - 1), F.floor(RANGES * ((F.col(x) / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)))).cast("int")
        sums = some.groupBy(*wanted.columns, "left", part.alias("part")).agg(F.sum(count).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*wanted.columns).orderBy("part"))  # at most RANGES rows
        sums = sums.withColumn("upto", upto).filter((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
        state = written(sums.select(*wanted.columns, "lo", "hi", (F.col("left") - F.col("upto") + F.col("n")).alias("left")))
    done = done.union(state.filter("lo = hi").select(*wanted.columns, F.col("lo").alias("found")))
    rest = state.filter("lo < hi")
    if rest.isEmpty():
        return done
    near = rows.join(rest.select(group, "lo", "hi").distinct(), group).filter((F.col(x) >= F.col("lo")) & (F.col(x) <= F.col("hi")))
    key = F.concat_ws("|", F.col(group), F.col("lo").cast("string"), F.col("hi").cast("string"))
    last = in_order(near.select(key.alias("_key"), x, count), ["_key"], [x], count, rest.select(*[F.col(c).alias(f"_{c}") for c in wanted.columns], key.alias("_key"), F.col("left").alias("at")))
    return done.union(last.select(*[F.col(f"_{c}").alias(c) for c in wanted.columns], F.col(x).alias("found")))
