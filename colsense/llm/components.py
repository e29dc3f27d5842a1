"""Connected components of a link table: no part of the graph reaches the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Links that one task may hold; more are joined round by round.
ONE_TASK = 1 << 20


def _united(batches):
    """The links of one task, as (node, smallest node reached): bounded by ONE_TASK."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
    if parent:
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, schema.types[0]), pa.array([root(x) for x in nodes], schema.types[0])], ["node", "component"])


def connected_components(links: DataFrame, one_task: int = ONE_TASK, most_rounds: int = 60) -> DataFrame:
    """links (a, b: long or binary) -> (node, component): the smallest node that links reach; nodes without links aren't listed.

    At most `one_task` links (counted first) are united in one task. More alternate two joins until nothing changes: every
    larger neighbour of a node is tied to the node's smallest neighbour, then every smaller one is. Neighbourhoods are only
    ever reduced to a minimum, so hubs are pre-aggregated.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if edges.count() <= one_task:
        kind = dict(edges.dtypes)["u"].replace("bigint", "long")
        return edges.coalesce(1).mapInArrow(_united, f"node {kind}, component {kind}")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = written(small.filter("u <> v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components didn't settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v")).distinct()
