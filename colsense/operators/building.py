"""Descriptions built in bulk from maps and links, links removed, and partial references resolved."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written


def checked_map(maps: DataFrame, columns: DataFrame, properties: DataFrame) -> DataFrame:
    """maps(ssd_id, column, class, label) with why: null if the row can be mapped.

    The column must exist in columns(ssd_id, column) and be mapped once, the property in properties(class, label), and a
    description uses a data node once.
    """
    some = lambda c: F.count("*").over(Window.partitionBy("ssd_id", *c)) > 1
    rows = maps.join(columns.select("ssd_id", "column").distinct().withColumn("c", F.lit(1)), ["ssd_id", "column"], "left")
    rows = rows.join(properties.select("class", "label").distinct().withColumn("p", F.lit(1)), ["class", "label"], "left")
    why = F.when(F.col("c").isNull(), "no such column").when(F.col("p").isNull(), "no such property").when(some(["column"]), "column mapped twice").when(some(["class", "label"]), "data node used twice")
    return rows.withColumn("why", why).select(*maps.columns, "why")


def checked_links(links: DataFrame, allowed: DataFrame) -> DataFrame:
    """links(ssd_id, src, label, dst) with why: null if allowed(src, label, dst), the ontology's inferred links, has it."""
    key = ["src", "label", "dst"]
    rows = links.join(allowed.select(*key).distinct().withColumn("a", F.lit(1)), key, "left")
    return rows.select(*links.columns, F.when(F.col("a").isNull(), "no such link").alias("why"))


def built(maps: DataFrame, links: DataFrame, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """Nodes and links of all descriptions at once, from rows that the checks have passed.

    Class nodes come first, then data nodes, then columns, each in the order of names; links likewise. A class that
    only a link names gets a node too.
    """
    # a row names its nodes, so that they are numbered, and lead back to their row, within a description: rows are dealt by ssd_id once
    row = ["map", "a", "label", "b"]
    rows = maps.select("ssd_id", F.lit(True).alias("map"), F.col("class").alias("a"), "label", F.col("column").alias("b"))
    rows = rows.union(links.select("ssd_id", F.lit(False), "src", "label", "dst").distinct())
    none = F.lit(None).cast("string")
    node = lambda end, k, name, owner: F.struct(F.lit(end).alias("end"), F.lit(k).alias("k"), name.alias("name"), owner.alias("owner"))
    first, last = node(0, 0, F.col("a"), none), node(1, 0, F.col("b"), none)
    mapped = F.array(first, node(1, 1, F.col("label"), F.col("a")), node(2, 2, F.col("b"), none))
    order = Window.partitionBy("ssd_id").orderBy("k", "owner", "name")
    n = rows.select("ssd_id", *row, F.inline(F.when(F.col("map"), mapped).otherwise(F.array(first, last)))).withColumn("node_id", (F.dense_rank().over(order) - 1).cast("long"))
    once = n.select("ssd_id", "k", "owner", "name", "node_id").withColumn("before", F.lag("node_id").over(order)).filter("before IS NULL OR before <> node_id")
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("ClassNode", "DataNode", "Column")]), F.col("k") + 1)
    nodes = once.select("ssd_id", "node_id", kinds.alias("type"), F.col("name").alias("label"), F.lit(prefix).alias("prefix"))

    ids = n.groupBy("ssd_id", *row).agg(*[F.max(F.when(F.col("end") == i, F.col("node_id"))).alias(f"i{i}") for i in range(3)], F.count_if(F.col("end") == 0).alias("times"))
    ids = ids.filter("ssd_id IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL AND (label IS NOT NULL OR NOT map)")
    link = lambda x, y, label, kind: F.struct(F.col(x).alias("source"), F.col(y).alias("target"), label.alias("label"), F.lit(kind).alias("type"))
    to_column = F.array_repeat(link("i1", "i2", F.lit("connect"), "ColumnLink"), F.col("times").cast("int"))
    of_map = F.concat(F.array(link("i0", "i1", F.col("label"), "DataPropertyLink")), to_column)
    e = ids.select("ssd_id", F.inline(F.when(F.col("map"), of_map).otherwise(F.array(link("i0", "i1", F.col("label"), "ObjectPropertyLink")))))
    order = Window.partitionBy("ssd_id").orderBy(F.desc("type"), "source", "target", "label")
    same = F.struct("type", "source", "target").eqNullSafe(F.lag(F.struct("type", "source", "target")).over(order))  # a data link of several columns comes once
    e = e.withColumn("again", same & (F.col("type") == "DataPropertyLink")).filter("NOT again")
    e = e.withColumn("link_id", (F.row_number().over(order) - 1).cast("long")).withColumn("prefix", F.lit(prefix))
    return nodes, e.select("ssd_id", "link_id", "source", "target", "label", "type", "prefix")


def remove_links(nodes: DataFrame, links: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes and links left without wanted(ssd_id, label, source, target), and wanted with status ok, missing or ambiguous.

    Null ends match any. Ends of removed links go where no link is left to them, but for columns.
    """
    # wanted, links and nodes are rows of one kind that meet by windows within a description: none is sent through the driver, and what is dealt by ssd_id isn't dealt again
    ends = ("source", "target")
    rows = links.withColumn("asks", F.lit(False)).unionByName(wanted.select("ssd_id", "label", *ends).distinct().withColumn("asks", F.lit(True)), allowMissingColumns=True)
    asks, link = F.col("asks"), F.struct("link_id", *ends)
    some = lambda of: [x for k in range(len(of) + 1) for x in combinations(of, k)]
    all_ = lambda ok, x: reduce(lambda a, b: a & b, x, ok)
    rows = rows.withColumns({"n": F.lit(0).cast("long"), "hit": F.when(F.lit(False), link)})
    for by in some(ends):
        # links of the label with these ends; their other ends fit where they are null, or where the asking row's are
        other = [c for c in ends if c not in by]
        over = Window.partitionBy("ssd_id", "label", *reversed(by)).orderBy(*other).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # two sorts for the four
        n, hit = F.col("n"), F.col("hit")
        for null in some(other):
            this = all_(asks & F.col("ssd_id").isNotNull() & F.col("label").isNotNull(), [F.col(c).isNotNull() if c in by + null else F.col(c).isNull() for c in ends])
            ok = all_(~asks, [F.col(c).isNull() for c in null])
            n, hit = n + F.when(this, F.count_if(ok).over(over)).otherwise(0), F.least(hit, F.when(this, F.min(F.when(ok, link)).over(over)))
        rows = rows.withColumns({"n": n, "hit": hit})
    status = rows.filter("asks").withColumn("status", F.when(F.col("n") == 0, "missing").when(F.col("n") > 1, "ambiguous").otherwise("ok"))
    rows = rows.withColumn("ok", asks & (F.col("n") == 1)).withColumn("at", F.when(~asks, F.col("link_id")).when(F.col("ok"), F.col("hit.link_id")))
    gone = F.col("ssd_id").isNotNull() & F.col("at").isNotNull() & F.max("ok").over(Window.partitionBy("ssd_id", "at"))
    rows = rows.withColumn("gone", gone)
    left = rows.filter("NOT asks AND NOT gone")
    end = lambda c, still: F.struct(F.col(c).alias("node_id"), F.lit(still).alias("still"))
    marks = F.when(F.col("ok"), F.array(end("hit.source", False), end("hit.target", False))).when(~asks & ~F.col("gone"), F.array(end("source", True), end("target", True)))
    marks = rows.select("ssd_id", F.inline(marks))
    at = Window.partitionBy("ssd_id", "node_id")
    is_ = lambda c: F.count_if(c).over(at) > 0
    lonely = F.col("node_id").isNotNull() & is_(~F.col("still")) & ~is_(F.col("still")) & is_(F.col("type") != "Column")
    out = nodes.unionByName(marks, allowMissingColumns=True).withColumn("lonely", lonely).filter("still IS NULL AND NOT lonely")
    return out.select(*nodes.columns), left.select(*links.columns), status.select("ssd_id", "label", *ends, "status")


def resolve(references: DataFrame, items: DataFrame, keys: list[str], ref: str = "ref_id", item: str = "item_id", exact: bool = False) -> DataFrame:
    """(ref, item, status): the item that a partial reference means.

    keys are tried in order; null on either side fits anything; candidates narrow key by key until one is left. status is
    ok, none, or ambiguous; exact also asks for equal values of all keys. Items are counted by the keys that both sides have,
    once for each pattern of nulls that occurs (at most 2 ** keys on each side), and references meet the counts: a
    reference or an item without a key, the first included, meets no list of the other side.
    """
    k = len(keys)
    has = lambda df: F.concat(*[F.when(df[c].isNull(), "0").otherwise("1") for c in keys])
    r, i = references.select(ref, *keys, has(references).alias("_has")), items.select(item, *keys, has(items).alias("_has"))
    r, i = written(r), written(i)
    seen = [[x["_has"] for x in df.select("_has").distinct().collect()] for df in (r, i)]  # patterns, not rows
    levels = None
    for j in range(k):
        for a in sorted({x[: j + 1] for x in seen[0]}):
            asked = r.filter(F.substring("_has", 1, j + 1) == a)
            for b in sorted({x[: j + 1] for x in seen[1]}):
                common = [keys[x] for x in range(j + 1) if a[x] == b[x] == "1"]
                some = i.filter(F.substring("_has", 1, j + 1) == b).groupBy(*common).agg(F.count("*").alias("n"), F.min(item).alias("hit"))
                met = asked.join(some, common) if common else asked.join(F.broadcast(some))  # one row of counts
                met = met.select(ref, F.lit(j).alias("level"), "n", "hit")
                levels = met if levels is None else levels.union(met)
    if levels is None:
        return references.select(ref, F.lit(None).cast(dict(items.dtypes)[item]).alias(item), F.lit("none").alias("status"))
    per = levels.groupBy(ref, "level").agg(F.sum("n").alias("n"), F.min("hit").alias("hit"))
    per = per.groupBy(ref).agg(*[F.struct(F.coalesce(F.max(F.when(F.col("level") == j, F.col("n"))), F.lit(0)).alias("n"), F.max(F.when(F.col("level") == j, F.col("hit"))).alias("hit")).alias(f"l{j}") for j in range(k)])
    per = r.join(per, ref, "left")
    first = F.coalesce(*[F.when(F.coalesce(F.col(f"l{j}.n"), F.lit(0)) <= 1, F.struct(F.col(f"l{j}.hit").alias("hit"))) for j in range(k)])
    per = per.withColumn("m", first).withColumn("hit", F.col("m.hit"))
    if exact:
        all_ = i.select(F.col(item).alias("hit"), F.struct(*keys).alias("is"))
        per = per.join(all_, "hit", "left").withColumn("hit", F.when(F.struct(*keys).eqNullSafe(F.col("is")), F.col("hit")))
    status = F.when(F.col("m").isNull(), "ambiguous").when(F.col("hit").isNull(), "none").otherwise("ok")
    return per.select(ref, F.col("hit").alias(item), status.alias("status"))


def unregistered(members: DataFrame, known: DataFrame) -> DataFrame:
    """members(collection, kind, id) that no catalogue known(kind, id) has: a collection with any can't be trained."""
    return members.join(known.distinct(), ["kind", "id"], "left_anti").select("collection", "kind", "id")


def changed_members(members: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """members(collection, kind, id) with some added and some removed, each once."""
    key = ["collection", "kind", "id"]
    return members.select(*key).union(added.select(*key)).distinct().join(removed.select(*key), key, "left_anti")
