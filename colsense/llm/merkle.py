"""Operator 11: a Merkle manifest of a dataset by lag and lead windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import located, written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """`-` for null, else the number of bytes, `:` and the value, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def folded(leaf_: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf_, lambda d, x: F.sha2(F.concat(x["left"], d, x["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """One digest of all siblings of a proof, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def _numbered(rows: DataFrame, order: list) -> DataFrame:
    """rows with pos, from 0 in the order within their k, and n, the number of rows of that k.

    Rows are dealt by ranges of the order (k first) and lie in files in that order, so that a row's number in its file,
    the number at which its k begins there and the sum of earlier files' counts are its position: no task has all rows of a k.
    """
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "dealt")
    dealt = dealt.withColumn("at", F.col("_metadata.row_index"))
    runs = dealt.groupBy("k", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))  # a row for each k of a file
    upto = F.sum("rows").over(Window.partitionBy("k").orderBy("part"))
    runs = runs.select("k", "part", "first", (upto - F.col("rows")).alias("before"), F.sum("rows").over(Window.partitionBy("k")).alias("n"))
    return dealt.join(runs, ["k", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop("part", "at", "first", "before")


def _siblings(level: DataFrame, fanout: int) -> DataFrame:
    """level with run, slot, and left and right: the digests beside a node in its run, joined.

    A run's nodes stand in one small window; each lag and lead counts where the slot and the run's length say so.
    """
    level = level.withColumn("run", F.floor(F.col("pos") / fanout)).withColumn("slot", F.col("pos") % fanout)
    w, length = Window.partitionBy("k", "run").orderBy("pos"), F.least(F.lit(fanout), F.col("n") - F.col("run") * fanout)
    left = [F.when(F.col("slot") >= j, F.lag("d", j).over(w)).otherwise("") for j in range(fanout - 1, 0, -1)]
    right = [F.when(F.col("slot") + j < length, F.lead("d", j).over(w)).otherwise("") for j in range(1, fanout)]
    return level.withColumn("left", F.concat(*left)).withColumn("right", F.concat(*right))


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """Levels of every k's tree, nodes (k, pos, n, d, ..) first: of those k with several nodes, a run's first child hashes
    itself and what is right of it to the parent."""
    most, out = nodes.agg(F.max("n")).first()[0] or 0, [nodes]
    while most > 1:
        first = _siblings(out[-1].select("k", "pos", "n", "d"), fanout).filter("n > 1 AND slot = 0")
        up = first.select("k", F.col("run").alias("pos"), F.ceil(F.col("n") / fanout).alias("n"), F.sha2(F.concat("d", "right"), 256).alias("d"))
        out.append(written(up, f"level{len(out)}"))
        most = math.ceil(most / fanout)
    return out


def _tops(levels: list[DataFrame]) -> DataFrame:
    out = None
    for x in levels:
        x = x.filter("n = 1").select("k", "d")
        out = x if out is None else out.union(x)
    return out


def _proofs(levels: list[DataFrame], over: DataFrame, fanout: int) -> DataFrame:
    """The first level's rows with proof, subroot and root; over(k, proof, subroot, root) has those of each k's last node.

    From the last level down each node takes its run's siblings and its parent's proof; children find their parent by its
    number, so that a large k is as many keys as it has runs.
    """
    above = None
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        out = level.filter("n = 1").join(over, "k")
        if above is not None:
            some = _siblings(level.filter("n > 1"), fanout)
            up = above.select("k", F.col("pos").alias("run"), F.col("proof").alias("_up"), "subroot", "root")
            own = F.array(F.struct("left", "right")).cast(_STEP)
            some = some.join(up, ["k", "run"]).withColumn("proof", F.concat(own, "_up")).drop("run", "slot", "left", "right", "_up")
            out = out.unionByName(some)
        above = written(out, f"proofs{i}") if i else out
    return above


def manifest(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple = FIELDS, fanout: int = FANOUT, carry: dict[str, Column] | None = None) -> DataFrame:
    """(order, group, leaf, proof, subroot, root) of each row: its digest, the siblings on its way up, its group's and the whole root.

    Leaves of a group stand in the order given (nulls first, of equal ones the smaller digest first). While a group has
    several nodes, every `fanout` consecutive ones, the last run maybe fewer, become the digest of their digests; what
    remains is the group's subroot. Subroots, by group (null first, then by bytes), lead to the root likewise. `proof` is
    an array, a step for each level, of the digests left and right of the node. carry: further columns by name, computed
    from docs where they are read.

    One leaf per row, repeated rows included; null values of any field are told from empty ones; null is a group of its
    own; texts are hashed whole; columns that aren't named don't matter, whatever their names; an empty table gives no rows.
    """
    carry = carry or {}
    docs, path, row = located(docs)
    k = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    leaves = docs.select(
        F.col(f"`{order}`").alias("key"), F.col(f"`{group}`").cast("string").alias("grp"), k.alias("k"), leaf(*[F.col(f"`{c}`") for c in fields]).alias("d"),
        F.struct(*[v.alias(c) for c, v in carry.items()] or [F.lit(None).cast("string").alias("none")]).alias("carried"), F.xxhash64(path).alias("file"), F.col(row).alias("row"))
    leaves = written(leaves, "leaves")
    levels = _levels(_numbered(leaves, ["k", F.col("key").asc_nulls_first(), "d", "file", "row"]), fanout)
    # the tree over groups: one k
    tops = _tops(levels).select(F.lit("").alias("k"), F.col("k").alias("of"), "d").withColumn("null", F.col("of") != "-")
    over = _levels(_numbered(tops, ["k", "null", "of"]), fanout)
    none = F.array().cast(_STEP)
    whole = over[-1].filter("n = 1").select("k", none.alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("d").alias("root"))
    groups = written(_proofs(over, whole, fanout).select(F.col("of").alias("k"), "proof", F.col("d").alias("subroot"), "root"), "groups")
    out = _proofs(levels, groups, fanout)
    return out.select(F.col("key").alias(order), F.col("grp").alias(group), F.col("d").alias("leaf"), "proof", "subroot", "root", *[F.col(f"carried.{c}").alias(c) for c in carry])


def lowered(text: Column) -> Column:
    """text with A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    tampered = F.when(changed, leaf(*[lowered(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]))
    rows = manifest(docs, carry={"tampered": tampered})
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(levels: int, over: int) -> str:
    """The same in SQL, for groups of at most 16 ** levels rows and 16 ** over groups."""

    def tree(name: str, n: int) -> list[str]:
        up = lambda i: f"{name}{i} AS (SELECT k, pos // 16 AS pos, (n + 15) // 16 AS n, sha256(string_agg(d, '' ORDER BY pos)) AS d FROM {name}{i - 1} WHERE n > 1 GROUP BY ALL)"
        return [up(i) for i in range(1, n + 1)]

    def fold(name: str, prefix: str, n: int, first: str) -> list[str]:
        out = [first]
        for i in range(n):
            out.append(f"""{prefix}{i + 1} AS (SELECT f.id, f.k, CASE WHEN f.n > 1 THEN f.pos // 16 ELSE f.pos END AS pos, CASE WHEN f.n > 1 THEN (f.n + 15) // 16 ELSE 1 END AS n,
 CASE WHEN f.n > 1 THEN sha256(coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos < f.pos), '') || any_value(f.d) || coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos > f.pos), '')) ELSE any_value(f.d) END AS d,
 any_value(f.proof) || CASE WHEN f.n > 1 THEN coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos <> f.pos), '') ELSE '' END AS proof
 FROM {prefix}{i} f JOIN {name}{i} s ON s.k = f.k AND (f.n > 1 AND s.pos // 16 = f.pos // 16 OR f.n = 1 AND s.pos = f.pos) GROUP BY f.id, f.k, f.pos, f.n)""")
        return out

    f = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    body = lambda text: "sha256(" + " || ".join(f(text if c == "text" else c) for c in FIELDS) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"xor(4294967295, list_reduce([ascii(x)::BIGINT FOR x IN string_split(CAST(doc_id AS VARCHAR), '')], lambda a, b: list_reduce(range(8), lambda c, i: {step}, xor(a, b)), 4294967295::BIGINT))"
    keep = lambda name, n: [f"{name}{i} AS (SELECT * FROM u{name}{i} UNION ALL SELECT k, pos, n, d FROM {name}{i - 1} WHERE n = 1)" for i in range(1, n + 1)]
    parts = [f"l AS (SELECT doc_id, source, coalesce('=' || source, '-') AS k, {body('text')} AS d, CASE WHEN {crc} % 5 = 0 THEN {body(lower)} END AS x FROM documents)",
             "p AS (SELECT *, row_number() OVER (ORDER BY k, doc_id, d) AS id, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n FROM l)",
             "a0 AS (SELECT k, pos, n, d FROM p)"]
    for name, n in (("a", levels), ("b", over)):
        if name == "b":
            parts += [f"top AS (SELECT k, d FROM a{levels})", "bp AS (SELECT k AS of, '' AS k, row_number() OVER (ORDER BY k <> '-', encode(k)) - 1 AS pos, count(*) OVER () AS n, d FROM top)", "b0 AS (SELECT k, pos, n, d FROM bp)"]
        for up, all_ in zip(tree(name, n), keep(name, n)):
            parts += [f"u{up}", all_]
    parts += fold("a", "f", levels, "f0 AS (SELECT id, k, pos, n, coalesce(x, d) AS d, '' AS proof FROM p)")
    parts += fold("b", "g", over, f"g0 AS (SELECT f{levels}.id, b.k, b.pos, b.n, f{levels}.d, f{levels}.proof FROM f{levels} JOIN bp b ON b.of = f{levels}.k)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT p.doc_id, p.d AS leaf, top.d AS subroot, r.d AS root, sha256(g.proof) AS proof_sha256, g.d AS folded_root, g.d = r.d AS verified
FROM p JOIN top USING (k) JOIN g{over} g ON g.id = p.id, (SELECT d FROM b{over}) r"""


SQL = _sql(5, 2)
