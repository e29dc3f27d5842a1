"""Operator 3: n-gram Jaccard self-join of documents by rare-first prefix filtering."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bitmap, fresh, given_back, gram_hashes, in_bitmap, joined_by_key, located, pieces, text_or_empty, word_hashes, written
from .components import connected_components

#: Counters of the table that orders n-grams from rare to frequent, and parts of it that are summed apart.
COUNTERS, PARTS = 1 << 22, 64
#: Classes of an n-gram's list that every class of the list meets, turn by turn; in the last turn (0) all pairs meet.
LEADERS = (1, 32, 128, 0)
#: Classes of one list that a join's group holds; longer lists are dealt out in blocks.
BLOCK = 4096
#: Pairs of one class that a task verifies in a row.
RUN = 256
#: Ranges that the fixed pivots of the suffix filter cut all n-grams into: least and most, and n-grams of a set to a range.
PIVOTS, MOST_PIVOTS, EACH = 64, 4096, 4


def _digest(raw: bytes) -> bytes:
    """128-bit key of a text's lower-cased words."""
    return hashlib.md5(b" ".join(raw.lower().split()), usedforsecurity=False).digest()


_BLANK = _digest(b"")


def _sets(array: pa.Array, n: int, only=None):
    """Of each text: (row, key of its word sequence, sorted distinct n-gram hashes); with `only`, of rows whose key it lets through."""
    for lo, hi, buf, starts in pieces(array, 1 << 18):
        raw = buf.tobytes()
        keys = [_digest(raw[i:j]) for i, j in zip(starts[:-1].tolist(), starts[1:].tolist())]
        rows = [i for i, k in enumerate(keys) if only is None or only(k)]
        if not rows:
            continue
        w, at = word_hashes(buf, starts)
        grams = gram_hashes(w, n)
        for i in rows:
            a, b = int(at[i]), int(at[i + 1])
            # fewer words than n: the whole sequence is the one n-gram
            yield lo + i, keys[i], np.unique(grams[a : b - n + 1]) if b - a >= n else gram_hashes(w[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _ranges(s: np.ndarray) -> bytes:
    """How many n-grams a set has in each range; the more n-grams, the more ranges, a power of two."""
    bits = min(max(len(s) // EACH, PIVOTS), MOST_PIVOTS).bit_length() - 1
    return np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _described(n: int):
    """One row per document, and what a task has counted, as rows without a key."""

    def f(batches):
        counts = np.zeros(COUNTERS, np.uint32)
        names = ["doc_id", "place", "k", "n", "sig", "part"]
        for batch in batches:
            keys, sizes, sigs = [], [], []
            for _, k, s in _sets(batch.column("text"), n):
                keys.append(k), sizes.append(len(s))
                sigs.append(_ranges(s))
                np.add.at(counts, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("place"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary()), pa.nulls(len(keys), pa.int32())], names)
        if counts.any():
            step = COUNTERS // PARTS
            counts = np.minimum(counts, 65535).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(PARTS, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.int32())), pa.array([counts[i * step : (i + 1) * step].tobytes() for i in range(PARTS)], pa.binary()), pa.array(range(PARTS), pa.int32())], names)

    return f


def _added(counts: pa.Table) -> pa.Table:
    """A part's counters, summed. Arrow, not pandas, which each worker would have to load and keep."""
    total = np.zeros(COUNTERS // PARTS, np.uint32)
    for x in counts.column("sig"):
        x = np.frombuffer(x.as_buffer(), np.uint16 if len(x.as_buffer()) == 2 * len(total) else np.uint32)
        total += np.minimum(x, np.uint32(2**32 - 1) - total)
    return pa.table({"part": counts.column("part").slice(0, 1), "sig": pa.array([total.tobytes()], pa.binary())})


def _prefixes(n: int, percent: int, table, here, again=None):
    """Prefix n-grams of the texts whose place the map `here` lets through; with `again`, of those n-grams that this map has, their classes, sizes and positions too."""

    def f(batches):
        done: set[bytes] = set()  # texts whose rows this task has given
        for batch in batches:
            some = batch.column("text").take(pa.array(np.flatnonzero(in_bitmap(here.value, batch.column("place").to_numpy()))))
            h, at, keys, sizes = [], [], [], []
            for _, k, s in _sets(some, n, lambda k: k not in done):
                if not len(s) or k in done:
                    continue
                done.add(k)
                c = table.value[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                p = len(s) - -(-percent * len(s) // 100) + 1
                first = s[np.lexsort((s, c))[:p]].view(np.int64)
                place = np.flatnonzero(in_bitmap(again.value, first)) if again else np.arange(p)
                h.append(first[place]), at.append(place), keys.append(k), sizes.append(len(s))
            if h and not again:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h))], ["h"])
            elif h:
                p = np.array([len(x) for x in h])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(h)), pa.array(keys, pa.binary()).take(pa.array(np.repeat(np.arange(len(p)), p))), pa.array(np.repeat(sizes, p).astype(np.int32)), pa.array(np.concatenate(at).astype(np.int32))],
                    ["h", "k", "n", "p"])

    return f


def _fetched(n: int, wanted):
    def f(batches):
        for batch in batches:
            some = batch.column("text").take(pa.array(np.flatnonzero(in_bitmap(wanted.value, batch.column("place").to_numpy()))))
            rows = [(k, s) for _, k, s in _sets(some, n)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([s.tobytes() for _, s in rows], pa.binary())], ["k", "grams"])

    return f


def _verified(percent: int):
    """Rows sorted by (hub, run, other), where the hub's own set comes first, with no other."""

    def f(batches):
        held, hub = None, None
        for batch in batches:
            a, b = [], []
            for k, other, grams in zip(*(batch.column(c).to_pylist() for c in ("hub", "other", "grams"))):
                x = np.frombuffer(grams, np.uint64)
                if other is None:
                    held, hub = x, k
                    continue
                assert k == hub
                small, large = (x, held) if len(x) < len(held) else (held, x)
                both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                if 100 * both >= percent * (len(x) + len(held) - both):
                    a.append(k), b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return f


def _suffix(percent: int):
    """The suffix filter: sets cut at fixed pivots differ by no less than the pieces' sizes do. What may be similar stays."""

    def f(batches):
        for batch in batches:
            na, nb = batch.column("na").to_numpy().astype(np.int64), batch.column("nb").to_numpy().astype(np.int64)
            most, good = na + nb - 2 * -(-percent * (na + nb) // (100 + percent)), []
            for i, (x, y) in enumerate(zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())):
                x, y = (np.frombuffer(z, np.uint8).astype(np.int32) for z in (x, y))
                full = (x == 255).any() or (y == 255).any()  # a range whose size isn't known
                size = min(len(x), len(y))
                if full or np.abs(x.reshape(size, -1).sum(1) - y.reshape(size, -1).sum(1)).sum() <= most[i]:
                    good.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(good, pa.int64())) for c in ("a", "b", "hub_b")], ["a", "b", "hub_b"])

    return f


def _classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: doc_id, k, n; classes: k, n, sig, m, least, component of those that have links, ..)."""
    spark = docs.sparkSession
    docs, path, row = located(docs.select("doc_id", "text"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(path, row).alias("place"), text_or_empty().alias("text"))
    seen = written(docs.mapInArrow(given_back(_described(n)), "doc_id long, place long, k binary, n int, sig binary, part int"), "described")
    rows = seen.filter("part IS NULL").select("doc_id", "place", "k", "n", "sig")
    some = F.pmod(F.spark_partition_id(), F.lit(max(1, math.ceil(len(seen.inputFiles()) / 256))))
    parts = seen.filter("part IS NOT NULL").select("part", "sig", some.alias("salt")).groupBy("part", "salt").applyInArrow(_added, "part int, sig binary")
    table = np.zeros(COUNTERS, np.uint16)  # for the order alone: n-grams above the most it holds are as frequent as each other
    for r in parts.groupBy("part").applyInArrow(_added, "part int, sig binary").collect():  # PARTS rows, of fixed size
        x = np.frombuffer(r["sig"], np.uint32)
        table[r["part"] * len(x) : (r["part"] + 1) * len(x)] = np.minimum(x, 65535)
    table = spark.sparkContext.broadcast(table)
    classes = written(rows.filter("n > 0").groupBy("k").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.count("*").alias("m"), F.min("doc_id").alias("least"), F.min("place").alias("place")), "classes")
    # one text of each class is read; most n-grams of prefixes are in one class alone, so that these are told by themselves first and aren't moved with their classes
    here = spark.sparkContext.broadcast(bitmap(classes, "place"))
    texts = docs.select("place", "text")
    shared = texts.mapInArrow(given_back(_prefixes(n, percent, table, here)), "h long").groupBy("h").agg(F.count("*").alias("m")).filter("m > 1")
    again = spark.sparkContext.broadcast(bitmap(written(shared.select("h"), "shared"), "h"))
    emitted = texts.mapInArrow(given_back(_prefixes(n, percent, table, here, again)), "h long, k binary, n int, p int")

    def pairs(now: DataFrame, leaders: int, turn: int) -> DataFrame:
        """Distinct pairs (a, b) of classes of different components that meet in a list and that all filters let through."""
        if leaders:
            # the same leaders in all lists of the same classes, so that their pairs coincide; the limit is applied before rows are dealt by h, too
            nth = F.row_number().over(Window.partitionBy("h").orderBy(F.xxhash64("k", F.lit(turn)), "k"))
            lead = now.withColumn("nth", nth).filter(F.col("nth") <= leaders)
        else:
            lead = now
        blocks = F.ceil(F.col("m") / BLOCK).cast("int")
        lead = lead.select("h", F.col("k").alias("k2"), F.col("n").alias("n2"), F.col("p").alias("p2"), F.col("c").alias("c2"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
        now = now.withColumn("block", F.pmod(F.xxhash64("k"), blocks).cast("int"))
        least = F.expr(f"({percent} * (n + n2) + {99 + percent}) div {100 + percent}")
        on = (F.col("c") != F.col("c2")) & (100 * F.col("n") >= percent * F.col("n2")) & (100 * F.col("n2") >= percent * F.col("n"))
        on &= (F.col("n") - F.col("p") >= least) & (F.col("n2") - F.col("p2") >= least)
        if not leaders:
            on &= F.col("k") < F.col("k2")
        met = now.join(lead, ["h", "block"]).filter(on)
        found = met.select(F.least("k", "k2").alias("a"), F.greatest("k", "k2").alias("b"), (F.col("k2") > F.col("k")).alias("hub_b")).groupBy("a", "b").agg(F.max("hub_b").alias("hub_b"))
        for x in "ab":
            found = found.join(classes.select(F.col("k").alias(x), F.col("n").alias("n" + x), F.col("sig").alias("s" + x)), x)
        return found.select("a", "b", "hub_b", "na", "nb", "sa", "sb").mapInArrow(_suffix(percent), "a binary, b binary, hub_b boolean")

    def verified(found: DataFrame) -> DataFrame:
        """Pairs that are similar. A hub's set is sent once per RUN of its pairs, the others' sets once per pair."""
        hub = F.when(F.col("hub_b"), F.col("b")).otherwise(F.col("a"))
        to = found.select(hub.alias("hub"), F.when(F.col("hub_b"), F.col("a")).otherwise(F.col("b")).alias("other"))
        runs = to.groupBy("hub").agg(F.count("*").alias("m")).withColumn("runs", F.ceil(F.col("m") / RUN).cast("int"))
        others = joined_by_key(to, runs, "hub", "m").select(F.col("other").alias("k"), "hub", F.pmod(F.xxhash64("other"), F.col("runs")).cast("int").alias("run"), "other")
        hubs = runs.select(F.col("hub").alias("k"), "hub", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.lit(None).cast("binary").alias("other"))
        need = written(others.union(hubs), "needed")
        # only texts of these classes are read again: the map is of one text's place for each class
        places = classes.join(need.select("k").distinct(), "k").select("place")
        wanted = spark.sparkContext.broadcast(bitmap(places, "place"))
        sets = docs.select("place", "text").mapInArrow(given_back(_fetched(n, wanted)), "k binary, grams binary").dropDuplicates(["k"])
        both = need.join(sets, "k").select("hub", "run", "other", "grams")
        both = both.repartition("hub", "run").sortWithinPartitions("hub", "run", "other")  # nulls come first
        out = written(both.mapInArrow(given_back(_verified(percent)), "a binary, b binary"), "links")
        wanted.destroy()
        return out

    shared, links, tried, component = emitted, None, None, None
    met = 1  # all pairs of lists of so many classes have met
    for turn, leaders in enumerate(LEADERS):
        now = shared.withColumn("c", F.col("k"))
        if component is not None:
            now = shared.join(component, shared["k"] == component["node"], "left").select("h", "k", "n", "p", F.coalesce("component", "k").alias("c"))
        # lists of one component go; their rows meet in one shuffle
        of, mark = Window.partitionBy("h"), F.xxhash64("c")
        now = now.withColumn("x", F.min(mark).over(of)).withColumn("y", F.max(mark).over(of)).withColumn("m", F.count("*").over(of)).filter("x <> y").filter(F.col("m") > met).drop("x", "y")
        now = written(now if turn else now.dropDuplicates(["h", "k"]), "lists")
        if not turn:
            table.destroy(), here.destroy(), again.destroy()
        if now.isEmpty():
            break
        found = pairs(now, leaders, turn)
        if tried is not None:
            found = found.join(tried, ["a", "b"], "left_anti")
        found = written(found, "candidates")
        shared, met = now.select("h", "k", "n", "p"), leaders + 1
        if found.isEmpty():
            continue
        good = verified(found)
        tried = found.select("a", "b") if tried is None else tried.union(found.select("a", "b"))
        links = good if links is None else links.union(good)
        component = written(connected_components(links), "components")
    if component is None:
        component = spark.createDataFrame([], "node binary, component binary")
    return rows, classes, component


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles long, component_id: documents linked when their n-gram sets' Jaccard similarity is at least percent / 100.

    Texts of the same words form one class. A set's n-grams are ordered by a table of corpus counts, rarest first; only
    the prefix in which a similar set must share an n-gram is emitted, without n-grams of one class alone. Classes that share a prefix n-gram are candidates if
    length, positional and suffix filters allow the similarity. Before all of them meet, two turns link what is easily
    linked: each class meets one leader per shared n-gram (as many pairs as rows, however large a group of near copies is),
    then more of them (LEADERS). In the last turn every pair meets whose classes are still in different components; a pair inside one needs
    no check, as the result, which documents reach each other, can't change by it. Lists of which all pairs have met are
    done. Each candidate pair is verified once, on its two whole sets.

    Words: `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased. Fewer words than n: the sequence is the one n-gram. Null, empty or
    blank texts have an empty set and link with nothing, nor with each other. One row per input row; rows with equal
    texts share a class, whatever their ids. A null doc_id counts as larger than any (a component of nulls alone has a
    null id). Other columns are ignored; an empty table gives no rows. Classes are keyed by 128-bit digests of their
    words, n-grams by 64-bit hashes. The table of counts is of fixed size and decides the order alone.
    """
    rows, classes, component = _classes(docs, n, percent)
    placed = classes.join(component, classes["k"] == component["node"], "left").select("k", "m", "least", F.coalesce("component", "k").alias("c"))
    least = placed.groupBy("c").agg(F.min("least").alias("component_id"), F.count("*").alias("of"))
    ids = written(joined_by_key(placed, least, "c", "of").select("k", "m", "component_id"), "ids")
    some = joined_by_key(rows.filter("n > 0").select("doc_id", "k", F.col("n").cast("long").alias("n_shingles")), ids, "k", "m")
    return some.select("doc_id", "n_shingles", "component_id").union(rows.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _keyed(column: str, held):
    """Rows with their class's key, if the map lets it through; of such rows that a task meets again with one key and doc_id, the first."""

    def f(batches):
        seen: set = set()
        for batch in batches:
            text = batch.column("text").cast(pa.string()).to_pylist()
            keys = [_digest((t or "").encode()) for t in text]
            some = in_bitmap(held.value, np.array([zlib.crc32(k) for k in keys], np.int64))
            keys = [k if x and k != _BLANK else None for k, x in zip(keys, some.tolist())]
            keep = [i for i, k in enumerate(zip(keys, batch.column("doc_id").to_pylist())) if k[0] is None or k not in seen and not seen.add(k)]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep, pa.int64())) for c in batch.columns), pa.array([keys[i] for i in keep], pa.binary())], [*batch.schema.names, column])

    return f


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs without near-duplicates: of each component the row of the smallest doc_id stays, with all its columns.

    Null ids come last; of rows that share a component's smallest doc_id, the one whose words' digest is smallest stays, and
    of rows with both the same one row, the smallest text. Rows of other components that repeat the doc_id aren't touched.
    Null, empty and blank texts link with nothing and all stay. Columns of any name are kept.
    """
    spark = docs.sparkSession
    _, classes, component = _classes(docs, n, percent)
    placed = classes.join(component, classes["k"] == component["node"], "left").select("k", "m", "least", F.coalesce("component", "k").alias("c"))
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "k")).alias("x")
    groups = written(placed.groupBy("c").agg(F.sum("m").alias("of"), F.count("*").alias("classes"), first).filter("of > 1"), "groups")
    # rows that are alone in their component pass by; the others meet the table of those that stay
    touched = joined_by_key(placed.select("k", "c"), groups.select("c", "classes"), "c", "classes").select(F.crc32("k").alias("k"))
    held = spark.sparkContext.broadcast(bitmap(touched, "k"))
    key = fresh(docs, "_key")
    keyed = docs.mapInArrow(given_back(_keyed(key, held)), ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + f", `{key}` binary")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    some, stay = keyed.filter(F.col(f"`{key}`").isNotNull()), groups.select(F.col("x.k").alias("_k"), F.col("x.least").alias("_least"))
    alone = placed.join(groups.select("c"), "c", "left_anti").select(F.col("k").alias("_k"), F.col("least").alias("_least"))
    stay = stay.union(alone)
    named = some.join(stay, (some[key] == stay["_k"]) & some["doc_id"].cast("long").eqNullSafe(stay["_least"]), "left_semi")
    nth = fresh(keyed, "_nth")
    named = named.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(text_or_empty()))).filter(F.col(f"`{nth}`") == 1)
    return named.select(*columns).union(keyed.filter(F.col(f"`{key}`").isNull()).select(*columns))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 4, 85)


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct([array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)])
                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
g AS (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS g FROM s),
one AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
        GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (max(a.n) + max(b.n) - count(*))),
links AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = s.doc_id
"""
