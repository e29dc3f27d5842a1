"""Operator 7: exact deduplication by a stateful stream with disk-backed keyed state."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_RE, _scanned, bitmap, fresh, in_map, joined_by_key, located, settings, shared_dir, text_or_empty, written

#: Micro-batches that one call's arrivals are split into.
BATCHES = 3
_STATE = {
    "spark__sql__streaming__stateStore__providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark__sql__streaming__stateStore__rocksdb__allowFAllocate": "false",
    "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true",
    "spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB": "64",
    "spark__sql__streaming__stateStore__unloadOnCommit": "true",  # an executor holds the stores of running tasks alone
}
ARRIVALS = "doc_id long, digest string, text_sha256 string, path string, row long, run string"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), SPACE_RE, " ")


def _finished(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names in a folder that begin with prefix and hold a finished write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [x.getPath().getName() for x in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []
    return [n for n in found if n.startswith(prefix) and fs.exists(path(f"{folder}/{n}/_SUCCESS"))]


def digest_state(spark: SparkSession, base: str, files: int) -> DataFrame:
    """Streams the files of `base`/arrivals through keyed state; (digest, group_size, first) of all that ever came.

    State is kept per digest in RocksDB under `base`, without expiry: how many rows came and, of the row with the smallest
    identifier (null ids last, then the smallest place), identifier and locator. Each micro-batch writes the keys that it
    changed; a batch that is run again overwrites its own folder. Called again on the same `base`, the stream goes on from
    its checkpoint with the files that are new; its changes are laid over the last snapshot, which the call replaces, so
    that older changes aren't read again.
    """
    with settings(spark, **_STATE):
        stream = spark.readStream.schema(ARRIVALS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max(1, math.ceil(files / BATCHES))).parquet(f"{base}/arrivals")
        first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "path", "row", "run")
        state = stream.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(first).alias("first"))
        query = (
            state.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{base}/state")
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{base}/changed/batch={n}")).start()
        )
        query.awaitTermination()
    upto = max((int(n[5:]) for n in _finished(spark, f"{base}/snapshots", "upto=")), default=-1)
    new = sorted(n for n in (int(n[6:]) for n in _finished(spark, f"{base}/changed", "batch=")) if n > upto)
    if new:
        changed = spark.read.option("basePath", f"{base}/changed").parquet(*[f"{base}/changed/batch={n}" for n in new])
        now = changed.groupBy("digest").agg(F.max_by(F.struct("group_size", "first"), "batch").alias("x")).select("digest", "x.group_size", "x.first")
        if upto >= 0:
            old = spark.read.parquet(f"{base}/snapshots/upto={upto}")
            now = now.unionByName(old.join(now.select("digest"), "digest", "left_anti"))
        now.write.mode("overwrite").parquet(f"{base}/snapshots/upto={new[-1]}")
    return spark.read.parquet(f"{base}/snapshots/upto={new[-1] if new else upto}")


def _texts(docs: DataFrame, path: str, row: str, digest, places: DataFrame, run: str) -> DataFrame:
    """(digest, norm, doc_id, path, row) of the rows that places (path, row, run) point to and of some others: those of this
    run out of docs, those of earlier runs out of the files that hold them."""
    spark, here = docs.sparkSession, places.filter(F.col("run") == run)
    hashed = here.select(F.xxhash64("path", "row").alias("x"))
    held = spark.sparkContext.broadcast(bitmap(hashed, "x"))
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(path).alias("path"), F.col(row).alias("row"))
    some = some.withColumn("x", F.xxhash64("path", "row"))
    some = some.filter(in_map("x", held)).drop("x")
    files = [r["path"] for r in places.filter(F.col("run") != run).select("path").distinct().toLocalIterator()]  # names of files, not of rows
    if files:
        old = spark.read.schema("doc_id long, text string").parquet(*files)
        some = some.union(old.select("doc_id", "text", F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    return some.select(normalised().alias("norm"), "doc_id", "path", "row").withColumn("digest", digest(F.col("norm")))


def _groups(docs: DataFrame, digest, base: str | None, run: str | None = None) -> tuple[DataFrame, DataFrame, str, str]:
    """(docs with their places; per row of docs: doc_id, keep_id, group_size, kept, text_sha256, path, row; names of places)."""
    spark = docs.sparkSession
    alone, base = base is None, base or shared_dir(spark)
    if run is not None and not _scanned(docs):  # these rows get places that a repeated call finds again
        if f"run-{run}" not in _finished(spark, f"{base}/content", "run-"):
            docs.write.mode("overwrite").parquet(f"{base}/content/run-{run}")
        docs = spark.read.schema(docs.schema).parquet(f"{base}/content/run-{run}")
    docs, path, row = located(docs)
    text = normalised()
    new = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(text).alias("digest"), F.sha2(text, 256).alias("text_sha256"), F.col(path).alias("path"), F.col(row).alias("row"))
    if alone:
        run = "0"
    elif run is None:  # the rows themselves name the run
        new = written(new, "new")
        mark = new.agg(F.count("*"), *[F.sum(F.pmod(F.xxhash64("doc_id", "digest", "path", "row", F.lit(i)), F.lit(1 << 40))) for i in range(2)]).first()
        run = "-".join(f"{x or 0:x}" for x in mark)
    if f"run-{run}" not in _finished(spark, f"{base}/arrivals", "run-"):  # else a call that failed has left them
        new.withColumn("run", F.lit(run)).write.mode("overwrite").parquet(f"{base}/arrivals/run-{run}")
    rows = spark.read.schema(ARRIVALS).parquet(f"{base}/arrivals/run-{run}")
    every = spark.read.schema(ARRIVALS).option("recursiveFileLookup", "true").parquet(f"{base}/arrivals")
    out = "doc_id", "keep_id", "group_size", "kept", "text_sha256", "path", "row"
    if rows.isEmpty():
        none = rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "path", "row")
        return docs, none, path, row
    state = digest_state(spark, base, len(every.inputFiles()))

    # the whole texts of hits, fetched by their locators: a group agrees with the row that its state names when its least and greatest text do
    hits = state.filter("group_size > 1")
    named = hits.select("digest", "first.path", "first.row", "first.run")
    places = joined_by_key(rows.select("digest", "path", "row", "run"), hits.select("digest", "group_size"), "digest", "group_size")
    places = written(places.select("path", "row", "run").union(named.filter(F.col("run") != run).select("path", "row", "run")), "places")
    clash = _texts(docs, path, row, digest, places, run).groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).filter("a <> b").select("digest")
    clash = written(clash, "clash")
    same = state.select("digest", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.path").alias("p"), F.col("first.row").alias("r"))
    kept = ((F.col("path") == F.col("p")) & (F.col("row") == F.col("r"))).alias("kept")
    if clash.isEmpty():
        return docs, joined_by_key(rows, same, "digest", "group_size").select("doc_id", "keep_id", "group_size", kept, "text_sha256", "path", "row"), path, row
    # different texts under one digest: these are grouped by their bytes, with all rows that ever came
    apart = written(every.join(clash, "digest").select("path", "row", "run"), "apart")
    full = written(_texts(docs, path, row, digest, apart, run).join(apart.select("path", "row"), ["path", "row"]), "full")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "path", "row")
    least = full.groupBy("norm").agg(F.count("*").alias("group_size"), F.min(first).alias("first"))
    least = least.select("norm", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.path").alias("p"), F.col("first.row").alias("r"))
    other = full.join(least, "norm").join(rows.select("path", "row", "text_sha256"), ["path", "row"]).select("doc_id", "keep_id", "group_size", kept, "text_sha256", "path", "row")
    rest = joined_by_key(rows.join(clash, "digest", "left_anti"), same, "digest", "group_size").select("doc_id", "keep_id", "group_size", kept, "text_sha256", "path", "row")
    return docs, rest.union(other).select(*out), path, row


def dedup_exact(docs: DataFrame, digest=lambda text: F.sha2(text, 256), base: str | None = None, run: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: which row of equal texts stays.

    Texts are equal when identical after replacing each run of white space by one space; null counts as empty. The row
    with the smallest doc_id stays, null ids last; of rows that repeat both text and doc_id the one of the smallest place
    (file and number in it). One row per input row; other columns are ignored; an empty table gives no rows.

    Only digest, identifier and locator pass through the stream (see digest_state). On hits, that is for digests that
    several rows have, the whole texts are fetched by their locators and compared byte by byte; should texts differ under
    one digest, they are grouped by their bytes instead. `digest` may be another function (tests use one that clashes).

    base: a shared folder that keeps the state. A later call on it takes docs as further arrivals: rows of equal texts that
    came in earlier calls count, and stay if their doc_id is smaller. Files that locators name must still be there.

    run: a name for these arrivals. A call whose run has come before, such as one made again after a failure, adds nothing
    and returns the same rows. By default rows of files name their run themselves (ids, digests, places); rows of other
    sources have new places in each call, so that they need a name for a call to be repeated.
    """
    return _groups(docs, digest, base, run)[1].drop("path", "row")


def without_copies(docs: DataFrame) -> DataFrame:
    """docs with one row per text (see dedup_exact), all columns kept, whatever their names."""
    spark = docs.sparkSession
    placed, groups, path, row = _groups(docs, lambda text: F.sha2(text, 256), None)
    gone = written(groups.filter("NOT kept").select("path", "row"), "gone")
    held = spark.sparkContext.broadcast(bitmap(gone.select(F.xxhash64("path", "row").alias("x")), "x"))
    mark = fresh(placed, "_mark")
    placed = placed.withColumn(mark, F.xxhash64(path, row))
    # only rows that the map lets through meet the table of rows that go
    doubtful = in_map(mark, held)
    some = placed.filter(doubtful).join(gone, (F.col(path) == gone["path"]) & (F.col(row) == gone["row"]), "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return placed.filter(~doubtful).select(*columns).union(some.select(*columns))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
