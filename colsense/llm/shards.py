"""Operator 2: sharding with size-tiered compaction and a versioned manifest. DataFrame operations only."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

#: Merged groups that one job writes.
PER_JOB = 64


@dataclass(frozen=True)
class Shard:
    """An immutable file: where it lies under the store's root, its bytes, and the version that brought it."""

    path: str
    bytes: int
    version: int


class CommitConflict(RuntimeError):
    """Another writer has committed the version first; read the manifest again and retry."""


class ShardStore:
    """A table of immutable Parquet shards listed by manifests `manifest/v<n>.json`.

    A version is committed by renaming a finished manifest to the next number, which fails if that exists; readers see
    a whole version or the one before. Files that no manifest lists (of jobs that failed) are never read.
    """

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 64 << 20, fanout: int = 4, least_bytes: int = 1 << 20):
        self.spark, self.root, self.target, self.fanout, self.least = spark, root.rstrip("/"), target_bytes, fanout, least_bytes
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(f"{self.root}/manifest"))

    def version(self) -> int:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/manifest"))]
        return max([int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")], default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "shards": []}
        stream = self._fs.open(self._path(f"{self.root}/manifest/v{version}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        out = json.loads(text)
        return out | {"shards": [Shard(**s) for s in out["shards"]]}

    def _commit(self, version: int, schema: str, shards: list[Shard]) -> None:
        jvm = self.spark.sparkContext._jvm
        draft = self._path(f"{self.root}/manifest/.draft-{version}-{jvm.java.util.UUID.randomUUID()}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps({"version": version, "schema": schema, "shards": [asdict(s) for s in shards]}).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self._path(f"{self.root}/manifest/v{version}.json"), none)
        except Exception as e:
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                raise CommitConflict(version) from e
            raise

    def _files(self, folder: str, version: int) -> list[Shard]:
        found = self._fs.listStatus(self._path(f"{self.root}/{folder}"))
        return [Shard(f"{folder}/{s.getPath().getName()}", s.getLen(), version) for s in found if s.getPath().getName().startswith("part-")]

    def append(self, df: DataFrame) -> int:
        """Writes df's partitions as new shards, one file each, and commits them. Returns the version."""
        now = self.manifest()
        version = now["version"] + 1
        folder = f"data/v{version:06d}-append-{self.spark.sparkContext._jvm.java.util.UUID.randomUUID()}"
        df.write.parquet(f"{self.root}/{folder}")
        self._commit(version, df.schema.json(), now["shards"] + self._files(folder, version))
        return version

    def compact(self) -> int:
        """Merges runs of similar size until no tier has enough of them; each round commits one version. Returns the last.

        A merge reads its whole shards in one task that writes one file of at most about the target size: nothing is
        shuffled. Up to PER_JOB merges share a job.
        """
        while True:
            now = self.manifest()
            version, shards = now["version"] + 1, now["shards"]
            groups = plan([s.bytes for s in shards], self.target, self.fanout, self.least)
            if not groups:
                return now["version"]
            out: list[Shard] = []
            for lo in range(0, len(groups), PER_JOB):
                parts = [self._read([shards[i] for i in g], now["schema"]).coalesce(1) for g in groups[lo : lo + PER_JOB]]
                folder = f"data/v{version:06d}-merge{lo // PER_JOB}-{self.spark.sparkContext._jvm.java.util.UUID.randomUUID()}"
                whole = parts[0]
                for p in parts[1:]:
                    whole = whole.union(p)
                whole.write.parquet(f"{self.root}/{folder}")
                out += self._files(folder, version)
            gone = {i for g in groups for i in g}
            self._commit(version, now["schema"], [s for i, s in enumerate(shards) if i not in gone] + out)

    def vacuum(self, keep: int = 1) -> int:
        """Deletes shards that none of the last `keep` versions lists. Returns how many."""
        last = self.version()
        held = {s.path for v in range(max(1, last - keep + 1), last + 1) for s in self.manifest(v)["shards"]}
        old = {s.path for v in range(1, last - keep + 1) if self._fs.exists(self._path(f"{self.root}/manifest/v{v}.json")) for s in self.manifest(v)["shards"]} - held
        for p in old:
            self._fs.delete(self._path(f"{self.root}/{p}"), False)
        for v in range(1, last - keep + 1):
            self._fs.delete(self._path(f"{self.root}/manifest/v{v}.json"), False)
        return len(old)

    def _read(self, shards: list[Shard], schema: str) -> DataFrame:
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*[f"{self.root}/{s.path}" for s in shards])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the last by default)."""
        now = self.manifest(version)
        if not now["shards"]:
            from pyspark.sql.types import StructType

            return self.spark.createDataFrame([], StructType.fromJson(json.loads(now["schema"])) if now["schema"] else StructType([]))
        return self._read(now["shards"], now["schema"])


def plan(sizes: list[int], target: int, fanout: int, least: int) -> list[list[int]]:
    """Which shards to merge: groups of at least `fanout` of one tier, oldest first, each of at most `target` bytes.

    A tier holds sizes within a factor of `fanout`; all below `least` are one tier. Shards over half the target are done.
    """
    tiers: dict[int, list[int]] = {}
    for i, n in enumerate(sizes):
        if 2 * n <= target:
            tiers.setdefault(0 if n < least else 1 + int(math.log(n / least, fanout)), []).append(i)
    out = []
    for tier in sorted(tiers):
        group, total = [], 0
        for i in tiers[tier]:
            if group and total + sizes[i] > target:
                out.append(group)
                group, total = [], 0
            group.append(i)
            total += sizes[i]
        out.append(group)
    return [g for g in out if len(g) >= fanout or len(g) > 1 and 2 * sum(sizes[i] for i in g) > target]


def sharded(docs: DataFrame, root: str, arrivals: int = 4, **options) -> ShardStore:
    """A store under root that docs have been appended to in `arrivals` parts (by a hash of doc_id) and compacted.

    Any schema and any rows: nulls, repeated rows and empty texts are kept as they are; an empty table gives a store
    whose shards hold no rows.
    """
    store = ShardStore(docs.sparkSession, root, **options)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(arrivals))
    for i in range(arrivals):
        store.append(docs.filter(part == i))
        store.compact()
        store.vacuum()
    return store


def op2_size_tiered_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document lies after its arrivals were appended and compacted: shard and its size, read back from it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = sharded(docs, shared_dir(spark))
    place = r"v(\d+)-(?:append|merge(\d+))-[^/]*/part-(\d+)"
    path = F.col("_metadata.file_path")
    shard = F.concat_ws("-", *[F.regexp_extract(path, place, i) for i in (1, 2, 3)])
    return store.read().select("doc_id", shard.alias("shard"), F.col("_metadata.file_size").alias("shard_bytes"), "source", "lang", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op2_size_tiered_shards's result that SQL can express: the rows that are read back from the shards."""
    return op2_size_tiered_shards(spark, sf_dir).select("doc_id", "source", "lang", "n_bytes", "text_sha256")


SQL_ROWS = "SELECT doc_id, source, lang, strlen(text) AS n_bytes, sha256(text) AS text_sha256 FROM documents"
