"""Tables written once to the folder the cluster shares, to end a lineage between rounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_path(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset: in a temporary folder, with a local master alone."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="spark-colsense-"))
        base = _own[0]
    return f"{base.rstrip('/')}/t-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder, read again."""
    spark, path = df.sparkSession, shared_path(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str, rows: int = 100_000, of: DataFrame | None = None) -> DataFrame:
    """df dealt by a key over as many partitions as it, or the table `of` that it comes from, has times `rows` rows: what steps within a key take of a task's memory doesn't grow with df."""
    n = (df if of is None else of).count()
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n // rows)), key)
