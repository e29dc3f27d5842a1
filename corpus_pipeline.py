"""The corpus pipeline: quality filter, exact and near-duplicate removal, source mix, packing. Part of colsense.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colsense.llm.common import written
from colsense.llm.exact_dedup import without_copies
from colsense.llm.jaccard import one_of_each
from colsense.llm.mixing import mixed
from colsense.llm.packing import pack, vocabulary
from colsense.llm.quality import of_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Null, empty and blank texts are judged by the bias, repeated rows alike, null ids like others. Any columns are kept.
    """
    return of_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text, white space aside: the smallest doc_id, nulls last, then the smallest place. Null texts are empty ones."""
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles agree by 0.8 or more: the smallest doc_id, nulls last.

    Null, empty and blank texts link with nothing and stay; of rows that repeat id and words one stays.
    """
    return one_of_each(docs, 5, 80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 3 times. Null texts have no words; null is the last source; a source of nothing takes nothing."""
    return mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences of 4,096 tokens. A null or empty text is its end token; repeated rows are packed as often as they come."""
    return pack(docs, vocabulary())


STAGES = [("quality", quality), ("exact_dedup", exact), ("ngram_jaccard", near), ("source_mix", mix), ("best_fit_packing", packed)]

#: SQL can't express the stages (a trained classifier, balanced sampling, a linear program). tests/llm/test_pipeline.py
#: holds each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; an empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
