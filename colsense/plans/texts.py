"""Queries on the columns of tables with long texts, profiled by digests, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile
from ..sources import tables
from ..sources.store import shared_path
from ..sources.tables import table
from .base import SQL, query
from .columns import CELLS, VC, cells_sql

TEXTS = {"documents": "doc_id text lang source n_chars", "pages": "page_id url html", "conversations": "conv_id turn role text", "benchmark": "item_id text"}


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return tables.all_cells({t: table(spark, d, t).select(*names.split()) for t, names in TEXTS.items()})


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.digested_counts(_cells(spark, d))


def _of_texts(name: str) -> str:
    """The SQL of a query on the other tables, on these, over whole values."""
    return SQL[name].replace(CELLS, cells_sql(TEXTS))


@query(f"WITH {VC} SELECT column_id, CASE WHEN strlen(value) > 256 THEN sha256(value) ELSE value END AS value, coalesce(strlen(value) > 256, false) AS hashed, cnt FROM vc".replace(CELLS, cells_sql(TEXTS)))
def text_counts(spark, d):
    """Value counts that hold long values by their digests."""
    return _counts(spark, d).select("column_id", "value", "hashed", "cnt")


@query(_of_texts("profile_basic"))
def text_profile_basic(spark, d):
    return profile.basic(_counts(spark, d))


@query(_of_texts("profile_chars"))
def text_profile_chars(spark, d):
    return profile.chars(_counts(spark, d))


@query(_of_texts("infer_types"))
def text_types(spark, d):
    return profile.inferred_types(_counts(spark, d))


@query(_of_texts("profile_text_length"))
def text_lengths(spark, d):
    return profile.text_length(_counts(spark, d))


@query(_of_texts("profile_numeric"))
def text_numbers(spark, d):
    return profile.numeric(_counts(spark, d))


@query(_of_texts("value_entropy"))
def text_value_entropy(spark, d):
    return profile.value_entropy(_counts(spark, d))


@query(_of_texts("char_distribution"))
def text_char_distribution(spark, d):
    """Shares of characters, straight from the cells: no value is counted or moved."""
    return profile.char_distribution(_cells(spark, d))


@query(f"WITH b AS ({_of_texts('profile_basic')}), e AS ({_of_texts('char_entropy')}), l AS ({_of_texts('profile_text_length')}) SELECT column_id, prop_unique_vals, shannon_entropy, mean AS text_length_mean, median AS text_length_median, mode AS text_length_mode, least AS text_length_least, greatest AS text_length_greatest FROM b LEFT JOIN e USING (column_id) LEFT JOIN l USING (column_id)")
def text_chosen_features(spark, d):
    """Features of a chosen set, of which one needs the cells' characters."""
    return profile.selected(_counts(spark, d), ["prop_unique_vals", "shannon_entropy"], ["stats_of_text_length"], _cells(spark, d))


@query(f"SELECT * FROM ({_of_texts('profile_basic')}) WHERE column_id LIKE '%@documents'")
def merged_text_basic(spark, d):
    """Shares of the columns of documents, from stored counts of two arrivals that hold no long text."""
    arrived = []
    for odd in (0, 1):
        part = table(spark, d, "documents").filter(F.pmod("doc_id", F.lit(2)) == odd).select(*TEXTS["documents"].split())
        path = shared_path(spark)
        profile.digested_counts(tables.cells(part, "documents")).write.parquet(path)
        arrived.append(spark.read.parquet(path))
    return profile.basic(profile.merged(*arrived))
