"""Statements (s, p, o, o_kind) of ontologies as N-Triples lines, one statement a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"\S*)\s*\.\s*$'


def parsed(lines: DataFrame) -> DataFrame:
    """lines(value) -> (s, p, o, o_kind in uri, blank, literal). Blank lines, comments and broken lines give no row."""
    at = lambda i: F.regexp_extract("value", LINE, i)
    kind = F.when(at(3).startswith("<"), "uri").when(at(3).startswith("_:"), "blank").otherwise("literal")
    rows = lines.filter(F.col("value").rlike(LINE)).select(at(1).alias("s"), at(2).alias("p"), at(3).alias("o"), kind.alias("o_kind"))
    strip = lambda c: F.regexp_replace(c, "^<|>$", "")
    return rows.select(strip("s").alias("s"), "p", F.when(F.col("o_kind") == "literal", F.col("o")).otherwise(strip("o")).alias("o"), "o_kind")


def broken(lines: DataFrame) -> DataFrame:
    """Lines that are neither statements nor blank nor comments."""
    return lines.filter(~F.col("value").rlike(LINE) & ~F.col("value").rlike(r"^\s*(#.*)?$"))


def read(spark: SparkSession, path: str) -> DataFrame:
    return parsed(spark.read.text(path))


def lines(statements: DataFrame) -> DataFrame:
    """Statements as lines (value), ready for write.text."""
    term = lambda c: F.when(F.col(c).startswith("_:"), F.col(c)).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    o = F.when(F.col("o_kind") == "uri", F.concat(F.lit("<"), "o", F.lit(">"))).otherwise(F.col("o"))
    return statements.select(F.concat(term("s"), F.lit(" <"), "p", F.lit("> "), o, F.lit(" .")).alias("value"))
