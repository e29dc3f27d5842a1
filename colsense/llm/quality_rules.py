"""Operator 13: quality rules, line by line first. Spark's own functions only; a row never leaves its task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_RE, WORD_RE, fresh, text_or_empty

SYMBOLS = r"[#*$%&|<>]"
#: Words of a window that counts as repeated, fewest words of a document, and the most percent of words in repeated windows.
WINDOW, FEWEST, MOST_REPEATED = 8, 20, 30
#: Percent of a document's characters that its lines may lose.
MOST_LOST = 50

# What ends a sentence, what parts the items of a menu, and phrases of legal and site text.
ENDS = r"[.!?…。！？]"
MENU = r"[|•·»›]"
PHRASES = (
    "all rights reserved", "copyright (c)", "licensed under", "released under", "privacy policy", "cookie policy", "terms of use", "terms of service", "terms and conditions",
    "use cookies", "enable javascript", "lorem ipsum", "sign up for our", "subscribe to our", "click here", "powered by",
)
PLACES = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "contact", "about", "next", "previous", "back", "top", "sitemap", "share", "print")


def let(value: Column, f) -> Column:
    """f(value), with value evaluated once however often f names it."""
    return F.transform(F.array(value), f)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_RE), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_RE))


def _repeated(w: Column, n: int) -> Column:
    """repeated_words of a text's words.

    Windows are hashed within the row. Where all hashes differ, no window is repeated; else they are sorted by hash and
    place, and neighbours of one hash are compared word by word.
    """
    span = F.sequence(F.lit(1), F.size(w) - n + 1)
    hashes = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(span, lambda i: F.xxhash64(F.slice(h, i, n))))

    def twice(s: Column) -> Column:
        same = lambda x, y: (x["h"] == y["h"]) & (F.slice(w, x["i"], n) == F.slice(w, y["i"], n))
        return F.filter(s, lambda x, k: F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)))

    def count(h: Column) -> Column:
        windows = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), (i + 1).alias("i"))))
        places = F.sort_array(F.transform(let(windows, twice), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last"))
        add = lambda a, i: F.struct((a["n"] + F.least(F.lit(n), i - a["last"])).alias("n"), i.alias("last"))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), F.aggregate(places, start, add, lambda a: a["n"])).otherwise(F.lit(0))

    return F.when(F.size(w) > n, let(hashes, count)).otherwise(F.lit(0))


def repeated_words(text: Column, n: int = WINDOW) -> Column:
    """Words that lie in windows of n words which the text has twice or more."""
    return let(words(text), lambda w: _repeated(w, n))


def lines(text: Column) -> Column:
    """The text's lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_RE))


_PHRASE, _PLACE = "|".join(p.replace("(", r"\(").replace(")", r"\)") for p in PHRASES), "|".join(PLACES)
_CLOSED = ENDS + r"""["')\]»”]*(?:[\x20\x09-\x0D]|$)"""
_MARKS = r"[#*$%&<>]+|!{2,}|\?{2,}"
_MENU = rf"(?i)^[\x20\x09-\x0D]*(?:{_PLACE})(?:[\x20\x09-\x0D]+(?:{_PLACE}))*[\x20\x09-\x0D]*$"
SHORT = 160


def punctuation_fails(line: Column, marked: Column) -> Column:
    """Six words or more without an end of a sentence, or with symbols or repeated marks on a third of the words."""
    return ~line.rlike(_CLOSED) & (n_words(line) >= 6) | marked & line.rlike(_MARKS) & (3 * F.regexp_count(line, F.lit(_MARKS)) >= n_words(line))


def navigation_fails(line: Column, marked: Column) -> Column:
    """A menu: at least one separator for every seven words, or nothing but names of a site's places."""
    return marked & line.rlike(MENU) & (7 * F.regexp_count(line, F.lit(MENU)) >= n_words(line)) | line.rlike(_MENU)


def boilerplate_fails(line: Column) -> Column:
    """At most SHORT characters with a phrase of legal or site text."""
    return (F.length(line) <= SHORT) & F.lower(line).rlike(_PHRASE)


def ruled(text: Column) -> Column:
    """The text's lines that have a word, each with the rules that it fails: an array of (line, punctuation, navigation, boilerplate)."""

    def f(marked: Column) -> Column:  # whether any line can have marks or separators
        return F.transform(lines(text), lambda line: F.struct(
            line.alias("line"), punctuation_fails(line, marked).alias("punctuation"), navigation_fails(line, marked).alias("navigation"), boilerplate_fails(line).alias("boilerplate")))

    return let(text.rlike(rf"{_MARKS}|{MENU}"), f)


def kept_lines(ruled_: Column) -> Column:
    """Lines that no rule removes, in order; of equal lines the first."""
    return F.array_distinct(F.transform(F.filter(ruled_, lambda x: ~(x["punctuation"] | x["navigation"] | x["boilerplate"])), lambda x: x["line"]))


def _chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE_RE, "")).cast("long")


def judged(docs: DataFrame, most_lost: int = MOST_LOST) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and what the lines' rules found.

    Each line with a word is held against three rules: punctuation, navigation and boilerplate. Failing lines go, and
    equal lines but the first. A document is kept unless base_failed, or its lines lost more than most_lost percent of its
    characters (white space aside).

    One row per input row, repeated rows alike; null and blank texts have no words and so fail, an empty table gives no
    rows; other columns are ignored. Texts of any length are taken whole, in one row: a text's words and their windows
    take some 150 bytes a word in its task.
    """
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))

    def of_lines(x: Column) -> Column:
        count = lambda rule: F.size(F.filter(x, lambda y: y[rule])).alias(f"{rule}_lines")
        every = F.transform(x, lambda y: y["line"])
        return F.struct(
            F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(every))).cast("long").alias("n_dup_lines"), count("punctuation"), count("navigation"), count("boilerplate"),
            _chars(F.array_join(kept_lines(x), "")).alias("kept_chars"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeated(w, WINDOW).cast("long").alias("n_repeat_words"))

    t = F.col("text")
    found = rows.select("doc_id", F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), let(ruled(t), of_lines).alias("l"), let(words(t), of_words).alias("w"))
    found = found.select("doc_id", "w.*", "n_symbols", "l.*")
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    lost = 100 * (F.col("word_chars") - F.col("kept_chars")) > most_lost * F.col("word_chars")
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~lost).alias("kept"),
        "kept_chars", "n_lines", "punctuation_lines", "navigation_lines", "boilerplate_lines")


def cleaned(docs: DataFrame, most_lost: int = MOST_LOST) -> DataFrame:
    """Documents that judged() keeps, with all their columns, their texts cut to the lines that no rule removes."""
    text = text_or_empty()
    mark = fresh(docs, "_clean")
    clean = F.array_join(let(ruled(text), kept_lines), "\n")
    failed = (n_words(text) < FEWEST) | (100 * repeated_words(text) > MOST_REPEATED * n_words(text))
    rows = docs.withColumn(mark, F.when(~failed, clean))
    lost = 100 * (_chars(text) - _chars(F.col(mark))) > most_lost * _chars(text)
    out = rows.filter(F.col(mark).isNotNull() & ~lost)
    return out.select(*[F.col(mark).alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns])


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


_W = r"[^\x20\x09-\x0D]+"
_BAR, _LOOSE = r"[|\x{2022}\x{B7}\x{BB}\x{203A}]", r"[.!?\x{2026}\x{3002}\x{FF01}\x{FF1F}]" + r"""["'')\]\x{BB}\x{201D}]*(?:[\x20\x09-\x0D]|$)"""

SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{_W}') AS w FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
p AS (SELECT doc_id, sum(least({WINDOW}, i - last)) AS n FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -{WINDOW}) AS last FROM r) GROUP BY 1),
l AS (SELECT doc_id, k, line, len(regexp_extract_all(line, '{_W}')) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d) WHERE regexp_matches(line, '{_W}')),
f AS (SELECT *, (n >= 6 AND NOT regexp_matches(line, '{_LOOSE}')) OR (3 * len(regexp_extract_all(line, '{_MARKS}')) >= n AND regexp_matches(line, '{_MARKS}')) AS pu,
 (regexp_matches(line, '{_BAR}') AND 7 * len(regexp_extract_all(line, '{_BAR}')) >= n) OR regexp_matches(line, '{_MENU}') AS na,
 length(line) <= {SHORT} AND regexp_matches(lower(line), '{_PHRASE}') AS bo FROM l),
c AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (pu) AS pu, count(*) FILTER (na) AS na, count(*) FILTER (bo) AS bo FROM f GROUP BY 1),
k AS (SELECT doc_id, sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS kept FROM (SELECT DISTINCT doc_id, line FROM f WHERE NOT (pu OR na OR bo)) GROUP BY 1),
a AS (SELECT d.doc_id, len(w.w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
 coalesce(p.n, 0) AS n_repeat_words, coalesce(kept, 0) AS kept_chars, coalesce(n_lines, 0) AS n_lines, coalesce(pu, 0) AS punctuation_lines, coalesce(na, 0) AS navigation_lines, coalesce(bo, 0) AS boilerplate_lines
 FROM d JOIN w USING (doc_id) LEFT JOIN p USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
 n_words < {FEWEST} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed, NOT (n_words < {FEWEST} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words OR 100 * (word_chars - kept_chars) > {MOST_LOST} * word_chars) AS kept,
 CAST(kept_chars AS BIGINT) AS kept_chars, CAST(n_lines AS INTEGER) AS n_lines, CAST(punctuation_lines AS INTEGER) AS punctuation_lines, CAST(navigation_lines AS INTEGER) AS navigation_lines, CAST(boilerplate_lines AS INTEGER) AS boilerplate_lines FROM a
"""
