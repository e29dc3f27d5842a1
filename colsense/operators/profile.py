"""Column features. All run on value counts, (column_id, value) -> cnt, so that cells are read and shuffled once.

A value is missing if null or blank. Shares are 0 where there is nothing to divide by. Character classes are ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written
from .ranks import by_histogram

#: Types of columns by the pattern that all their values fit, first match first.
PATTERNS = (
    ("integer", r"^[+-]?[0-9]+$"),
    ("float", r"^[+-]?([0-9]+\.[0-9]*|\.?[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("boolean", r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9:.]+)?$"),
)
RANGE = r"^[ \t\n\r]*[0-9.]+[ \t\n\r]*-[ \t\n\r]*[0-9.]+[ \t\n\r]*$"


def value_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("column_id", "value").agg(F.count("*").alias("cnt"))


#: What features need to know of a value, besides which values are equal.
FACTS = {
    "missing": lambda v: v.isNull() | v.rlike(r"^[ \t\n\r]*$"),
    "has_at": lambda v: F.contains(v, F.lit("@")),
    "has_hyphen": lambda v: F.contains(v, F.lit("-")),
    "is_range": lambda v: v.rlike(RANGE),
    "n_chars": lambda v: F.length(v),
    "n_letters": lambda v: F.regexp_count(v, F.lit("[A-Za-z]")),
    "n_digits": lambda v: F.regexp_count(v, F.lit("[0-9]")),
    "n_spaces": lambda v: F.regexp_count(v, F.lit(r"[ \t\n\r]")),
    **{f"fits_{k}": lambda v, p=p: v.rlike(p) for k, p in PATTERNS},
    "number": lambda v: F.when(v.rlike(PATTERNS[0][1]) | v.rlike(PATTERNS[1][1]), v.cast("double")),
    "exact": lambda v: F.when(v.rlike(PATTERNS[0][1]) | v.rlike(PATTERNS[1][1]), v.try_cast("decimal(24,6)")),
}


def digested_counts(cells: DataFrame, longest: int = 256) -> DataFrame:
    """(column_id, value, hashed, cnt, facts ..): value counts for columns of long texts, which the passes take like others.

    Values of more than `longest` bytes are counted by their SHA-256, as hex, and are `hashed`; FACTS are taken where a cell is
    read. So a distinct text costs some 150 bytes of shuffle, however long it is, and all features but those of characters
    stay exact. These add up over cells: `char_counts` of the cells themselves gives them without any values.
    """
    v = F.col("value")
    hashed = F.coalesce(F.octet_length(v) > longest, F.lit(False))
    told = cells.select("column_id", F.when(hashed, F.sha2(v, 256)).otherwise(v).alias("value"), hashed.alias("hashed"), *[f(v).alias(k) for k, f in FACTS.items()])
    return told.groupBy("column_id", "value", "hashed").agg(F.count("*").alias("cnt"), *[F.first(k).alias(k) for k in FACTS])


def merged(*counts: DataFrame) -> DataFrame:
    """Value counts of several arrivals as those of all: whatever is computed from them is exact, without a cell read again.

    All are value_counts, or all are digested_counts with the same `longest`.
    """
    names = counts[0].columns
    keys, facts = [k for k in ("column_id", "value", "hashed") if k in names], [k for k in FACTS if k in names]
    out = counts[0].select(*keys, "cnt", *facts)
    for c in counts[1:]:
        out = out.union(c.select(*keys, "cnt", *facts))
    return out.groupBy(*keys).agg(F.sum("cnt").alias("cnt"), *[F.first(k).alias(k) for k in facts])


def _of(counts: DataFrame, fact: str) -> Column:
    """A fact of the values in counts: told by digested_counts, or taken from the value."""
    return F.col(fact) if fact in counts.columns else FACTS[fact](F.col("value"))


def of_whole(counts: DataFrame) -> DataFrame:
    if "hashed" in counts.columns:
        raise ValueError("characters aren't in digested counts: take char_counts of the cells")
    return counts


def share(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.round(F.when(whole == 0, F.lit(0.0)).otherwise(part / whole), digits)


def basic(counts: DataFrame, discrete: float = 0.3) -> DataFrame:
    """Distinct, missing and pattern shares, discreteness and value entropy of each column."""
    have = ~_of(counts, "missing")
    n = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("cnt"))), F.lit(0))
    out = counts.groupBy("column_id").agg(
        F.sum("cnt").alias("n_rows"), n(have).alias("present"), F.count(F.when(have, 1)).alias("num_unique_vals"),
        n(_of(counts, "has_at")).alias("at"), n(_of(counts, "has_hyphen")).alias("hyphen"), n(_of(counts, "is_range")).alias("range"),
        F.coalesce(F.sum(F.when(have, F.col("cnt") * F.log2("cnt"))), F.lit(0.0)).alias("clogc"))
    unique = F.col("num_unique_vals") / F.col("present")
    is_discrete = F.when((F.col("present") > 0) & (unique <= discrete), 1).otherwise(0)
    entropy = F.when(F.col("present") == 0, F.lit(0.0)).otherwise(F.log2("present") - F.col("clogc") / F.col("present"))
    return out.select(
        "column_id", "n_rows", "num_unique_vals", share(F.col("num_unique_vals"), F.col("present")).alias("prop_unique_vals"),
        share(F.col("n_rows") - F.col("present"), F.col("n_rows")).alias("prop_missing_vals"), share(F.col("at"), F.col("present")).alias("prop_entries_with_at_sign"),
        share(F.col("hyphen"), F.col("present")).alias("prop_entries_with_hyphen"), share(F.col("range"), F.col("present")).alias("prop_range_format"),
        is_discrete.alias("is_discrete"), F.round(F.when(is_discrete == 1, entropy).otherwise(0.0), 6).alias("entropy_for_discrete_values"))


def chars(counts: DataFrame) -> DataFrame:
    """Shares of letters, digits and white space among all characters of a column."""
    n = lambda fact, name: F.coalesce(F.sum(_of(counts, fact).cast("long") * F.col("cnt")), F.lit(0)).alias(name)
    out = counts.groupBy("column_id").agg(n("n_chars", "n"), n("n_letters", "a"), n("n_digits", "d"), n("n_spaces", "w"))
    return out.select("column_id", share(F.col("a"), F.col("n")).alias("ratio_alpha_chars"), share(F.col("d"), F.col("n")).alias("prop_numerical_chars"), share(F.col("w"), F.col("n")).alias("prop_whitespace_chars"))


def char_counts(counts: DataFrame) -> DataFrame:
    """(column_id, ch, n): printable ASCII characters of each column, from its value counts or, if there is no cnt, its cells."""
    cnt = F.col("cnt") if "cnt" in counts.columns else F.lit(1).cast("long").alias("cnt")
    ch = of_whole(counts).select("column_id", cnt, F.explode(F.split("value", "")).alias("ch"))
    return ch.filter(F.col("ch").between(" ", "~")).groupBy("column_id", "ch").agg(F.sum("cnt").alias("n"))


def char_distribution(counts: DataFrame) -> DataFrame:
    """Shares of characters, from value counts or cells."""
    n = char_counts(counts)
    total = Window.partitionBy("column_id")  # at most 95 rows
    return n.select("column_id", "ch", share(F.col("n"), F.sum("n").over(total)).alias("share"))


def char_entropy(counts: DataFrame) -> DataFrame:
    """Entropy of characters, from value counts or cells."""
    out = char_counts(counts).groupBy("column_id").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log2("n")).alias("s"))
    return out.select("column_id", F.round(F.log2("t") - F.col("s") / F.col("t"), 6).alias("shannon_entropy"))


def value_entropy(counts: DataFrame) -> DataFrame:
    out = counts.groupBy("column_id").agg(F.sum("cnt").alias("t"), F.sum(F.col("cnt") * F.log2("cnt")).alias("s"))
    return out.select("column_id", F.round(F.log2("t") - F.col("s") / F.col("t"), 6).alias("value_entropy"))


def inferred_types(counts: DataFrame) -> DataFrame:
    """The first type of PATTERNS that all present values fit; string if none or if nothing is present."""
    kept = counts.groupBy("column_id").agg(*[F.bool_and(F.when(~_of(counts, "missing"), _of(counts, f"fits_{k}"))).alias(k) for k, _ in PATTERNS])
    kind = F.coalesce(*[F.when(F.col(k), F.lit(k)) for k, _ in PATTERNS], F.lit("string"))
    return kept.select("column_id", kind.alias("logical_type"))


def type_flags(types: DataFrame) -> DataFrame:
    """inferred_types as a group of 0 / 1 features, one of which is 1."""
    return types.select("column_id", *[F.when(F.col("logical_type") == k, 1).otherwise(0).alias(f"is_{k}") for k in (*(k for k, _ in PATTERNS), "string")])


def _five(rows: DataFrame, x: str) -> DataFrame:
    """Weighted mean, exact median, mode (least on ties), least and greatest of x; rows(column_id, cnt, x, exact): x as a
    decimal of six digits, null where it isn't one.

    Means are rounded half up from exact sums of millionths; a column with values that have no such decimal is summed in
    doubles. The median is found by histograms of ranges (by_histogram): no column's values are gathered or sorted.
    """
    by = written(rows.groupBy("column_id", x).agg(F.sum("cnt").alias("cnt"), F.first("exact").alias("exact")))
    n = F.sum("cnt")
    whole = F.sum((F.col("exact") * F.col("cnt").cast("decimal(13,0)")).cast("decimal(38,6)"))
    five = by.groupBy("column_id").agg(
        n.alias("t"), whole.alias("s"), F.count_if(F.col("exact").isNull()).alias("inexact"), F.sum(F.col(x) * F.col("cnt")).alias("d"),
        F.max_by(x, F.struct("cnt", -F.col(x))).cast("double").alias("mode"), F.min(x).cast("double").alias("least"), F.max(x).cast("double").alias("greatest"))
    # floor((2 s + t) / (2 t)) of s millionths
    top, low = (2 * (F.col("s") * 1_000_000).cast("decimal(38,0)") + F.col("t")).cast("decimal(38,0)"), (2 * F.col("t")).cast("decimal(20,0)")
    five = five.withColumn("top", top).withColumn("low", low)
    down = F.expr("top div low") - F.when((F.col("top") < 0) & (F.col("top") % F.col("low") != 0), 1).otherwise(0)
    mean = F.when(F.col("inexact") == 0, down / 1e6).otherwise(F.round(F.col("d") / F.col("t"), 6))
    five = written(five)
    halves = five.select("column_id", F.explode(F.array_distinct(F.array(F.floor((F.col("t") + 1) / 2), F.floor(F.col("t") / 2) + 1))).alias("at"))
    found = by_histogram(by.withColumn(x, F.col(x).cast("double")), "column_id", x, "cnt", halves)
    median = found.groupBy("column_id").agg(F.round((F.min("found") + F.max("found")) / 2, 6).alias("median"))
    return five.join(median, "column_id").select("column_id", mean.alias("mean"), "median", "mode", "least", "greatest")


def text_length(counts: DataFrame) -> DataFrame:
    rows = counts.filter("value IS NOT NULL").select("column_id", "cnt", _of(counts, "n_chars").alias("x"))
    return _five(rows.withColumn("exact", F.col("x").cast("decimal(24,6)")), "x")


def numeric(counts: DataFrame) -> DataFrame:
    """The same five over values that are numbers by pattern."""
    rows = counts.select("column_id", "cnt", _of(counts, "number").alias("x"), _of(counts, "exact").alias("exact"))
    return _five(rows.filter("x IS NOT NULL"), "x")


#: Names of features by the pass over value counts that computes them, and the groups that stand for several names.
PASSES = {
    "basic": (basic, ("num_unique_vals", "prop_unique_vals", "prop_missing_vals", "prop_entries_with_at_sign", "prop_entries_with_hyphen", "prop_range_format", "is_discrete", "entropy_for_discrete_values")),
    "chars": (chars, ("ratio_alpha_chars", "prop_numerical_chars", "prop_whitespace_chars")),
    "char_entropy": (char_entropy, ("shannon_entropy",)),
    "value_entropy": (value_entropy, ("value_entropy",)),
    "types": (lambda counts: type_flags(inferred_types(counts)), tuple(f"is_{k}" for k in (*(k for k, _ in PATTERNS), "string"))),
    "text_length": (text_length, tuple(f"text_length_{k}" for k in ("mean", "median", "mode", "least", "greatest"))),
    "numeric": (numeric, tuple(f"numeric_{k}" for k in ("mean", "median", "mode", "least", "greatest"))),
}
GROUPS = {"inferred_data_type": PASSES["types"][1], "stats_of_text_length": PASSES["text_length"][1], "stats_of_numeric_type": PASSES["numeric"][1]}


def selected(counts: DataFrame, active: list[str], groups: list[str] = (), cells: DataFrame | None = None) -> DataFrame:
    """(column_id, features ..): the active features and groups alone.

    Only the passes that compute one of them enter the plan, and of a pass only the aggregates that its active features
    need: optimisation prunes the others. A feature that a column lacks, such as a mean of numbers, is null. Unknown names
    are an error. Digested counts have no characters: for shannon_entropy they need the cells beside them.
    """
    names = [*active, *(n for g in groups for n in GROUPS[g])]
    known = {n for _, ns in PASSES.values() for n in ns}
    if wrong := sorted(set(names) - known):
        raise ValueError(f"no such features: {', '.join(wrong)}")
    out = counts.select("column_id").distinct()
    for kind, (f, ns) in PASSES.items():
        if mine := [n for n in ns if n in names]:
            given = cells if kind == "char_entropy" and cells is not None else counts
            out = out.join(f(given).select("column_id", *[F.col(n.removeprefix(f"{kind}_")).alias(n) for n in mine]), "column_id", "left")
    return out.select("column_id", *names)


def _numbered_folds(labelled: DataFrame) -> tuple[DataFrame, int]:
    """(fold, number) of each fold, and how many there are."""
    folds = written(labelled.select("fold").distinct().withColumn("number", F.row_number().over(Window.orderBy("fold")) - 1))  # as many rows as folds
    return folds, folds.count()


def _without_own(rows: DataFrame, folds: DataFrame, n: int) -> DataFrame:
    """rows once for each fold but their own: `fold` is the fold that leaves them in."""
    rows = rows.join(folds, "fold").withColumnRenamed("number", "own").drop("fold")
    return rows.withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))).filter("own <> number").join(folds, "number").drop("own", "number")


#: Every column meets every class: both sides are dealt by one of these numbers, so that a key is neither a character nor a class.
SALTS = 32


def class_cosine_by_fold(counts: DataFrame, labelled: DataFrame) -> DataFrame:
    """(fold, column_id, label, mean_cosine): a column's mean cosine to other labelled columns of a class, those of the fold left out.

    labelled(column_id, label or null, fold). Sums of unit vectors by class, less the fold's own and the column's own, give
    the means: no pair of columns is formed, and no label of a fold reaches the features that are tested on it.
    """
    n = written(char_counts(counts)).select("column_id", "ch", F.col("n").cast("double").alias("n"))
    norm = n.groupBy("column_id").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    n = n.join(norm, "column_id").select("column_id", "ch", (F.col("n") / F.col("norm")).alias("n"))
    known = labelled.filter("label IS NOT NULL").join(norm.select("column_id"), "column_id", "left_semi")
    folds, k = _numbered_folds(labelled)
    per = written(n.join(known, "column_id").groupBy("label", "fold", "ch").agg(F.sum("n").alias("v")))
    sums = _without_own(per, folds, k).groupBy("fold", "label", "ch").agg(F.sum("v").alias("v"))
    sizes = _without_own(known.groupBy("label", "fold").agg(F.count("*").alias("size")), folds, k).groupBy("fold", "label").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dot = n.withColumn("salt", F.pmod(F.xxhash64("column_id"), F.lit(SALTS)).cast("int")).join(sums, ["salt", "ch"]).groupBy("fold", "column_id", "label").agg(F.sum(F.col("n") * F.col("v")).alias("dot"))
    own = known.select("column_id", "label", F.col("fold").alias("own"))
    every = norm.select("column_id", F.pmod(F.xxhash64("column_id"), F.lit(SALTS)).cast("int").alias("salt")).join(sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "salt").drop("salt")
    out = every.join(dot, ["fold", "column_id", "label"], "left").join(own, ["column_id", "label"], "left")
    mine = F.when(F.col("own") != F.col("fold"), 1).otherwise(0)  # the column is in the sum
    mean = (F.coalesce("dot", F.lit(0.0)) - mine) / (F.col("size") - mine)
    return out.filter(F.col("size") > mine).select("fold", "column_id", "label", (F.round(mean, 6) + 0.0).alias("mean_cosine"))


def knn_class_share_by_fold(pairs: DataFrame, labelled: DataFrame, k: int = 3) -> DataFrame:
    """(fold, column_id, label, share): knn_class_share among labelled columns outside the fold."""
    folds, n = _numbered_folds(labelled)
    known = _without_own(labelled.filter("label IS NOT NULL").select(F.col("column_id").alias("other"), "label", "fold"), folds, n)
    near = Window.partitionBy("fold", "column_id").orderBy(F.desc(F.round("cosine", 9)), "other")
    near = pairs.join(known, "other").withColumn("nth", F.row_number().over(near)).filter(F.col("nth") <= k)
    all_ = near.groupBy("fold", "column_id").agg(F.count("*").alias("t"))
    return near.groupBy("fold", "column_id", "label").agg(F.count("*").alias("n")).join(all_, ["fold", "column_id"]).select("fold", "column_id", "label", share(F.col("n"), F.col("t")).alias("share"))


def min_edit_distance_by_fold(samples: DataFrame, labelled: DataFrame, most: int = 5) -> DataFrame:
    """(fold, column_id, label, min_distance): min_edit_distance to examples of classes from columns outside the fold."""
    folds, n = _numbered_folds(labelled)
    mine = samples.filter(F.col("nth") <= most).select("column_id", "value")
    theirs = mine.join(labelled.filter("label IS NOT NULL"), "column_id").select(F.col("column_id").alias("other"), "label", "fold", F.col("value").alias("example"))
    first = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy("label", "fold").orderBy(F.md5(F.concat_ws("|", "other", "example")), "other", "example"))).filter(F.col("nth") <= most).drop("nth")
    theirs = first(_without_own(first(theirs), folds, n)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = mine.withColumn("salt", F.pmod(F.xxhash64("column_id"), F.lit(SALTS)).cast("int"))
    return mine.join(theirs, "salt").filter("column_id <> other").groupBy("fold", "column_id", "label").agg(F.min(F.levenshtein("value", "example")).alias("min_distance"))


def cosine_pairs(counts: DataFrame, labelled: DataFrame) -> DataFrame:
    """(column_id, other, cosine) of the character vectors of each column and each other labelled column."""
    n = written(char_counts(counts)).select("column_id", "ch", F.col("n").cast("double").alias("n"))  # a row per column and character
    norm = n.groupBy("column_id").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    n = n.join(norm, "column_id").select("column_id", "ch", (F.col("n") / F.col("norm")).alias("n"))
    other = n.join(labelled.select("column_id"), "column_id", "left_semi").select(F.col("column_id").alias("other"), "ch", F.col("n").alias("m"))
    return n.join(other, "ch").filter("column_id <> other").groupBy("column_id", "other").agg(F.sum(F.col("n") * F.col("m")).alias("cosine"))


def class_cosine(pairs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Mean cosine of each column to the labelled columns of each class."""
    known = labelled.select(F.col("column_id").alias("other"), "label")
    return pairs.join(known, "other").groupBy("column_id", "label").agg(F.round(F.avg("cosine"), 6).alias("mean_cosine"))


def knn_class_share(pairs: DataFrame, labelled: DataFrame, k: int = 3) -> DataFrame:
    """Share of each class among the k labelled columns nearest by cosine (ties to the smaller id)."""
    order = Window.partitionBy("column_id").orderBy(F.desc(F.round("cosine", 9)), "other")
    near = pairs.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
    all_ = near.groupBy("column_id").agg(F.count("*").alias("t"))
    near = near.join(labelled.select(F.col("column_id").alias("other"), "label"), "other").groupBy("column_id", "label").agg(F.count("*").alias("n"))
    return near.join(all_, "column_id").select("column_id", "label", share(F.col("n"), F.col("t")).alias("share"))


def min_edit_distance(samples: DataFrame, labelled: DataFrame, most: int = 5) -> DataFrame:
    """Least Levenshtein distance of up to `most` sampled values of a column and of each class's other columns."""
    mine = samples.filter(F.col("nth") <= most).select("column_id", "value")
    theirs = mine.join(labelled, "column_id").select(F.col("column_id").alias("other"), "label", F.col("value").alias("example"))
    order = Window.partitionBy("label").orderBy(F.md5(F.concat_ws("|", "other", "example")), "other", "example")
    theirs = theirs.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).select("other", "label", "example")
    # both sides are samples of fixed size per column and class
    return mine.join(F.broadcast(theirs), F.col("column_id") != F.col("other")).groupBy("column_id", "label").agg(F.min(F.levenshtein("value", "example")).alias("min_distance"))
