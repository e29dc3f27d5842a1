"""Queries on columns: their cells, features, metrics, samples and bags, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import uris
from ..operators import metrics, nearest, profile, sampling
from ..sources import tables
from ..sources.store import dealt, written
from ..sources.tables import PROFILED, table
from .base import query

def _counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(tables.all_cells({t: table(spark, d, t) for t in PROFILED}))


#: Columns of the profiled tables, for SQL.
COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "nation": "n_nationkey n_name n_regionkey",
    "region": "r_regionkey r_name",
}


def cells_sql(columns: dict[str, str]) -> str:
    parts = [f"SELECT '{t}' AS ds, '{c}' AS name, CAST({c} AS VARCHAR) AS value FROM {t}" for t, cs in columns.items() for c in cs.split()]
    return "cells AS (" + " UNION ALL ".join(parts) + ")"


CELLS = cells_sql(COLUMNS)
VC = CELLS + ", vc AS (SELECT name || '@' || ds AS column_id, value, count(*) AS cnt FROM cells GROUP BY ALL)"
MISSING = r"(value IS NULL OR regexp_full_match(value, '[ \t\n\r]*'))"
CHARS = VC + ", ch AS (SELECT column_id, unnest(regexp_extract_all(value, '[ -~]')) AS ch, cnt FROM vc), cc AS (SELECT column_id, ch, CAST(sum(cnt) AS BIGINT) AS n FROM ch GROUP BY ALL)"


@query(f"WITH {VC} SELECT column_id, CAST(sum(cnt) AS BIGINT) AS n_cells, CAST(sum(CASE WHEN value IS NULL THEN cnt ELSE 0 END) AS BIGINT) AS n_null, CAST(sum(length(value) * cnt) AS BIGINT) AS n_chars FROM vc GROUP BY 1")
def cells_unpivot(spark, d):
    cells = tables.all_cells({t: table(spark, d, t) for t in PROFILED})
    return cells.groupBy("column_id").agg(F.count("*").alias("n_cells"), F.count_if(F.col("value").isNull()).alias("n_null"), F.sum(F.length("value").cast("long")).alias("n_chars"))


@query(f"WITH {CELLS} SELECT ds AS dataset_id, name || '@' || ds AS column_id, name, count(*) AS size FROM cells GROUP BY ALL")
def column_catalog(spark, d):
    return tables.column_catalog({t: table(spark, d, t) for t in PROFILED}).select("dataset_id", "column_id", "name", "size")


@query(f"WITH {CELLS}, c AS (SELECT ds, name, count(*) AS size FROM cells GROUP BY ALL) SELECT ds AS dataset_id, max(size) AS n_rows, count(*) AS n_cols FROM c GROUP BY 1")
def dataset_summary(spark, d):
    return tables.dataset_summary(tables.column_catalog({t: table(spark, d, t) for t in PROFILED}))


@query(f"WITH {VC} SELECT column_id, value, cnt FROM vc")
def value_counts(spark, d):
    return _counts(spark, d)


@query(rf"""WITH {VC}, a AS (SELECT column_id, sum(cnt) AS n_rows, coalesce(sum(cnt) FILTER (NOT {MISSING}), 0) AS present,
 count(*) FILTER (NOT {MISSING}) AS u, coalesce(sum(cnt) FILTER (contains(value, '@')), 0) AS n_at, coalesce(sum(cnt) FILTER (contains(value, '-')), 0) AS hy,
 coalesce(sum(cnt) FILTER (regexp_full_match(value, '[ \t\n\r]*[0-9.]+[ \t\n\r]*-[ \t\n\r]*[0-9.]+[ \t\n\r]*')), 0) AS rg,
 coalesce(sum(cnt * log2(cnt)) FILTER (NOT {MISSING}), 0) AS cl FROM vc GROUP BY 1),
b AS (SELECT *, CASE WHEN present > 0 AND u / present <= 0.3 THEN 1 ELSE 0 END AS is_discrete FROM a)
SELECT column_id, CAST(n_rows AS BIGINT) AS n_rows, u AS num_unique_vals, round(CASE WHEN present = 0 THEN 0 ELSE u / present END, 6) AS prop_unique_vals,
 round(CASE WHEN n_rows = 0 THEN 0 ELSE (n_rows - present) / n_rows END, 6) AS prop_missing_vals, round(CASE WHEN present = 0 THEN 0 ELSE n_at / present END, 6) AS prop_entries_with_at_sign,
 round(CASE WHEN present = 0 THEN 0 ELSE hy / present END, 6) AS prop_entries_with_hyphen, round(CASE WHEN present = 0 THEN 0 ELSE rg / present END, 6) AS prop_range_format,
 is_discrete, round(CASE WHEN is_discrete = 1 THEN log2(present) - cl / present ELSE 0 END, 6) AS entropy_for_discrete_values FROM b""")
def profile_basic(spark, d):
    return profile.basic(_counts(spark, d))


_n = lambda p: f"sum((length(value) - length(regexp_replace(value, '{p}', '', 'g'))) * cnt)"


@query(rf"""WITH {VC}, a AS (SELECT column_id, coalesce(sum(length(value) * cnt), 0) AS n, coalesce({_n('[A-Za-z]')}, 0) AS a, coalesce({_n('[0-9]')}, 0) AS d, coalesce({_n(r'[ \t\n\r]')}, 0) AS w FROM vc GROUP BY 1)
SELECT column_id, round(CASE WHEN n = 0 THEN 0 ELSE a / n END, 6) AS ratio_alpha_chars, round(CASE WHEN n = 0 THEN 0 ELSE d / n END, 6) AS prop_numerical_chars, round(CASE WHEN n = 0 THEN 0 ELSE w / n END, 6) AS prop_whitespace_chars FROM a""")
def profile_chars(spark, d):
    return profile.chars(_counts(spark, d))


def _five_sql(source: str) -> str:
    return f"""{source}, y AS (SELECT column_id, x, sum(cnt) AS c, any_value(e) AS e FROM x GROUP BY ALL),
 z AS (SELECT *, sum(c) OVER (PARTITION BY column_id ORDER BY x) AS hi, sum(c) OVER (PARTITION BY column_id) AS t FROM y),
 g AS (SELECT column_id, sum(CAST(e * 1000000 AS HUGEINT) * CAST(c AS HUGEINT)) AS s, CAST(max(t) AS HUGEINT) AS t, count(*) FILTER (e IS NULL) AS inexact, sum(x * c) AS d,
 round((min(x) FILTER (hi >= floor((t + 1) / 2)) + min(x) FILTER (hi >= floor(t / 2) + 1)) / 2, 6) AS median,
 CAST(arg_min(x, (-c, x)) AS DOUBLE) AS mode, CAST(min(x) AS DOUBLE) AS least, CAST(max(x) AS DOUBLE) AS greatest FROM z GROUP BY 1),
 h AS (SELECT *, CAST(2 * CAST(s AS HUGEINT) + t AS HUGEINT) AS top, 2 * t AS low FROM g)
SELECT column_id, CASE WHEN inexact = 0 THEN CAST((top // low) - CASE WHEN top < 0 AND top % low <> 0 THEN 1 ELSE 0 END AS DOUBLE) / 1e6 ELSE round(d / t, 6) END AS mean, median, mode, least, greatest FROM h"""


@query(_five_sql(f"WITH {VC}, x AS (SELECT column_id, length(value) AS x, cnt, CAST(length(value) AS DECIMAL(24,6)) AS e FROM vc WHERE value IS NOT NULL)"))
def profile_text_length(spark, d):
    return profile.text_length(_counts(spark, d))


@query(_five_sql(rf"WITH {VC}, x AS (SELECT column_id, CAST(value AS DOUBLE) AS x, cnt, TRY_CAST(value AS DECIMAL(24,6)) AS e FROM vc WHERE regexp_full_match(value, '[+-]?[0-9]+') OR regexp_full_match(value, '[+-]?([0-9]+\.[0-9]*|\.?[0-9]+)([eE][+-]?[0-9]+)?'))"))
def profile_numeric(spark, d):
    return profile.numeric(_counts(spark, d))


@query(rf"""WITH {VC}, a AS (SELECT column_id, bool_and(regexp_full_match(value, '[+-]?[0-9]+')) AS i, bool_and(regexp_full_match(value, '[+-]?([0-9]+\.[0-9]*|\.?[0-9]+)([eE][+-]?[0-9]+)?')) AS f,
 bool_and(regexp_full_match(value, '([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])')) AS b, bool_and(regexp_full_match(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9:.]+)?')) AS d FROM vc WHERE NOT {MISSING} GROUP BY 1)
SELECT c.column_id, CASE WHEN i THEN 'integer' WHEN f THEN 'float' WHEN b THEN 'boolean' WHEN d THEN 'date' ELSE 'string' END AS logical_type FROM (SELECT DISTINCT column_id FROM vc) c LEFT JOIN a USING (column_id)""")
def infer_types(spark, d):
    return profile.inferred_types(_counts(spark, d))


@query(f"WITH {VC} SELECT column_id, round(log2(sum(cnt)) - sum(cnt * log2(cnt)) / sum(cnt), 6) AS value_entropy FROM vc GROUP BY 1")
def value_entropy(spark, d):
    return profile.value_entropy(_counts(spark, d))


@query(f"WITH {CHARS} SELECT column_id, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS shannon_entropy FROM cc GROUP BY 1")
def char_entropy(spark, d):
    return profile.char_entropy(_counts(spark, d))


@query(f"WITH {CHARS} SELECT column_id, ch, round(n / sum(n) OVER (PARTITION BY column_id), 6) AS share FROM cc")
def char_distribution(spark, d):
    return profile.char_distribution(_counts(spark, d))


def _classes(spark, d) -> DataFrame:
    """Columns labelled by what their names say: key, name or other."""
    label = F.when(F.col("name").endswith("key"), "key").when(F.col("name").endswith("name"), "name").otherwise("other")
    return tables.column_names({t: table(spark, d, t) for t in PROFILED}).select("column_id", label.alias("label"))


COS = CHARS + """, nn AS (SELECT column_id, ch, CAST(n AS DOUBLE) / sqrt(sum(CAST(n AS DOUBLE) * n) OVER (PARTITION BY column_id)) AS n FROM cc),
 lab AS (SELECT DISTINCT column_id, CASE WHEN split_part(column_id, '@', 1) LIKE '%key' THEN 'key' WHEN split_part(column_id, '@', 1) LIKE '%name' THEN 'name' ELSE 'other' END AS label FROM vc),
 pr AS (SELECT a.column_id, b.column_id AS other, sum(a.n * b.n) AS cosine FROM nn a JOIN nn b ON a.ch = b.ch AND a.column_id <> b.column_id GROUP BY ALL)"""


@query(f"WITH {COS} SELECT pr.column_id, label, round(avg(cosine), 6) AS mean_cosine FROM pr JOIN lab ON other = lab.column_id GROUP BY ALL")
def char_cosine(spark, d):
    return profile.class_cosine(profile.cosine_pairs(_counts(spark, d), _classes(spark, d)), _classes(spark, d))


@query(f"""WITH {COS}, k AS (SELECT *, row_number() OVER (PARTITION BY column_id ORDER BY round(cosine, 9) DESC, other) AS nth FROM pr)
SELECT column_id, label, round(n / sum(n) OVER (PARTITION BY column_id), 6) AS share FROM (SELECT k.column_id, label, count(*) AS n FROM k JOIN lab ON other = lab.column_id WHERE nth <= 3 GROUP BY ALL)""")
def knn_class_share(spark, d):
    return profile.knn_class_share(nearest.nearest(nearest.vectors(_counts(spark, d)), _classes(spark, d), 3), _classes(spark, d))


def _of_suppliers(spark, d) -> DataFrame:
    """Value counts of the columns that each supplier's items make, as if a supplier were a dataset."""
    li = dealt(table(spark, d, "lineitem").select("l_suppkey", *_KEPT), "l_suppkey")  # cells are made, and counted, where a supplier's items are
    cells = li.select("l_suppkey", F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in _KEPT])))
    counts = cells.groupBy("l_suppkey", "name", "value").agg(F.count("*").alias("cnt"))
    return counts.select(F.concat_ws("@", "name", F.col("l_suppkey").cast("string")).alias("column_id"), "value", "cnt")


_KEPT = ("l_partkey", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query("WITH vc AS (" + " UNION ALL ".join(f"SELECT '{c}@' || l_suppkey AS column_id, CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM lineitem GROUP BY ALL" for c in _KEPT) + """),
 ch AS (SELECT column_id, unnest(regexp_extract_all(value, '[ -~]')) AS ch, cnt FROM vc), cc AS (SELECT column_id, ch, CAST(sum(cnt) AS DOUBLE) AS n FROM ch GROUP BY ALL),
 nn AS (SELECT column_id, ch, n / sqrt(sum(n * n) OVER (PARTITION BY column_id)) AS n FROM cc),
 pr AS (SELECT a.column_id, b.column_id AS other, sum(a.n * b.n) AS cosine FROM nn a JOIN nn b ON a.ch = b.ch AND a.column_id <> b.column_id GROUP BY ALL)
SELECT column_id, other, round(cosine, 6) AS cosine FROM (SELECT *, row_number() OVER (PARTITION BY column_id ORDER BY round(cosine, 9) DESC, other) AS nth FROM pr) WHERE nth <= 3""")
def nearest_columns(spark, d):
    """The three nearest columns to each column of each supplier's items: many datasets of few kinds of columns."""
    counts = written(_of_suppliers(spark, d))
    found = nearest.nearest(nearest.vectors(counts), counts.select("column_id").distinct(), 3)
    return found.select("column_id", "other", F.round("cosine", 6).alias("cosine"))


SAMPLE = VC + ", sm AS (SELECT *, row_number() OVER (PARTITION BY column_id ORDER BY md5(concat_ws('|', column_id, value)), value) AS nth FROM vc WHERE value IS NOT NULL)"


@query(f"WITH {SAMPLE} SELECT column_id, value, nth FROM sm WHERE nth <= 5")
def column_sample(spark, d):
    return tables.column_sample(tables.all_cells({t: table(spark, d, t) for t in PROFILED}))


@query(f"""WITH {SAMPLE}, lab AS (SELECT DISTINCT column_id, CASE WHEN split_part(column_id, '@', 1) LIKE '%key' THEN 'key' WHEN split_part(column_id, '@', 1) LIKE '%name' THEN 'name' ELSE 'other' END AS label FROM vc),
 mine AS (SELECT column_id, value FROM sm WHERE nth <= 5),
 ex AS (SELECT m.column_id AS other, label, value AS example, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', m.column_id, value)), m.column_id, value) AS k FROM mine m JOIN lab USING (column_id))
SELECT column_id, label, CAST(min(levenshtein(value, example)) AS INTEGER) AS min_distance FROM mine JOIN ex ON column_id <> other WHERE k <= 5 GROUP BY ALL""")
def min_edit_distance(spark, d):
    cells = tables.all_cells({t: table(spark, d, t) for t in PROFILED})
    return profile.min_edit_distance(written(tables.column_sample(cells)), _classes(spark, d))


@query("""WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '#') THEN regexp_extract(url, '[^#]*$') ELSE regexp_extract(url, '[^/]*$') END AS label FROM pages)
SELECT page_id, label, CASE WHEN length(label) = 0 THEN '' ELSE left(url, length(url) - length(label)) END AS prefix FROM u""")
def uri_label_prefix(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", uris.local_name(url).alias("label"), uris.namespace(url).alias("prefix"))


@query("SELECT event_id, event_type AS kind_event_type, value AS kind_value, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def flatten_props(spark, d):
    e = table(spark, d, "events").select("event_id", F.struct("event_type", "value").alias("kind"), F.from_json("props", "k long").alias("props"))
    return e.select(*tables.flattened(e))


def _truth(spark, d) -> DataFrame:
    return table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("actual"), F.col("toxic").cast("string").alias("predicted"))


@query("SELECT coalesce(CAST(quality AS VARCHAR), 'unknown') AS actual, coalesce(CAST(toxic AS VARCHAR), 'unknown') AS predicted, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(spark, d):
    return metrics.confusion(_truth(spark, d))


def _scores_sql(rows: str, key: str = "") -> str:
    k, on = (f"{key}, ", f"USING ({key})") if key else ("", "ON true")
    return f"""WITH r AS ({rows}), s AS (SELECT {k}a AS label, count(*) AS act, 0 AS pre, sum(CASE WHEN a = p THEN 1 ELSE 0 END) AS tp FROM r GROUP BY ALL UNION ALL SELECT {k}p, 0, count(*), 0 FROM r GROUP BY ALL),
 t AS (SELECT {k}count(*) AS t FROM r {'GROUP BY ALL' if key else ''}), x AS (SELECT {k}label, sum(act) AS act, sum(pre) AS pre, sum(tp) AS tp FROM s GROUP BY ALL),
 y AS (SELECT x.*, t, CASE WHEN pre = 0 THEN 0 ELSE tp / pre END AS p, CASE WHEN act = 0 THEN 0 ELSE tp / act END AS r FROM x JOIN t {on})
SELECT {k}round(avg(1 - (act + pre - 2 * tp) / t), 6) AS average_accuracy, round(avg((act + pre - 2 * tp) / t), 6) AS error_rate, round(sum(tp) / max(t), 6) AS precision_micro, round(avg(p), 6) AS precision_macro,
 round(sum(tp) / max(t), 6) AS recall_micro, round(avg(r), 6) AS recall_macro, round(sum(tp) / max(t), 6) AS fscore_micro, round(avg(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END), 6) AS fscore_macro FROM y {'GROUP BY ' + key if key else ''}"""


@query(_scores_sql("SELECT CAST(quality AS VARCHAR) AS a, CAST(toxic AS VARCHAR) AS p FROM labels"))
def classification_scores(spark, d):
    return metrics.scores(metrics.confusion(_truth(spark, d)))


def _by_mode(spark, d) -> DataFrame:
    flag = F.when(F.col("l_linestatus") == "F", "A").otherwise("N")
    return table(spark, d, "lineitem").select(F.month("l_shipdate").alias("fold"), F.col("l_returnflag").alias("actual"), flag.alias("predicted"))


_LI = "SELECT month(l_shipdate) AS fold, l_returnflag AS a, CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'N' END AS p FROM lineitem"


@query(_scores_sql(_LI, "fold"))
def scores_by_group(spark, d):
    return metrics.scores(metrics.confusion(_by_mode(spark, d), "fold"), "fold")


@query(f"WITH q AS ({_scores_sql(_LI, 'fold')}) SELECT round(avg(average_accuracy), 6) AS average_accuracy, round(avg(error_rate), 6) AS error_rate, round(avg(precision_micro), 6) AS precision_micro, round(avg(precision_macro), 6) AS precision_macro, round(avg(recall_micro), 6) AS recall_micro, round(avg(recall_macro), 6) AS recall_macro, round(avg(fscore_micro), 6) AS fscore_micro, round(avg(fscore_macro), 6) AS fscore_macro FROM q")
def mean_scores(spark, d):
    return metrics.mean_scores(scores_by_group(spark, d))


def _candidates(spark, d) -> tuple[DataFrame, DataFrame]:
    """Event types of each user by their number of events; the truth is the type of the user's last event."""
    e = table(spark, d, "events")
    scored = e.groupBy(F.col("user_id").alias("item"), F.col("event_type").alias("label")).agg(F.count("*").alias("score"))
    truth = e.groupBy(F.col("user_id").alias("item")).agg(F.max_by("event_type", "event_id").alias("actual"))
    return scored, truth


RANK = "c AS (SELECT user_id AS item, event_type AS label, count(*) AS score FROM events GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, label) AS INTEGER) AS rank FROM c)"
FOUND = RANK + ", tr AS (SELECT user_id AS item, arg_max(event_type, event_id) AS actual FROM events GROUP BY 1), f AS (SELECT tr.item, actual, r.rank, (SELECT count(*) FROM c WHERE c.item = tr.item) AS n FROM tr LEFT JOIN r ON r.item = tr.item AND r.label = actual)"


@query(f"WITH {RANK} SELECT item, label, score, rank FROM r")
def rank_candidates(spark, d):
    return metrics.ranked(_candidates(spark, d)[0])


@query(f"""WITH {FOUND}, p AS (SELECT actual, sum(CASE WHEN rank <= 2 THEN 1 ELSE 0 END) AS h, sum(least(coalesce(rank, 2), 2, n)) AS s FROM f GROUP BY 1)
SELECT round(sum(h) / sum(s), 6) AS micro, round(avg(h / s), 6) AS macro FROM p""")
def precision_at_k(spark, d):
    scored, truth = _candidates(spark, d)
    return metrics.precision_at_k(metrics.rank_of_truth(metrics.ranked(scored), truth), 2)


@query(f"WITH {FOUND}, p AS (SELECT actual, sum(CASE WHEN rank IS NULL THEN 0 ELSE 1 / rank END) AS s, count(*) AS n FROM f GROUP BY 1) SELECT round(sum(s) / sum(n), 6) AS micro, round(avg(s / n), 6) AS macro FROM p")
def mrr(spark, d):
    scored, truth = _candidates(spark, d)
    return metrics.mrr(metrics.rank_of_truth(metrics.ranked(scored), truth))


@query(f"WITH {CELLS}, c AS (SELECT DISTINCT name || '@' || ds AS column_id FROM cells) SELECT column_id, CAST(ntile(10) OVER (ORDER BY column_id) - 1 AS INTEGER) AS fold FROM c")
def kfold_assign(spark, d):
    return sampling.kfold(tables.column_catalog({t: table(spark, d, t) for t in PROFILED}).select("column_id"), 10, "column_id")


def _resampled(goal: str) -> str:
    return f"""WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), g AS (SELECT lang, n, {goal} AS goal FROM n, (SELECT max(n) AS most, CAST(floor(avg(n)) AS BIGINT) AS mean FROM n)),
 r AS (SELECT doc_id, d.lang, n, goal, row_number() OVER (PARTITION BY d.lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS nth FROM documents d JOIN g USING (lang))
SELECT doc_id, lang, unnest(range(0, CAST(floor((goal - nth + n - 1) / n) AS BIGINT))) AS copy FROM r"""


@query(_resampled("most"))
def upsample_to_max(spark, d):
    return sampling.resample(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", "upsample_to_max")


@query(_resampled("greatest(n, mean)"))
def upsample_to_mean(spark, d):
    return sampling.resample(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", "upsample_to_mean")


@query(_resampled("mean"))
def resample_to_mean(spark, d):
    return sampling.resample(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", "resample_to_mean")


def _bagged(n_bags: str) -> str:
    return f"""WITH {VC}, lab AS (SELECT DISTINCT column_id, CASE WHEN split_part(column_id, '@', 1) LIKE '%key' THEN 'key' WHEN split_part(column_id, '@', 1) LIKE '%name' THEN 'name' ELSE 'other' END AS label FROM vc),
 sz AS (SELECT label, count(*) AS n FROM lab GROUP BY 1), nb AS (SELECT column_id, {n_bags} AS k FROM lab JOIN sz USING (label), (SELECT max(n) AS most, avg(n) AS mean FROM sz)),
 r AS (SELECT *, sum(cnt) OVER (PARTITION BY column_id ORDER BY value NULLS FIRST ROWS UNBOUNDED PRECEDING) AS hi FROM vc), t AS (SELECT column_id, sum(cnt) AS t FROM vc GROUP BY 1),
 dr AS (SELECT column_id, t, bag, unnest(range(1, 11)) AS i FROM (SELECT column_id, t, unnest(range(1, CAST(k AS BIGINT) + 1)) AS bag FROM nb JOIN t USING (column_id))),
 pos AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', column_id, CAST(bag AS VARCHAR), CAST(i AS VARCHAR))), 1, 8) AS BIGINT) % t AS place FROM dr)
SELECT pos.column_id, CAST(bag AS INTEGER) AS bag, CAST(i AS INTEGER) AS i, value FROM pos JOIN r ON pos.column_id = r.column_id AND place >= hi - cnt AND place < hi"""


def _bags(spark, d, strategy):
    cells = tables.all_cells({t: table(spark, d, t) for t in PROFILED})
    return sampling.bags(cells, sampling.bags_per_column(_classes(spark, d), 5, strategy), 10)


@query(_bagged("5"))
def bagging(spark, d):
    return _bags(spark, d, "bagging")


@query(_bagged("greatest(1, ceil(5 * most / n))"))
def bagging_to_max(spark, d):
    return _bags(spark, d, "bagging_to_max")


@query(_bagged("greatest(1, ceil(5 * mean / n))"))
def bagging_to_mean(spark, d):
    return _bags(spark, d, "bagging_to_mean")
