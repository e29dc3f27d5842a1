"""Queries on forests over folds, bags as training rows, class features that leave a fold out, and chosen features, and the same in SQL.

The columns of the profiled tables are classified by what their names say; the SQL grows the same trees, a level a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import candidates, evaluation, forest, nearest, profile, sampling
from ..sources import tables
from ..sources.store import written
from ..sources.tables import PROFILED, table
from .base import SQL, query
from .columns import COS, SAMPLE, _bagged, _counts

FEATURES = ["ratio_alpha_chars", "prop_numerical_chars", "prop_whitespace_chars", "prop_unique_vals", "prop_entries_with_hyphen", "shannon_entropy"]
TREES, DEPTH, BINS, TAKE = 7, 3, 16, 3
LABEL = "CASE WHEN nm LIKE '%key' THEN 'key' WHEN nm LIKE '%name' THEN 'name' WHEN nm NOT LIKE '%date' THEN 'other' END"


def _forest_sql(features: list[str], trees: int = TREES, depth: int = DEPTH, bins: int = BINS, take: int = TAKE) -> str:
    """Further parts of a WITH that has gr(item, fold, label, features ..), rows that grow a fold's trees, and te(item, fold, features ..)."""
    at = lambda f: f"coalesce({f}, 0)"
    one = lambda i, f: f"CASE WHEN hi{i} > lo{i} THEN greatest(0, least({bins - 1}, CAST(floor({bins} * ({at(f)} - lo{i}) / (hi{i} - lo{i})) AS INTEGER))) ELSE 0 END"
    numbers = "[" + ", ".join(one(i, f) for i, f in enumerate(features)) + "]"
    draw = "CAST('0x' || substr(md5(item || '|' || tree), 1, 8) AS BIGINT)"
    w = " + ".join(f"CASE WHEN {draw} >= {p} THEN 1 ELSE 0 END" for p in forest.POISSON)
    parts = [
        "en AS (SELECT " + ", ".join(f"min({at(f)}) AS lo{i}, max({at(f)}) AS hi{i}" for i, f in enumerate(features)) + " FROM gr)",
        f"""a0 AS (SELECT * FROM (SELECT item, fold, tree, 0 AS node, label, {w} AS w, {numbers} AS b, true AS open FROM gr, en, (SELECT unnest(range({trees})) AS tree)) WHERE w > 0
 UNION ALL SELECT item, fold, tree, 0, NULL, 0, {numbers}, true FROM te, en, (SELECT unnest(range({trees})) AS tree))""",
    ]
    for i in range(depth):
        allowed = ", ".join(f"({t}, {f})" for t, f in forest.chosen(len(features), take, trees, i))
        parts += [
            f"h{i} AS (SELECT fold, a.tree, node, f, b[f + 1] AS bin, label, sum(w) AS n FROM a{i} a JOIN (VALUES {allowed}) v(tree, f) ON v.tree = a.tree WHERE w > 0 AND open GROUP BY ALL)",
            f"t{i} AS (SELECT fold, tree, node, label, sum(w) AS total FROM a{i} WHERE w > 0 AND open GROUP BY ALL)",
            f"""d{i} AS (SELECT c.*, t.label, total, sum(coalesce(n, 0)) OVER (PARTITION BY c.fold, c.tree, c.node, c.f, t.label ORDER BY c.bin) AS l FROM (SELECT DISTINCT fold, tree, node, f, bin FROM h{i}) c
 JOIN t{i} t USING (fold, tree, node) LEFT JOIN h{i} h ON h.fold = c.fold AND h.tree = c.tree AND h.node = c.node AND h.f = c.f AND h.bin = c.bin AND h.label = t.label)""",
            f"s{i} AS (SELECT fold, tree, node, f, bin, sum(l) AS l, sum(l * l) AS ll, sum(total - l) AS r, sum((total - l) * (total - l)) AS rr, sum(total) AS t, sum(total * total) AS tt FROM d{i} GROUP BY ALL)",
            f"x{i} AS (SELECT fold, tree, node, arg_min(f, (-z, f, bin)) AS f, arg_min(bin, (-z, f, bin)) AS bin FROM (SELECT *, round(ll / l + rr / r, 9) AS z FROM s{i} WHERE l > 0 AND r > 0) WHERE z > round(tt / t, 9) GROUP BY ALL)",
            f"""a{i + 1} AS (SELECT item, a.fold, a.tree, CASE WHEN open AND x.f IS NOT NULL THEN 2 * a.node + CASE WHEN b[x.f + 1] <= x.bin THEN 1 ELSE 2 END ELSE a.node END AS node, label, w, b, open AND x.f IS NOT NULL AS open
 FROM a{i} a LEFT JOIN x{i} x ON x.fold = a.fold AND x.tree = a.tree AND x.node = a.node)""",
        ]
    parts += [
        f"lf AS (SELECT fold, tree, node, label, sum(w) AS n FROM a{depth} WHERE w > 0 GROUP BY ALL), ls AS (SELECT *, n / sum(n) OVER (PARTITION BY fold, tree, node) AS share FROM lf)",
        f"sc AS (SELECT item, a.fold, ls.label, round(sum(share) / {trees}, 6) AS score FROM a{depth} a JOIN ls USING (fold, tree, node) WHERE w = 0 GROUP BY ALL)",
        """fp AS (SELECT te.item, te.fold, coalesce(te.label, 'unknown') AS actual, coalesce(p, 'unknown') AS predicted, coalesce(s, 0) AS confidence FROM te LEFT JOIN
 (SELECT item, fold, arg_min(label, (-score, label)) AS p, max(score) AS s FROM sc GROUP BY ALL) USING (item, fold))""",
    ]
    return ", ".join(parts)


def _features_sql(fold: str) -> str:
    return f"""WITH f1 AS ({SQL["profile_chars"]}), f2 AS ({SQL["profile_basic"]}), f3 AS ({SQL["char_entropy"]}),
 ft AS (SELECT column_id AS item, {", ".join(FEATURES)}, split_part(column_id, '@', 1) AS nm, {LABEL} AS label, {fold} AS fold FROM f1 JOIN f2 USING (column_id) LEFT JOIN f3 USING (column_id))"""


def _columns(spark, d, fold: str) -> DataFrame:
    """Columns with features, a label by their names (none for dates), and a fold: of five, their dataset, or one for all."""
    names = tables.column_names({t: table(spark, d, t) for t in PROFILED})
    label = F.when(F.col("name").endswith("key"), "key").when(F.col("name").endswith("name"), "name").when(~F.col("name").endswith("date"), "other")
    folds = {"five": lambda: sampling.kfold(names.select("column_id"), 5, "column_id"), "dataset": lambda: names.select("column_id", F.col("dataset_id").alias("fold")), "all": lambda: names.select("column_id", F.lit("all").alias("fold"))}[fold]()
    features = profile.selected(written(_counts(spark, d)), FEATURES)
    return written(features.join(names.select("column_id", label.alias("label")), "column_id").join(folds, "column_id").withColumnRenamed("column_id", "item"))


_HOW = {"trees": TREES, "depth": DEPTH, "bins": BINS, "take": TAKE}
_FIVE = _features_sql("CAST(ntile(5) OVER (ORDER BY column_id) - 1 AS INTEGER)")
_SETS = _features_sql("split_part(column_id, '@', 2)")
_OTHERS = ", te AS (SELECT * FROM ft), gr AS (SELECT r.item, o.fold, r.label, {f} FROM ft r JOIN (SELECT DISTINCT fold FROM ft) o ON o.fold <> r.fold WHERE r.label IS NOT NULL)".format(f=", ".join(f"r.{f}" for f in FEATURES))
_GROWN = _OTHERS + ", " + _forest_sql(FEATURES)


def _tested(rows: DataFrame) -> DataFrame:
    return forest.predicted(forest.scores(rows, rows, FEATURES, **_HOW), rows)


def _means_sql(source: str) -> str:
    return SQL["mean_scores"].replace("SELECT month(l_shipdate) AS fold, l_returnflag AS a, CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'N' END AS p FROM lineitem", f"{source} SELECT fold, actual AS a, predicted AS p FROM fp")


@query(_FIVE + _GROWN + " SELECT * FROM fp")
def forest_column_predictions(spark, d):
    """Classes of columns, each of five folds predicted by trees of the others."""
    return _tested(_columns(spark, d, "five"))


@query(_FIVE + _GROWN + " SELECT * FROM sc")
def forest_column_class_scores(spark, d):
    """Scores of each class for the columns of each fold."""
    rows = _columns(spark, d, "five")
    return forest.scores(rows, rows, FEATURES, **_HOW)


@query(_means_sql(_FIVE + _GROWN))
def forest_column_scores(spark, d):
    """Mean scores of the five folds."""
    return evaluation.evaluated(_tested(_columns(spark, d, "five")))[1]


@query(_means_sql(_SETS + _GROWN))
def forest_dataset_scores(spark, d):
    """Mean scores where each dataset is predicted by trees of the others, all of them grown together."""
    return evaluation.evaluated(_tested(_columns(spark, d, "dataset")))[1]


@query(_SETS + _GROWN + " SELECT item AS column_id, fold AS dataset, actual, predicted FROM fp")
def leave_one_dataset_out(spark, d):
    """Classes of each dataset's columns from the other datasets."""
    return _tested(_columns(spark, d, "dataset")).select(F.col("item").alias("column_id"), F.col("fold").alias("dataset"), "actual", "predicted")


@query(_features_sql("'all'") + f""", te AS (SELECT * FROM ft), gr AS (SELECT item, fold, label, {", ".join(FEATURES)} FROM ft WHERE label IS NOT NULL), {_forest_sql(FEATURES)}
SELECT item AS column_id, actual AS label, predicted, confidence FROM fp""")
def forest_of_all_columns(spark, d):
    """All columns of all datasets, predicted by one forest that all labelled ones grow."""
    rows = _columns(spark, d, "all")
    train = rows.withColumn("fold", F.lit("train"))
    out = forest.predicted(forest.scores(train, rows, FEATURES, **_HOW), rows)
    return out.select(F.col("item").alias("column_id"), F.col("actual").alias("label"), "predicted", "confidence")


def _bag_vc(n_bags: str) -> str:
    """Value counts of bags in the place of those of columns."""
    return f"vc AS (SELECT column_id || '#' || bag AS column_id, value, count(*) AS cnt FROM ({_bagged(n_bags)}) GROUP BY ALL)"


def _of_bags(sql: str, n_bags: str) -> str:
    """A library query's SQL over the bags' value counts."""
    head = "vc AS (SELECT name || '@' || ds AS column_id, value, count(*) AS cnt FROM cells GROUP BY ALL)"
    assert head in sql
    return sql.replace(head, _bag_vc(n_bags), 1)


def _drawn(spark, d, strategy: str) -> DataFrame:
    from .columns import _bags

    return written(sampling.bag_counts(_bags(spark, d, strategy)))


_BAG_F = f"""WITH f1 AS ({_of_bags(SQL["profile_chars"], "5")}), f2 AS ({_of_bags(SQL["profile_basic"], "5")}), f3 AS ({_of_bags(SQL["char_entropy"], "5")}),
 bf AS (SELECT column_id AS bag_id, {", ".join(FEATURES)} FROM f1 JOIN f2 USING (column_id) LEFT JOIN f3 USING (column_id))"""


@query(_BAG_F + " SELECT * FROM bf")
def bag_features(spark, d):
    """Features of each bag of ten drawn cells, five bags a column: computed from drawn numbers, not from cells."""
    return profile.selected(_drawn(spark, d, "bagging"), FEATURES).withColumnRenamed("column_id", "bag_id")


@query(f"""{_FIVE}, bq AS ({_BAG_F} SELECT * FROM bf), bl AS (SELECT bq.bag_id, ft.fold AS own, ft.label, {", ".join(f"bq.{f}" for f in FEATURES)} FROM bq JOIN ft ON ft.item = split_part(bag_id, '#', 1) WHERE label IS NOT NULL),
 nn AS (SELECT own, label, count(*) AS n FROM bl GROUP BY ALL), gl AS (SELECT o.fold, nn.label, sum(n) AS n FROM nn JOIN (SELECT DISTINCT fold FROM ft) o ON o.fold <> nn.own GROUP BY ALL), gm AS (SELECT *, CAST(floor(avg(n) OVER (PARTITION BY fold)) AS BIGINT) AS goal FROM gl),
 rk AS (SELECT bl.*, o.fold, g.n, g.goal, row_number() OVER (PARTITION BY o.fold, bl.label ORDER BY md5(bag_id), bag_id) - 1 AS nth FROM bl JOIN (SELECT DISTINCT fold FROM ft) o ON o.fold <> bl.own JOIN gm g ON g.fold = o.fold AND g.label = bl.label),
 te AS (SELECT * FROM ft), gr AS (SELECT bag_id || '#' || unnest(range(0, CAST(floor((goal - nth + n - 1) / n) AS BIGINT))) AS item, fold, label, {", ".join(FEATURES)} FROM rk), {_forest_sql(FEATURES)}
SELECT * FROM fp""")
def forest_of_bags(spark, d):
    """Columns of each fold predicted by trees of the other folds' bags, which are resampled to the mean of their classes."""
    rows = _columns(spark, d, "five")
    bags = profile.selected(_drawn(spark, d, "bagging"), FEATURES).withColumnRenamed("column_id", "bag_id")
    own = rows.filter("label IS NOT NULL").select(F.col("item").alias("column_id"), "label", F.col("fold").alias("own"))
    bags = bags.withColumn("column_id", F.substring_index("bag_id", "#", 1)).join(own, "column_id")
    folds = rows.select("fold").distinct()
    # a bag trains every fold but its own; classes are brought to one size within each fold's training rows
    each = written(bags.join(folds, F.col("fold") != F.col("own")))
    train = sampling.resample_within(each, "fold", "label", "bag_id", "resample_to_mean").withColumn("item", F.concat_ws("#", "bag_id", "copy"))
    return forest.predicted(forest.scores(train, rows, FEATURES, only="fold", **_HOW), rows)


def _class_folds(spark, d) -> DataFrame:
    names = tables.column_names({t: table(spark, d, t) for t in PROFILED})
    label = F.when(F.col("name").endswith("key"), "key").when(F.col("name").endswith("name"), "name").when(~F.col("name").endswith("date"), "other")
    return names.select("column_id", label.alias("label")).join(sampling.kfold(names.select("column_id"), 5, "column_id"), "column_id")


_CF = f"cf AS (SELECT column_id, split_part(column_id, '@', 1) AS nm, {LABEL} AS label, CAST(ntile(5) OVER (ORDER BY column_id) - 1 AS INTEGER) AS fold FROM (SELECT DISTINCT column_id FROM vc)), fo AS (SELECT DISTINCT fold FROM cf)"
_MEAN = """SELECT fo.fold, a.column_id, cf.label, round(avg(coalesce(cosine, 0)), 6) AS mean_cosine FROM (SELECT DISTINCT column_id FROM cc) a JOIN cf ON cf.column_id <> a.column_id JOIN fo ON fo.fold <> cf.fold
 JOIN (SELECT DISTINCT column_id FROM cc) e ON e.column_id = cf.column_id LEFT JOIN pr ON pr.column_id = a.column_id AND pr.other = cf.column_id WHERE cf.label IS NOT NULL GROUP BY ALL"""


@query(f"WITH {COS}, {_CF} {_MEAN}")
def class_cosine_by_fold(spark, d):
    """Mean cosine to the classes' columns outside each fold."""
    return profile.class_cosine_by_fold(_counts(spark, d), _class_folds(spark, d))


@query(f"""WITH {COS}, {_CF}, k AS (SELECT fo.fold, pr.column_id, cf.label, row_number() OVER (PARTITION BY fo.fold, pr.column_id ORDER BY round(cosine, 9) DESC, other) AS nth FROM pr JOIN cf ON cf.column_id = other JOIN fo ON fo.fold <> cf.fold WHERE cf.label IS NOT NULL)
SELECT fold, column_id, label, round(n / sum(n) OVER (PARTITION BY fold, column_id), 6) AS share FROM (SELECT fold, column_id, label, count(*) AS n FROM k WHERE nth <= 3 GROUP BY ALL)""")
def knn_class_share_by_fold(spark, d):
    folds = _class_folds(spark, d)
    near = nearest.nearest(nearest.vectors(_counts(spark, d)), folds.filter("label IS NOT NULL"), 3, "fold")
    return profile.knn_class_share_by_fold(near, folds)


@query(f"""WITH {SAMPLE}, {_CF}, mine AS (SELECT column_id, value FROM sm WHERE nth <= 5),
 ex AS (SELECT fo.fold, m.column_id AS other, label, value AS example, row_number() OVER (PARTITION BY fo.fold, label ORDER BY md5(concat_ws('|', m.column_id, value)), m.column_id, value) AS k FROM mine m JOIN cf USING (column_id) JOIN fo ON fo.fold <> cf.fold WHERE label IS NOT NULL)
SELECT fold, column_id, label, CAST(min(levenshtein(value, example)) AS INTEGER) AS min_distance FROM mine JOIN ex ON column_id <> other WHERE k <= 5 GROUP BY ALL""")
def min_edit_distance_by_fold(spark, d):
    cells = tables.all_cells({t: table(spark, d, t) for t in PROFILED})
    return profile.min_edit_distance_by_fold(written(tables.column_sample(cells)), _class_folds(spark, d))


CLASS = [f"cosine_{c}" for c in ("key", "name", "other")]
_BOTH = FEATURES + CLASS
_WIDE = ", ".join(f"max(mean_cosine) FILTER (mc.label = '{c[7:]}') AS {c}" for c in CLASS)


@query(f"""{_FIVE}, mq AS (WITH {COS}, {_CF} {_MEAN}), wd AS (SELECT fold, column_id AS item, {_WIDE} FROM mq mc GROUP BY ALL),
 te AS (SELECT ft.*, {", ".join(CLASS)} FROM ft LEFT JOIN wd USING (fold, item)), gr AS (SELECT ft.item, wd.fold, label, {", ".join(_BOTH)} FROM ft JOIN wd ON wd.item = ft.item AND wd.fold <> ft.fold WHERE label IS NOT NULL), {_forest_sql(_BOTH)}
SELECT * FROM fp""")
def forest_with_class_features(spark, d):
    """Columns of each fold predicted with cosines to classes, which for that fold's trees leave its columns out."""
    rows = _columns(spark, d, "five")
    cosines = profile.class_cosine_by_fold(_counts(spark, d), _class_folds(spark, d))
    wide = written(cosines.groupBy("fold", F.col("column_id").alias("item")).agg(*[F.max(F.when(F.col("label") == c[7:], F.col("mean_cosine"))).alias(c) for c in CLASS]))
    train = rows.withColumnRenamed("fold", "own").join(wide, "item").filter("own <> fold")
    test = rows.join(wide, ["fold", "item"], "left")
    return forest.predicted(forest.scores(train, test, _BOTH, only="fold", **_HOW), test)


@query(f"WITH b AS ({SQL['profile_basic']}), l AS ({SQL['profile_text_length']}) SELECT column_id, prop_missing_vals, is_discrete, mean AS text_length_mean, median AS text_length_median, mode AS text_length_mode, least AS text_length_least, greatest AS text_length_greatest FROM b LEFT JOIN l USING (column_id)")
def chosen_features(spark, d):
    """Two features and a group of five; no pass over characters or numbers enters the plan."""
    return profile.selected(_counts(spark, d), ["prop_missing_vals", "is_discrete"], ["stats_of_text_length"])


def _recommended(spark, d) -> tuple[DataFrame, DataFrame]:
    """Suppliers as datasets whose columns are line numbers, typed by the brands of their parts; large items link brands with sizes, by month."""
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    n = j.groupBy(F.col("l_suppkey").alias("dataset"), "l_linenumber", F.col("p_brand").alias("label")).agg(F.sum("l_quantity").alias("n"))
    place = F.dense_rank().over(Window.partitionBy("dataset").orderBy("l_linenumber")) - 1  # a supplier has seven line numbers
    scores = n.withColumn("position", place).withColumn("score", F.col("n") / F.sum("n").over(Window.partitionBy("dataset", "l_linenumber"))).select("dataset", "position", "label", "score")
    large = j.filter("l_quantity >= 50")
    training = large.select(F.month("l_shipdate").alias("ssd_id"), F.col("p_brand").alias("src"), F.col("l_returnflag").alias("label"), F.concat(F.lit("size"), F.col("p_size").cast("string")).alias("dst")).distinct()
    return candidates.recommended(scores, training, None, 3, 0.0, 4, 3, 1.0, 1.0, 0.5)


@query()
def recommended_models(spark, d):
    """Three semantic models of each supplier, from scores of its columns over connecting trees to ranks."""
    models, _ = _recommended(spark, d)
    return models.withColumn("labels", F.array_join("labels", ","))


@query()
def recommended_links(spark, d):
    """The links that connect the classes of each recommended model."""
    return _recommended(spark, d)[1]
