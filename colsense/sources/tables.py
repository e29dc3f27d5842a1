"""Datasets: tables and CSV files, their columns and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import written

#: Tables whose columns the profile queries describe.
PROFILED = ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, type_map: dict[str, str] | None = None) -> DataFrame:
    """A CSV dataset with a header; quoted fields may hold line breaks. type_map overrides column types; what a type can't hold is null."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return with_types(df, type_map or {})


def read_directory(spark: SparkSession, path: str, labels_file: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Datasets of a folder by file name, and labels(dataset, column, label): all CSV files but the labels file, and that file.

    Files have columns of their own, so that each is read as a table; only their names are listed here.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    names = {r["path"].rsplit("/", 1)[-1]: r["path"] for r in files.collect()}
    labels = read_csv(spark, names[labels_file]).toDF("dataset", "column", "label")
    return {n: read_csv(spark, p) for n, p in sorted(names.items()) if n != labels_file}, labels


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """(path, row, col_index, name, value): the cells of all CSV files under a folder, whatever their columns, in one job.

    Each file's first record names its columns; rows are numbered from 0 within their file; quoted fields may hold line
    breaks; a name that repeats is told by col_index; empty fields and those that a short record lacks are null; files
    without a record give nothing. No file becomes a DataFrame of its own: all are read as records of as many fields as the
    widest one may have, and meet their header by the file's path.
    """
    files = dict(recursiveFileLookup="true", pathGlobFilter="*.csv")
    fields = spark.read.options(**files).text(path).agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(","))))).first()[0]
    width = 2 + (fields or 0)
    while True:
        schema = ", ".join(f"f{i} string" for i in range(width))
        wide = spark.read.schema(schema).options(header="false", multiLine="true", escape='"', maxColumns=str(width + 1), **files).csv(path)
        records = wide.select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), F.array(*wide.columns).alias("fields"))
        # the places of the first records are found by numbers alone; a least array of each file would sort all records
        first = written(records.groupBy("path").agg(F.min("at").alias("first")))
        heads = written(records.join(first, "path").filter("at = first").select("path", F.col("fields").alias("head"), "first"))
        if heads.filter(F.col("head")[width - 1].isNotNull()).isEmpty():
            break
        width *= 2  # a header that goes over several lines
    names = F.filter(F.transform("head", lambda name, i: F.struct(i.alias("col_index"), name.alias("name"))), lambda x: x["name"].isNotNull())
    names = written(heads.select("path", "first", names.alias("names")))  # once per file, so that a record's cells are taken by index alone
    rows = records.join(names, "path").filter("at > first").select("path", (F.col("at") - F.col("first") - 1).alias("row"), "fields", F.inline("names"))
    return rows.select("path", "row", "col_index", "name", F.get("fields", "col_index").alias("value"))


def combined(df: DataFrame, columns: list[str], name: str, separator: str = " ") -> DataFrame:
    """df with some columns made one; null parts are left out."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], F.concat_ws(separator, *[F.col(f"`{c}`").cast("string") for c in columns]).alias(name))


def with_types(df: DataFrame, type_map: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").try_cast(type_map[c]).alias(c) if c in type_map else F.col(f"`{c}`") for c in df.columns])


def read_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A headed mapping or link file without blank lines and # comments, fields trimmed."""
    df = spark.read.option("header", True).option("comment", "#").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return df.toDF(*columns).na.drop("all")


def column_id(name: Column | str, dataset: Column | str) -> Column:
    """The full name of a column: name@dataset."""
    return F.concat_ws("@", name, dataset)


def split_column_id(full: Column) -> tuple[Column, Column]:
    """Name and dataset of a full column name, parted at the last @."""
    return F.regexp_extract(full, r"(?s)^(.*)@([^@]*)$", 1), F.regexp_extract(full, r"(?s)^(.*)@([^@]*)$", 2)


def cells(df: DataFrame, dataset: str, row_id: Column | None = None) -> DataFrame:
    """(dataset_id, column_id, name, value string): one row per cell of df, on request with a row_id that a row's cells share."""
    ids = [] if row_id is None else [row_id.alias("row_id")]
    wide = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    long = wide.unpivot(["row_id"] if ids else [], df.columns, "name", "value")
    return long.select(F.lit(dataset).alias("dataset_id"), column_id("name", F.lit(dataset)).alias("column_id"), "name", *(["row_id"] if ids else []), "value")


def all_cells(datasets: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in datasets.items():
        x = cells(df, name)
        out = x if out is None else out.unionByName(x)
    return out


def column_names(datasets: dict[str, DataFrame]) -> DataFrame:
    """(dataset_id, column_id, name, col_index, logical_type) of each column, from the datasets' schemas alone."""
    spark = next(iter(datasets.values())).sparkSession
    rows = [(d, f"{c}@{d}", c, i, t) for d, df in datasets.items() for i, (c, t) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "dataset_id string, column_id string, name string, col_index int, logical_type string")


def column_catalog(datasets: dict[str, DataFrame]) -> DataFrame:
    """One row per column of all datasets: ids, name, position, rows and declared type."""
    catalog, sizes = column_names(datasets), None
    for d, df in datasets.items():
        x = df.agg(F.count("*").alias("size")).select(F.lit(d).alias("dataset_id"), "size")
        sizes = x if sizes is None else sizes.unionByName(x)
    return catalog.join(sizes, "dataset_id")


def dataset_summary(catalog: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """Rows and columns of each dataset, and what meta(dataset_id, name, description, created, modified) says of it."""
    out = catalog.groupBy("dataset_id").agg(F.max("size").alias("n_rows"), F.count("*").alias("n_cols"))
    return out if meta is None else out.join(meta, "dataset_id", "left")


def column_lookup(catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(dataset_id, name) with status ok, missing or ambiguous, and the column's id when ok."""
    found = catalog.groupBy("dataset_id", "name").agg(F.count("*").alias("n"), F.min("column_id").alias("column_id"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").otherwise("ok")
    return wanted.join(found, ["dataset_id", "name"], "left").select("dataset_id", "name", status.alias("status"), F.when(F.col("n") == 1, F.col("column_id")).alias("column_id"))


def column_sample(cells_: DataFrame, k: int = 5) -> DataFrame:
    """k distinct values of each column in the order of a hash (value last): the same sample on each run."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("column_id").orderBy(F.md5(F.concat_ws("|", "column_id", "value")), "value")
    values = cells_.filter("value IS NOT NULL").select("column_id", "value").distinct()
    return values.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def same_datasets(left: DataFrame, right: DataFrame, left_meta: DataFrame | None = None, right_meta: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id): datasets of two catalogues that have the same set of column names and, where meta tables
    (dataset_id, ..) are given, agree in all of these's other columns; null agrees with null alone."""
    if left_meta is not None:
        keys = [c for c in left_meta.columns if c != "dataset_id"]
        told = lambda m, k: m.select(F.col("dataset_id").alias(k), F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_meta"))
        same = same_datasets(left, right).join(told(left_meta, "left_id"), "left_id")
        return same.join(told(right_meta, "right_id"), ["right_id", "_meta"]).select("left_id", "right_id")
    names = lambda c, k: c.groupBy("dataset_id").agg(F.array_sort(F.collect_set("name")).alias("names")).select(F.col("dataset_id").alias(k), "names")
    return names(left, "left_id").join(names(right, "right_id"), "names").select("left_id", "right_id")


def same_dataset(a: DataFrame, b: DataFrame) -> bool:
    """Whether two datasets have the same set of column names."""
    return set(a.columns) == set(b.columns)


def flattened(df: DataFrame, separator: str = "_", prefix: str = "", keys: dict[str, list[str]] | None = None) -> list[Column]:
    """Columns of df with nested structs flattened to a_b; arrays are kept whole, and maps but for those whose keys are given."""
    from pyspark.sql.types import MapType, StructType

    keys = keys or {}

    def walk(schema, path, name):
        for f in schema.fields:
            at, out = [*path, f.name], f"{name}{f.name}"
            if isinstance(f.dataType, StructType):
                yield from walk(f.dataType, at, out + separator)
            elif isinstance(f.dataType, MapType) and out in keys:
                for k in keys[out]:
                    yield F.try_element_at(F.col(".".join(f"`{p}`" for p in at)), F.lit(k)).alias(out + separator + k)
            else:
                yield F.col(".".join(f"`{p}`" for p in at)).alias(out)

    return list(walk(df.schema, [], prefix))
