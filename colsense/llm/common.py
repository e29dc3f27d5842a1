"""What the operators share: tables in the shared folder, byte-level text helpers, fixed-size bitmaps."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all contracts: space and the bytes 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Lower case of A-Z only, for UTF-8 bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"

_MULT = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = np.random.default_rng(20240502).integers(1, 2**63, 32, dtype=np.uint64) | np.uint64(1)
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset: a temporary folder, with a local master alone."""
    global _own_dir
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own_dir = _own_dir or tempfile.mkdtemp(prefix="spark-colsense-")
        base = _own_dir
    return f"{base.rstrip('/')}/colsense-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (dots written as __) that hold for the actions inside."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str = "t") -> DataFrame:
    """df written once as Parquet to the shared folder and read again: lineage ends here, a lost executor loses nothing.

    Rows reach Python functions in small batches meanwhile, so that long texts don't fill a worker.
    """
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{name}"
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def given_back(f):
    """f over batches; at its end the worker gives memory that it has freed back to the system, as workers outlive their tasks."""

    def g(batches):
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return g


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case of letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def _scanned(df: DataFrame) -> bool:
    """Whether df's rows are rows of files, chosen and projected only, so that a file's rows aren't repeated."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias") and node.children().size() == 1:
        node = node.children().head()
    return node.nodeName() in ("LogicalRelation", "Relation") or node.nodeName().startswith("Relation")


def located(df: DataFrame) -> tuple[DataFrame, str, str]:
    """df with two more columns, and their names: the file that holds a row, and the row's number in it.

    Rows that come straight from files are where they are; others are written to the shared folder and read again.
    """
    path, row = fresh(df, "_path"), fresh(df, "_row")
    add = lambda d: d.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row))
    if _scanned(df):
        try:
            return add(df), path, row
        except AnalysisException:  # files of another format
            pass
    return add(written(df, "content")), path, row


def in_map(column: str, held) -> Column:
    """Whether a map made by bitmap() and broadcast has a long column's value; only that column goes through Python."""

    @F.arrow_udf("boolean")
    def has(values: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(held.value, values.to_numpy()))

    return has(F.col(column))


def joined_by_key(rows: DataFrame, keyed: DataFrame, key: str, count: str) -> DataFrame:
    """rows joined with keyed, which has each key once and says in `count` how many rows have it.

    Keys of more than 1/256 of the rows, and thus fewer than 256 keys, are joined by broadcast, so that no task gets all
    rows of a hot key; the others are joined as Spark sees fit.
    """
    total = keyed.agg(F.sum(count)).first()[0] or 0
    hot = keyed.filter(F.col(count) > max(500, total // 256))
    few = F.broadcast(hot)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.filter(F.col(count) <= max(500, total // 256)), key)
    return rows.join(few, key).unionByName(rest)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(array: pa.Array, limit: int = 1 << 19):
    """Rows of a text column in runs of about `limit` bytes: (first row, last row + 1, bytes, offsets in them).

    A longer text is a run of its own; texts are never cut.
    """
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    n = len(array)
    if not n:
        return
    offsets = np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + n + 1].astype(np.int64)
    held = array.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def powers(n: int, mult: int = _MULT) -> tuple[np.ndarray, np.ndarray]:
    """mult**i and mult**-i modulo 2**64 for i up to n."""
    have = _POW.get(mult)
    if have is None or len(have[0]) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        inverse = pow(mult, -1, 1 << 64)
        both = []
        for m in (mult, inverse):
            x = np.full(size, m, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        have = _POW[mult] = (both[0], both[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(values: np.ndarray, mult: int = _MULT) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), mult)[0][: len(values)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, first: np.ndarray, end: np.ndarray, mult: int = _MULT) -> np.ndarray:
    """Polynomial hashes of the spans [first, end) of the values that prefix_sums() has read."""
    return (sums[end] - sums[first]) * powers(len(sums), mult)[1][first]


def words(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; a word never crosses a text's border."""
    n = len(buf)
    inside = ~SPACE[buf]
    border = np.zeros(n + 1, bool)
    border[starts] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | border[1:n]
    last[:-1] &= ~inside[1:] | border[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_keys(codes: np.ndarray, first: np.ndarray, end: np.ndarray, limit: int = 1 << 16) -> np.ndarray:
    """64-bit keys of spans [first, end) of bytes, none of them empty: sums over at most 32 bytes, digests of longer ones."""
    size = end - first
    out = np.zeros(len(size), np.uint64)
    upto = np.concatenate([[0], np.cumsum(np.minimum(size, 32))])
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + limit, "right")) - 1)
        n = np.minimum(size[lo:hi], 32)
        begin = upto[lo:hi] - upto[lo]
        within = np.arange(upto[hi] - upto[lo]) - np.repeat(begin, n)
        out[lo:hi] = np.add.reduceat(_BYTE[codes[np.repeat(first[lo:hi], n) + within]] * _PLACE[within], begin)
        lo = hi
    out = mix(out + size.astype(np.uint64))
    for i in np.flatnonzero(size > 32).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(codes[first[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def word_hashes(buf: np.ndarray, starts: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of each word, and where each text's words begin (one more entry than texts)."""
    first, end = words(buf, starts)
    return span_keys(LOWER[buf] if lower else buf, first, end), np.searchsorted(first, starts)


def gram_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """64-bit keys of the runs of n words, by their words' keys."""
    count = len(w) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = w[:count] + np.uint64(n)
    for j in range(1, n):
        out = mix(out) + w[j : j + count]
    return mix(out)


def bitmap(df: DataFrame, column: str, most_bits: int = 27) -> np.ndarray:
    """A map of some 16 bits a row, but of 2**most_bits bits (16 MB) at most; the bit of each row's `column` (a long) is set.

    It only spares later steps rows that can't match, fewer of them where it is too small for df; what it lets through is
    joined exactly.
    """
    df = df.select(F.col(column).alias("x"))
    bits = min(most_bits, max(16, (16 * df.count()).bit_length()))
    place = F.col("x").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        df.select(F.shiftright(place, 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(x & 63 as int))").alias("b"))
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    values = values.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[values >> np.uint64(6)] >> (values & np.uint64(63))) & np.uint64(1) > 0
