"""The k nearest labelled columns by the cosine of their characters, without comparing all pairs of columns.

Labelled columns are placed in blocks around pivots. The members of a block lie within ranges of angles to its pivot and to
some marks, so that a column's own angles to these bound its cosines to all of them. A column is first compared with the
blocks nearest to it, which gives a cosine that k columns reach; then with those other blocks alone whose bound reaches it.
Blocks are compared as matrices: a task holds the members of a part of a block, the columns that ask for it pass by, and
only the pairs that can be among the nearest leave the task.
How much that saves is up to the columns: blocks of unlike columns are left out, but among columns that differ from a common
centre by chance alone no bound tells far ones from near ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.store import written
from .profile import of_whole

CODES = [chr(i) for i in range(32, 127)]
#: Pivots go by the square root of the labelled columns, up to this many: 3 MB of vectors, which the tasks are sent.
PIVOTS = 4096
#: Of them, those whose angles every block keeps the range of.
MARKS = 16
#: Labelled columns to a matrix of members, about: 3 MB; a block has as many matrices as it needs.
CHUNK = 4096
#: Columns that ask for the same block are dealt out over this many copies of it.
SALTS = 8
#: Characters of a value that go to Python at once.
LONG = 256
#: Labelled columns to a task, all blocks taken together.
SHARE = 2048
#: Rows of a matrix in a task: with all pivots 16 MB.
ROWS = 512
#: Bounds are widened by these, far more than rounding can move them.
ANGLE, COSINE = 1e-6, 1e-8


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(column_id, ch, n) of batches of counted values: their characters as places in CODES, each a byte of its own in UTF-8."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column("value").cast(pa.string()).fill_null("")
        ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
        data = values.buffers()[2]
        data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        names = batch.column("column_id").dictionary_encode(null_encoding="encode")
        row = np.repeat(np.arange(len(values), dtype=np.int32), np.diff(ends))
        kept = np.flatnonzero((data >= ord(CODES[0])) & (data <= ord(CODES[-1])))
        row, ch = row[kept], data[kept] - ord(CODES[0])
        sums = np.bincount(names.indices.to_numpy()[row].astype(np.int64) * len(CODES) + ch, batch.column("cnt").to_numpy()[row])
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(at // len(CODES))), pa.array((at % len(CODES)).astype(np.int32)), pa.array(np.rint(sums[at]).astype(np.int64))], names=["column_id", "ch", "n"])


def vectors(counts: DataFrame) -> DataFrame:
    """(column_id, v): each column's printable ASCII characters as a vector of length 1. Columns without any are left out.

    Characters are added up where values are, a batch at once, values of more than LONG characters in pieces.
    """
    cnt = F.col("cnt") if "cnt" in counts.columns else F.lit(1).cast("long").alias("cnt")
    pieces = F.when(F.length("value") <= LONG, F.array("value")).otherwise(F.regexp_extract_all("value", F.lit(f"(?s).{{1,{LONG}}}"), F.lit(0)))
    n = of_whole(counts).select("column_id", cnt, F.explode(pieces).alias("value")).mapInArrow(_sums, f"column_id {dict(counts.dtypes)['column_id']}, ch int, n long")
    n = n.groupBy("column_id", "ch").agg(F.sum("n").alias("n")).groupBy("column_id").agg(F.map_from_entries(F.collect_list(F.struct("ch", F.col("n").cast("double")))).alias("m"))  # at most 95 entries
    n = n.select("column_id", F.array(*[F.coalesce(F.try_element_at("m", F.lit(c)), F.lit(0.0)) for c in range(len(CODES))]).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return n.select("column_id", F.zip_with("v", F.array_repeat(norm, len(CODES)), lambda x, m: x / m).alias("v"))  # in a lambda of its own the norm would be taken for each component


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of batches with the matrix of their vectors."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(CODES))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def _placed(known: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(other, g, packed vector, block, angles): known with the block of the nearest pivot and the angles to that pivot and to the marks."""

    def place(batches):
        for part, x in _slices(batches):
            cosines = x @ pivots.T
            block = cosines.argmax(1)
            angles = _angles(np.column_stack([cosines[np.arange(len(x)), block], cosines[:, :MARKS]]))
            packed, names = _packed(x)
            yield pa.RecordBatch.from_arrays([part.column("other"), part.column("g"), *packed, pa.array(block.astype(np.int32)), pa.array(list(angles))], names=["other", "g", *names, "block", "angles"])

    kinds = dict(known.dtypes)
    return known.mapInArrow(place, f"other {kinds['other']}, g {kinds['g']}, b0 long, b1 long, x array<double>, block int, angles array<double>")


def _packed(x: np.ndarray) -> tuple[list[pa.Array], list[str]]:
    """Vectors as columns: which components aren't 0, as bits of two longs, and these components."""
    has = x != 0
    bits = np.packbits(np.pad(has, ((0, 0), (0, 128 - x.shape[1]))), axis=1).view(np.int64)
    ends = np.concatenate([[0], np.cumsum(has.sum(1))]).astype(np.int32)
    return [pa.array(bits[:, 0].copy()), pa.array(bits[:, 1].copy()), pa.ListArray.from_arrays(pa.array(ends), pa.array(x[has]))], ["b0", "b1", "x"]


def _unpacked(batch: pa.RecordBatch) -> np.ndarray:
    bits = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("b0", "b1")])
    out = np.zeros((batch.num_rows, len(CODES)))
    out[np.unpackbits(bits.view(np.uint8), axis=1)[:, : len(CODES)].astype(bool)] = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return out


def _asked(columns: DataFrame, pivots: np.ndarray, spare: np.ndarray, ranges: np.ndarray, k: int, first: bool) -> DataFrame:
    """(column_id, bar, block, packed vector): the nearest blocks that hold k columns for sure, or the other blocks that may reach `bar`."""

    def ask(batches):
        for part, x in _slices(batches):
            cosines = x @ pivots.T
            order = np.argsort(-cosines, axis=1, kind="stable")
            enough = (np.cumsum(spare[order], axis=1) <= k).sum(1) + 1  # one more than k: the column itself may be among them
            early = np.empty_like(order)
            np.put_along_axis(early, order, np.arange(len(pivots))[None, :].repeat(len(x), 0), axis=1)
            wanted = early < enough[:, None]
            bar = np.full(len(x), -1.0)
            if not first:
                angles = _angles(cosines)
                away = np.maximum(angles - ranges[1, :, 0], ranges[0, :, 0] - angles)  # at least so far from any member
                for m in range(1, ranges.shape[2]):
                    mark = angles[:, m - 1, None]
                    away = np.maximum(away, np.maximum(mark - ranges[1, :, m], ranges[0, :, m] - mark))
                bound = np.cos(np.clip(away - ANGLE, 0, np.pi))
                bar = np.nan_to_num(part.column("bar").to_numpy(zero_copy_only=False).astype(float), nan=-1.0)
                wanted = ~wanted & (bound >= bar[:, None] - COSINE)
            row, block = np.nonzero(wanted)
            take, (packed, names) = pa.array(row), _packed(x)
            yield pa.RecordBatch.from_arrays([part.column("column_id").take(take), pa.array(bar[row]), pa.array(block.astype(np.int32)), *[c.take(take) for c in packed]], names=["column_id", "bar", "block", *names])

    return columns.mapInArrow(ask, f"column_id {dict(columns.dtypes)['column_id']}, bar double, block int, b0 long, b1 long, x array<double>")


def _compared(k: int):
    """Rows sorted by (block, chunk, salt, member first, id): of each column that asks, the pairs with the chunk's members that may be its nearest.

    Of a chunk these are its k nearest members of each group, and of them those that reach `bar`.
    """

    def f(batches):
        at, parts, ids, groups, held = None, [], [], [], None
        for batch in batches:
            place = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "chunk", "salt", "asks")])
            x = _unpacked(batch)
            cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(1)) + 1).tolist(), len(place)] if len(place) else [0]
            found = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if at != tuple(place[lo, :3]):
                    at, parts, ids, groups, held = tuple(place[lo, :3]), [], [], [], None
                if not place[lo, 3]:
                    parts.append(x[lo:hi]), ids.append(batch.column("id").slice(lo, hi - lo)), groups.append(batch.column("g").slice(lo, hi - lo))
                    continue
                if held is None:
                    if not parts:
                        continue  # none of the block's members is in this chunk
                    code = pa.concat_arrays(groups).dictionary_encode()
                    code = np.unique(code.indices.fill_null(len(code.dictionary)).to_numpy(zero_copy_only=False), return_inverse=True)[1]
                    by = np.argsort(code, kind="stable")  # members of a group stay in the order of ids
                    edges = np.searchsorted(code[by], np.arange(code.max() + 2))
                    ends = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                    held = np.concatenate(parts)[by], pa.concat_arrays(ids).take(pa.array(by)), pa.concat_arrays(groups).take(pa.array(by)), ends
                members, names_, of, ends = held
                bar = batch.column("bar").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                own = pa.compute.index_in(batch.column("id").slice(lo, hi - lo), names_).fill_null(-1).to_numpy(zero_copy_only=False)
                for a in range(lo, hi, ROWS):
                    b = min(a + ROWS, hi)
                    cosines = x[a:b] @ members.T
                    mine = own[a - lo : b - lo]
                    cosines[np.flatnonzero(mine >= 0), mine[mine >= 0]] = 0  # itself
                    floor = np.maximum(bar[a - lo : b - lo] - COSINE, 0)
                    for first, last in ends:
                        some = cosines[:, first:last]
                        row, col = np.nonzero((some > 0) & (some >= floor[:, None]))
                        if last - first > k and len(row) > k:
                            n = np.round(some[row, col], 9)
                            order = np.lexsort((col, -n, row))
                            nth = np.arange(len(row)) - np.searchsorted(row[order], row[order], "left")
                            row, col = row[order][nth < k], col[order][nth < k]
                        found.append((row + a, col + first, some[row, col]))
                if found:
                    row, col = (np.concatenate([z[i] for z in found]) for i in (0, 1))
                    other = pa.array(col)
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), names_.take(other), of.take(other), pa.array(np.concatenate([z[2] for z in found]))], names=["column_id", "other", "g", "cosine"])
                    found = []

    return f


def _pairs(asked: DataFrame, placed: DataFrame, chunks: DataFrame, k: int) -> DataFrame:
    """(column_id, other, g, cosine): columns and the nearest members of the blocks they ask for. Pairs without a common character are left out."""
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    kinds, packed = dict(placed.dtypes), ["b0", "b1", "x"]
    asked = asked.join(F.broadcast(chunks), "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    asked = asked.select("block", "chunk", F.pmod(F.xxhash64("column_id"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(1).alias("asks"), F.col("column_id").alias("id"), F.lit(None).cast(kinds["g"]).alias("g"), "bar", *packed)
    members = placed.join(F.broadcast(chunks), "block").select("block", F.pmod(F.xxhash64("other"), F.col("chunks")).cast("int").alias("chunk"), F.explode(salts).alias("salt"), F.lit(0).alias("asks"), F.col("other").alias("id"), "g", F.lit(None).cast("double").alias("bar"), *packed)
    parts = max(2 * placed.sparkSession.sparkContext.defaultParallelism, -(-placed.count() // SHARE))  # their work isn't told by their bytes
    both = members.union(asked).repartition(parts, "block", "chunk", "salt").sortWithinPartitions("block", "chunk", "salt", "asks", "id")
    return both.mapInArrow(_compared(k), f"column_id {kinds['other']}, other {kinds['other']}, g {kinds['g']}, cosine double")


def _best(pairs: DataFrame, k: int, grouped: bool) -> DataFrame:
    """The nearest k of each column, or of each column and group."""
    order = [F.desc(F.round("cosine", 9)), "other"]
    by = ["column_id", "g"] if grouped else ["column_id"]
    return pairs.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("nth") <= k)


def _left(best: DataFrame, k: int) -> DataFrame:
    """best of groups with `left`: how many columns, up to this one, are left whichever group goes."""
    run = Window.partitionBy("column_id").orderBy(F.desc(F.round("cosine", 9)), "other").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return best.withColumn("left", F.count("*").over(run) - F.max("nth").over(run))


def nearest(columns: DataFrame, labelled: DataFrame, k: int, group: str | None = None) -> DataFrame:
    """(column_id, other, cosine): the k labelled columns with the highest cosine to each column, itself left out.

    columns(column_id, v) are `vectors`, labelled(column_id [, group]). Cosines are ordered by nine digits, ties by smaller
    id; pairs without a common character don't count, so that a column may have fewer than k. The result is that of comparing
    all pairs. With group, the rows hold the k nearest whichever one group is left out: at most k of a group and, but for
    columns with too few partners, at most 2 * k.
    Of labelled columns with the same vector (and group) only the k + 1 smallest ids can be among the nearest; others go first.
    """
    if k < 1:
        raise ValueError("k must be above 0")
    columns = written(columns.select("column_id", "v"))
    known = labelled.select(F.col("column_id").alias("other"), (F.col(group) if group else F.lit(0)).alias("g")).distinct()
    same = Window.partitionBy("v", "g").orderBy("other")
    known = columns.withColumnRenamed("column_id", "other").join(known, "other").withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1)
    known = written(known.select("other", "g", "v"))
    n = known.count()
    if not n:
        return known.select(F.col("other").alias("column_id"), "other", F.lit(0.0).alias("cosine"))
    some = known.orderBy(F.xxhash64("other"), "other").limit(min(PIVOTS, int(np.ceil(np.sqrt(n))))).select("v").collect()
    pivots = np.array([r["v"] for r in some])
    placed = written(_placed(known, pivots))
    marks = range(1 + min(MARKS, len(pivots)))
    ends = [f(F.col("angles")[m]).alias(f"{name}{m}") for m in marks for f, name in ((F.min, "low"), (F.max, "high"))]
    sizes = placed.groupBy("block", "g").count().groupBy("block").agg(F.sum("count").alias("n"), F.max("count").alias("most"))
    spare, ranges, chunks = np.zeros(len(pivots), np.int64), np.zeros((2, len(pivots), len(marks))), []
    for r in sizes.join(placed.groupBy("block").agg(*ends), "block").collect():  # a row for each pivot
        spare[r["block"]] = r["n"] - (r["most"] if group else 0)
        ranges[:, r["block"]] = [[r[f"low{m}"] for m in marks], [r[f"high{m}"] for m in marks]]
        chunks.append((r["block"], -(-r["n"] // CHUNK)))
    chunks = columns.sparkSession.createDataFrame(chunks, "block int, chunks int")
    early = written(_best(_pairs(_asked(columns, pivots, spare, ranges, k, True), placed, chunks, k), k, bool(group)))
    if group:
        bars = _left(early, k).filter(F.col("left") >= k).groupBy("column_id").agg(F.max("cosine").alias("bar"))
    else:
        bars = early.groupBy("column_id").agg(F.when(F.count("*") == k, F.min("cosine")).alias("bar"))
    late = _pairs(_asked(columns.join(bars, "column_id", "left"), pivots, spare, ranges, k, False), placed, chunks, k)
    best = _best(early.drop("nth").unionByName(late), k, bool(group))
    if group:
        best = _left(best, k).withColumn("before", F.lag("left").over(Window.partitionBy("column_id").orderBy(F.desc(F.round("cosine", 9)), "other"))).filter(F.coalesce("before", F.lit(0)) < k)
    return best.select("column_id", "other", "cosine")
