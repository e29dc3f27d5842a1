"""Operator 6: removal of byte strings that occur earlier in the corpus, by bucket-pointer refinement."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BYTE, bitmap, in_bitmap, mix, partitions, pieces, prefix_sums, span_hashes, text_or_empty, written

#: Bits of the maps of q-grams that occur twice and of those that occur very often.
MAP_BITS = 27
#: Places of a q-gram up to which one task refines its bucket; larger buckets are refined to the end in the shuffle.
LARGE = 4096
#: Bytes of a long text that are looked at together, and rows that a task refines together.
SEGMENT, ROWS = 1 << 20, 8192
_POS = np.uint64((1 << 28) - 1)
SCHEMA = "key long, okey long, tag long, first long, n int, off int, ctx binary"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _segments(array: pa.Array, length: int, segment: int):
    """(first row, bytes before, buffer, offsets of the texts in it): texts together, or parts of a long one that overlap."""
    for lo, _, buf, starts in pieces(array):
        if len(buf) <= segment + length:
            yield lo, 0, buf, starts
            continue
        for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            for at in range(0, b - a - length + 1, segment):
                part = buf[a + at : min(a + at + segment + length - 1, b)]
                yield lo + i, at, part, np.array([0, len(part)])


def _anchors(buf: np.ndarray, starts: np.ndarray, length: int, q: int):
    """For each string start s (a place with `length` bytes of its text ahead): where the least q-gram inside begins.

    Equal strings choose the same offset. Returns, per run of starts that share an anchor: anchor place, first start, number
    of starts, row, and the anchor's hash.
    """
    n, none = len(buf), (*(np.zeros(0, np.int64),) * 4, np.zeros(0, np.uint64))
    if n < length:
        return none
    sums = prefix_sums(_BYTE[buf])
    place = np.arange(n - q + 1)
    grams = mix(span_hashes(sums, place, place + q))
    x = (grams & ~_POS) | place.astype(np.uint64)
    width, have = length - q + 1, 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    x = np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x
    row = np.searchsorted(starts, np.arange(len(x)), "right") - 1
    s = np.flatnonzero(starts[row + 1] - np.arange(len(x)) >= length)
    if not len(s):
        return none
    a = (x[s] & _POS).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)
    at = np.flatnonzero(new)
    return a[at], s[at], np.diff(np.append(at, len(s))), row[s[at]], grams[a[at]]


def _counted(length: int, q: int):
    def f(batches):
        for batch in batches:
            for _, _, buf, starts in _segments(batch.column("text"), length, SEGMENT):
                yield pa.RecordBatch.from_arrays([pa.array(_anchors(buf, starts, length, q)[4].view(np.int64))], ["h"])

    return f


def _spread(*columns) -> np.ndarray:
    """Keys of rows that any task may take: even numbers that hash all columns."""
    x = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        x = mix(x + c.astype(np.int64).view(np.uint64))
    return (x & ~np.uint64(1)).view(np.int64)


def _placed(length: int, q: int, twice, often):
    """Rows of q-grams that occur again.

    Bucket rows have an odd key and the bytes around a q-gram. Of q-grams that occur very often there is a row for each
    string: the key is odd too, and the bytes are a digest of the string, the identifier of its last bucket. Of rows that agree
    in their bytes a batch gives the first; the others repeat it, and need no bucket: rows without bytes, with an even key.
    """

    def f(batches):
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy() for c in ("okey", "tag"))
            rows, starts_, firsts, counts, offs, keys, bytes_ = [], [], [], [], [], [], []
            for lo, before, buf, starts in _segments(batch.column("text"), length, SEGMENT):
                a, s, n, row, h = _anchors(buf, starts, length, q)
                again = in_bitmap(twice.value, h)
                a, s, n, row, h = a[again], s[again], n[again], row[again], h[again]
                many, raw = in_bitmap(often.value, h), buf.tobytes()
                few = np.flatnonzero(~many)
                if len(few):
                    bytes_ += [raw[i : i + k + length - 1] for i, k in zip(s[few].tolist(), n[few].tolist())]
                    rows.append(lo + row[few]), firsts.append(before + s[few] - starts[row[few]]), counts.append(n[few])
                    offs.append(length - q - (a[few] - s[few]))  # shifts starts so that equal strings meet
                    keys.append((h[few] | np.uint64(1)).view(np.int64))
                if many.any():
                    k = n[many]
                    at = np.repeat(s[many], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                    r = np.repeat(row[many], k)
                    ends = [hashlib.blake2b(raw[i : i + length], digest_size=16).digest() for i in at.tolist()]
                    bytes_ += ends
                    rows.append(lo + r), firsts.append(before + at - starts[r]), counts.append(np.ones(len(at), np.int64)), offs.append(np.full(len(at), -1))
                    keys.append((np.frombuffer(b"".join(ends), np.uint64)[::2] | np.uint64(1)).view(np.int64))
            if not rows:
                continue
            row, first, n, off, key = (np.concatenate(x) for x in (rows, firsts, counts, offs, keys))
            okey, tag = ids[row], tags[row]
            held: dict[bytes, int] = {}
            lead = np.zeros(len(row), np.int64)
            for i in np.lexsort((first, tag, okey)).tolist():
                lead[i] = held.setdefault(bytes_[i], i)
            leads = lead == np.arange(len(row))
            same = (okey == okey[lead]) & (tag == tag[lead]) & (first == first[lead])  # a row that is repeated whole
            key = np.where(leads, key, _spread(okey, first))
            keep = np.flatnonzero(leads | ~same)
            ctx = pa.array([bytes_[i] if leads[i] else None for i in keep.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(okey[keep]), pa.array(tag[keep]), pa.array(first[keep]), pa.array(n[keep].astype(np.int32)), pa.array(off[keep].astype(np.int32)), ctx], _NAMES)

    return f


def _same(*columns) -> np.ndarray:
    """True where a row equals the row before in all columns."""
    out = np.ones(len(columns[0]), bool)
    out[:1] = False
    for c in columns:
        out[1:] &= c[1:] == c[:-1]
    return out


def _ranked(*ids: np.ndarray) -> np.ndarray:
    """One number for each combination of identifiers, equal for equal ones alone."""
    bits = 63 // len(ids)
    if len(ids) > 1 and max(int(x.max(initial=0)) for x in ids) >= 1 << bits:
        return _ranked(_ranked(*ids[:-1]), ids[-1]) if len(ids) > 2 else np.unique(np.stack(ids, 1), axis=0, return_inverse=True)[1].ravel()
    x = ids[0]
    for y in ids[1:]:
        x = (x << bits) | y
    order = np.argsort(x)
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(~_same(x[order])) - 1
    return out


def _shared(*columns) -> np.ndarray:
    """Where rows are that agree with another row in all columns."""
    b = _ranked(*(c - c.min() for c in columns)) if len(columns[0]) else columns[0]
    return np.flatnonzero(np.bincount(b)[b] > 1) if len(b) else b


def _refined(key: np.ndarray, rank: np.ndarray, n: np.ndarray, off: np.ndarray, ctx: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of every string that a row of smaller rank in its bucket has too; rows are different contexts.

    A string's bucket is its q-gram and where in the string it lies. Every place has an identifier, at first its next eight
    bytes; three times as many bytes get theirs by sorting on the identifiers of a place and of the two places that these
    bytes lead on to, which were made in the round before. After each round only strings go on whose bucket and identifier
    another string shares, and only places that they need. At the end, strings agree in all bytes.
    """
    raw = np.frombuffer(b"".join(ctx), np.uint8)
    begins = np.cumsum(n + length - 1) - (n + length - 1)
    row = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    place, bucket = begins[row] + within, _ranked(_ranked(key[row]), within + off[row])
    step = min(8, length)
    ident = np.zeros(len(raw), np.int64)
    alive = _shared(bucket)
    row, within, place, bucket = row[alive], within[alive], place[alive], bucket[alive]

    def needed(span: int) -> np.ndarray:
        """Places from which `span` bytes lie within a string that goes on."""
        edge = np.zeros(len(raw) + 1, np.int32)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + length - span + 1, -1)
        return np.flatnonzero(np.cumsum(edge[:-1]) > 0)

    if len(place):
        at = needed(step)
        code = np.zeros(len(at), np.uint64)
        for j in range(step):
            code = (code << np.uint64(8)) | raw[at + j]
        order = np.argsort(code)
        ident[at[order]] = np.cumsum(~_same(code[order])) - 1
    while step < length and len(place):
        parts = 3 if 3 * step <= length else 2
        span = min(parts * step, length)
        alive = _shared(bucket, ident[place])
        row, within, place, bucket = row[alive], within[alive], place[alive], bucket[alive]
        at = needed(span)
        later = [ident[at + j * (span - step) // (parts - 1)] for j in range(parts)]
        ident[at] = _ranked(*later)
        step = span
    if not len(place):
        return row, within
    b = _ranked(bucket, ident[place])
    order = np.lexsort((rank[row], b))
    b, r = b[order], rank[row][order]
    begin = ~_same(b)
    least = r[np.flatnonzero(begin)][np.cumsum(begin) - 1]
    hit = order[r > least]
    return row[hit], within[hit]


def _repeats(length: int):
    """Rows sorted by (key, ctx, okey, tag, first) -> runs of starts whose string occurs earlier."""
    names = ["okey", "tag", "first", "n"]

    def solve(t: pa.Table):
        """Buckets of places whose bytes all differ."""
        key, okey, tag, first, n, off = (t.column(c).to_numpy() for c in _NAMES[:-1])
        at = _shared(np.unique(key, return_inverse=True)[1])
        order = np.lexsort((first[at], tag[at], okey[at]))
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(~_same(okey[at][order], tag[at][order], first[at][order]))
        ctx = t.column("ctx").take(pa.array(at)).to_pylist()
        row, within = _refined(np.unique(key[at], return_inverse=True)[1], rank, n[at].astype(np.int64), off[at].astype(np.int64), ctx, length)
        order = np.lexsort((within, row))
        row, within = row[order], within[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (within[1:] != within[:-1] + 1)
        s = np.flatnonzero(new)
        r = at[row[s]]
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (okey[r], tag[r], first[r] + within[s], np.diff(np.append(s, len(row))))], names)

    def f(batches):
        kept, lead = None, None
        for batch in batches:
            key, okey, tag, first, n, off = (batch.column(c).to_numpy() for c in _NAMES[:-1])
            repeats, firsts = [], []
            for i, (k, c) in enumerate(zip(key.tolist(), batch.column("ctx").to_pylist())):
                if not k & 1:  # repeats another row of its batch
                    repeats.append(i)
                elif lead is None or k != lead[0] or c != lead[1]:  # of rows with the same bytes the first stands for all
                    lead = k, c, (okey[i], tag[i], first[i])
                    if off[i] >= 0:
                        firsts.append(i)
                elif (okey[i], tag[i], first[i]) != lead[2]:
                    repeats.append(i)
            r = np.array(repeats, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[r].astype(np.int64)) for x in (okey, tag, first, n)], names)
            t = pa.Table.from_batches([batch.take(pa.array(firsts, pa.int64()))])
            kept = t if kept is None else pa.concat_tables([kept, t])
            if len(kept) >= ROWS:
                key = kept.column("key").to_numpy()
                edge = int(np.searchsorted(key, key[-1]))  # the last bucket waits for its end
                if edge:
                    yield solve(kept.slice(0, edge))
                    kept = kept.slice(edge)
        if kept is not None and len(kept):
            yield solve(kept)

    return f


def _kept(length: int):
    def f(batches):
        for batch in batches:
            ids, runs = batch.column("doc_id"), batch.column("runs").to_pylist()
            sizes, removed, spans, digests = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = text.encode()
                edge = np.zeros(len(raw) + 1, np.int32)
                for r in runs[i] or ():
                    edge[r["first"]] += 1
                    edge[r["first"] + r["n"] - 1 + length] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                sizes.append(len(raw)), removed.append(int(gone.sum()))
                spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
                digests.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes() if removed[-1] else raw).hexdigest())
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return f


def repeated_runs(docs: DataFrame, length: int = 100, map_bits: int = MAP_BITS) -> DataFrame:
    """docs (okey, tag, text) -> (okey, tag, first, n): runs of starts of `length`-byte strings that occur earlier.

    Every string is placed by its least q-gram (the same one in equal strings), so that some 1 in 35 places stand for
    all suffixes. q-grams that occur once are out; the others' places form the initial buckets. Of places with the same bytes
    around them one stands for all: they are merged in each batch, before the shuffle, and again in their bucket, which is
    then refined (_refined). A bucket of more than LARGE places isn't gathered: its strings are dealt out by 128-bit digests,
    the identifiers of their last buckets, and merged likewise. map_bits bounds the two maps of q-grams that are broadcast
    (16 MB at 27); where they are too small for the corpus, more places than needed reach the buckets.
    """
    spark = docs.sparkSession
    q = max(1, min(32, length // 3))
    counts = docs.select("text").mapInArrow(_counted(length, q), "h long").groupBy("h").count().filter("count > 1")
    counts = written(counts.selectExpr("h", f"count > {LARGE} AS often"), "again")
    twice = spark.sparkContext.broadcast(bitmap(counts, "h", map_bits))
    often = spark.sparkContext.broadcast(bitmap(counts.filter("often"), "h", map_bits))
    rows = docs.select("okey", "tag", "text").mapInArrow(_placed(length, q, twice, often), SCHEMA)
    rows = rows.repartition(partitions(spark), "key").sortWithinPartitions("key", "ctx", "okey", "tag", "first")
    return rows.mapInArrow(_repeats(length), "okey long, tag long, first long, n long")


def dedup_strings(docs: DataFrame, length: int = 100) -> DataFrame:
    """Removes each byte covered by a `length`-byte string that also starts earlier in the corpus.

    Earlier: in a document of smaller doc_id, or in the same document at a smaller place. Texts are UTF-8 bytes (null:
    empty); matches never cross documents; strings are judged on the input. A null doc_id comes last. Rows that repeat
    a doc_id with another text are ordered by the text's hash; rows equal in both are one document, so that each gets
    the same figures. Shorter or empty texts lose nothing. Other columns are ignored.
    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("okey"), F.xxhash64("text").alias("tag"))
    runs = repeated_runs(docs, length).groupBy("okey", "tag").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    joined = docs.join(runs, ["okey", "tag"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_kept(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_strings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 100)


SQL = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
g AS (SELECT doc_id, unnest([md5_number(substr(x, 2 * i - 1, 200)) FOR i IN range(1, n - 98)]) AS k, unnest(range(1, n - 98)) AS p FROM h),
hit AS (SELECT doc_id, p FROM g QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
e AS (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hit),
f AS (SELECT *, count(*) FILTER (before IS NULL OR p > before + 100) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM e),
r AS (SELECT doc_id, run, min(p) AS first, max(p) + 99 AS last FROM f GROUP BY ALL),
k AS (SELECT r.*, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY run), 0) AS upto FROM r),
t AS (SELECT doc_id, sum(last - first + 1) AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * upto + 1, 2 * (first - upto - 1)), '' ORDER BY run) || substr(any_value(x), 2 * max(last) + 1) AS kept
      FROM k JOIN h USING (doc_id) GROUP BY 1)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM h LEFT JOIN t USING (doc_id)
"""
