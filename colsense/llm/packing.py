"""Operator 8: best-fit packing of token sequences by a configuration linear program."""

from __future__ import annotations

import bisect
import functools
import itertools
import math
import os
import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, SPACE, given_back, pieces, span_keys, text_or_empty, written

#: Classes of lengths in the linear program; lengths up to 1 / SAND of a sequence are left to the end.
CLASSES, SAND = 64, 32
#: Parts of texts that a worker keeps the ids of.
KEPT_WORDS = 200_000
#: Bytes a text is cut between, besides white space: ASCII letters, and marks other than ' and | that follow one.
LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[list(string.ascii_letters.encode())] = True
MARK[[c for c in string.punctuation.encode() if c not in b"'|"]] = True
SCHEMA = "doc_id long, chunk int, piece int, start long, length int, ids_crc32 long, nth long"


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _parts(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each part of the texts: words between ASCII white space, cut where a mark follows a letter.

    The vocabulary's pattern ends a run of letters at such a mark, and normal forms never join the two, so that a
    text's ids are those of its parts, one after the other.
    """
    inside = ~SPACE[buf]
    border = np.zeros(len(buf) + 1, bool)
    border[starts] = True
    border[1:-1] |= LETTER[buf[:-1]] & MARK[buf[1:]]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last[:-1] &= ~inside[1:] | border[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class _Kept:
    """Ids of the parts met so far, by 64-bit hash; parts that are new are encoded many at a time."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.clear()

    def clear(self):
        self.slot: dict[int, int] = {}
        self.first, self.flat = np.zeros(1, np.int64), np.zeros(0, "<u4")  # where each slot's ids begin, and all ids

    def _learn(self, parts: list[str]) -> None:
        ids, counts = [], []
        groups = [parts[lo : lo + 256] for lo in range(0, len(parts), 256)]
        for group, e in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            begins = np.cumsum([0] + [len(p) + 1 for p in group])
            at = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
            counts.append(np.diff(np.searchsorted(at, begins)))
            ids.append(np.array(e.ids, "<u4"))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(counts))])
        self.flat = np.concatenate([self.flat, *ids])

    def encoded(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in buf, and where each text's begin (one more entry than texts)."""
        first, end = _parts(buf, starts[:-1][starts[:-1] < len(buf)])
        raw = buf.tobytes()
        # the tokenizer lowers letters, but looks for special tokens before it does
        keys, one, which = np.unique(span_keys(buf if b"<|" in raw else LOWER[buf], first, end), return_index=True, return_inverse=True)
        if len(self.slot) > KEPT_WORDS:
            self.clear()
        slot = np.fromiter(map(self.slot.get, keys.tolist(), itertools.repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(slot < 0)
        if len(new):
            n = len(self.slot)
            self._learn([raw[i:j].decode() for i, j in zip(first[one[new]].tolist(), end[one[new]].tolist())])
            slot[new] = np.arange(n, n + len(new))
            self.slot.update(zip(keys[new].tolist(), range(n, n + len(new))))
        slot = slot[which]
        count = self.first[slot + 1] - self.first[slot]
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.repeat(self.first[slot] - upto[:-1], count) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(first, starts)]


@functools.cache
def _kept(path: str) -> _Kept:
    """One per worker: its tasks share what it has met."""
    return _Kept(_tokenizer(path))


def _cut(path: str, capacity: int, end: int):
    def f(batches):
        kept, chunk = _kept(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)  # pieces of each length so far in this task
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for lo, hi, buf, starts in pieces(batch.column("text"), 1 << 20):
                ids, at = kept.encoded(buf, starts)
                rows = []
                for doc, i, j in zip(docs[lo:hi], at[:-1].tolist(), at[1:].tolist()):
                    raw = ids[i:j].tobytes() + last
                    for piece, start in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[start : start + 4 * capacity]
                        size = len(part) // 4
                        rows.append((doc, chunk, piece, start // 4, size, zlib.crc32(part), int(seen[size])))
                        seen[size] += 1
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in SCHEMA.split(", ")])

    return f


def _best_fit(histogram: dict[int, int], room: int, begun=()) -> list[tuple[dict[int, int], int]]:
    """Best fit of falling lengths, for all sequences of the same contents at once; `begun` are sequences that have room left."""
    free: dict[int, list] = {}  # room left -> [contents, how many sequences]
    rooms: list[int] = []

    def put(config, times, r):
        if r not in free:
            free[r] = []
            bisect.insort(rooms, r)
        free[r].append((config, times))

    for config, times in begun:
        put(config, times, room - sum(s * k for s, k in config.items()))
    for size in sorted(histogram, reverse=True):
        n = histogram[size]
        while n:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                r = rooms[at]
                config, times = free[r].pop()
                if not free[r]:
                    del free[r], rooms[at]
            else:
                r, config, times = room, {}, n
            k = min(r // size, n)
            used = min(times, n // k)
            for c, m, x in ((config | {size: config.get(size, 0) + k}, used, r - k * size), (config, times - used, r)):
                if m and c:
                    put(c, m, x)
            n -= used * k
    return [x for r in rooms for x in free[r]]


class _Knapsack:
    """The pricing problem: configurations of lengths that fill at most `room` and whose prices add up to the most.

    A table over all fills, where each length comes in bundles of 1, 2, 4, .. as often as it fits; with what each bundle has
    improved, the configuration of the highest price is read back for any fill.
    """

    def __init__(self, sizes: np.ndarray, prices: np.ndarray, room: int):
        self.sizes, self.room, self.bundles = sizes.tolist(), room, []
        self.best = np.zeros(room + 1)
        for j, size in enumerate(self.sizes):
            k = 1
            while k * size <= room:
                x = self.best[: room + 1 - k * size] + k * prices[j]
                better = x > self.best[k * size :]
                self.best[k * size :][better] = x[better]
                self.bundles.append((j, k, better))
                k *= 2

    def configuration(self, first: int | None = None) -> tuple[tuple[int, int], ...]:
        """The best configuration, or the best of those with length number `first`: (number of a length, count) pairs."""
        taken, c = {} if first is None else {first: 1}, self.room - (0 if first is None else self.sizes[first])
        for j, k, better in reversed(self.bundles):
            weight = k * self.sizes[j]
            if c >= weight and better[c - weight]:
                taken[j] = taken.get(j, 0) + k
                c -= weight
        return tuple(sorted(taken.items()))


def linear_program(sizes: np.ndarray, counts: np.ndarray, room: int, eps: float = 0.1, most_tables: int = 2000) -> tuple[dict, float, float]:
    """The covering program min sum x_c, sum_c a_ic x_c >= counts_i, by multiplicative weights: (x, its value, a lower bound).

    A length's weight falls by exp(-eps) for each unit that it is covered, a unit being the largest share of a count that the
    step covers; its price is weight / count. Knapsack tables find the configurations of the highest price, one for each
    length; while one's price is within 1 - eps of the highest of the last table, x takes it. Lengths that are covered
    log(lengths) / eps ** 2 times are done, and x, divided by the least coverage, is feasible, its value within some 1 + 2 eps
    of the optimum. For any prices, their sum over all pieces divided by the highest price of a configuration is a lower bound:
    the value is returned with the best of these, so that the gap is known.
    """
    n, need = len(sizes), counts.astype(float).tolist()
    goal = math.log(max(n, 2)) / eps**2
    cover, weight, x = [0.0] * n, [1.0] * n, {}
    bound = float(sizes @ counts) / room
    for _ in range(most_tables):
        if min(cover) >= goal:
            break
        prices = [w / h for w, h in zip(weight, need)]
        table = _Knapsack(sizes, np.array(prices), room)
        top = float(table.best[room])
        bound = max(bound, sum(weight) / top)
        for first in (None, *(i for i in range(n) if weight[i])):
            config = table.configuration(first)
            unit = min(need[i] / k for i, k in config)
            while sum(k * prices[i] for i, k in config) >= (1 - eps) * top:
                x[config] = x.get(config, 0.0) + unit
                for i, k in config:
                    cover[i] += unit * k / need[i]
                    weight[i] = math.exp(-eps * cover[i]) if cover[i] < goal else 0.0
                    prices[i] = weight[i] / need[i]
    least = min(cover)
    return {c: v / least for c, v in x.items()}, sum(x.values()) / least, bound


def _classes(histogram: dict[int, int], room: int) -> list[list[int]]:
    """Lengths in classes that the program counts as one, by their longest: every length by itself if at most CLASSES are
    over room / SAND, else runs of about equal tokens. Shorter ones are in none."""
    sizes = [s for s in sorted(histogram, reverse=True) if SAND * s > room]
    if len(sizes) <= CLASSES:
        return [[s] for s in sizes]
    total, upto, out = sum(s * histogram[s] for s in sizes), 0, {}
    for s in sizes:
        out.setdefault(upto * CLASSES // total, []).append(s)
        upto += s * histogram[s]
    return list(out.values())


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Configurations (length -> count, filling at most `room`) with multiplicities that hold exactly `histogram`.

    The configuration linear program over the lengths above room / SAND, in at most CLASSES classes, is solved by
    multiplicative weights. Its solution is rounded down; each class of a configuration then stands for real pieces, longest
    first, and all pieces that are left, short ones too, go into the room that their exact lengths leave, by best fit, and into
    more sequences. Best fit alone is planned before: where it needs no more sequences than all tokens fill, no program has
    less, and it is returned at once; else the plan of fewer sequences is. Pieces keep their exact lengths throughout. Depends
    on the number of lengths and on the logarithm of their counts alone.
    """
    count = lambda configs: sum(times for _, times in configs)
    fit = _best_fit(histogram, room)
    groups = _classes(histogram, room)
    if room * (count(fit) - 1) < sum(s * n for s, n in histogram.items()) or not groups:
        return fit
    x, _, _ = linear_program(np.array([g[0] for g in groups]), np.array([sum(histogram[s] for s in g) for g in groups]), room)
    left = dict(histogram)
    stock = [[[s, histogram[s]] for s in reversed(g)] for g in groups]  # the longest at the end
    begun = []
    for config, times in sorted(x.items(), key=lambda c: (-c[1], c[0])):
        times = min([math.floor(times + 1e-9), *(sum(n for _, n in stock[j]) // k for j, k in config)])
        while times > 0:
            same = min([times, *(stock[j][-1][1] // k for j, k in config)])  # sequences of the same exact lengths
            made: dict[int, int] = {}
            for j, k in config:
                take = k * max(same, 1)
                while take:
                    size, n = stock[j][-1]
                    used = min(take, n)
                    made[size] = made.get(size, 0) + (k if same else used)
                    take -= used
                    stock[j][-1][1] -= used
                    if not stock[j][-1][1]:
                        stock[j].pop()
            begun.append((made, max(same, 1)))
            for size, k in made.items():
                left[size] -= k * max(same, 1)
            times -= max(same, 1)
    best = _best_fit({s: n for s, n in left.items() if n}, room, begun)
    return min(best, fit, key=count)


def _slots(configs) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per size: first rank of each run, how many per sequence there, and the run's first sequence."""
    rows: dict[int, list] = {}
    upto: dict[int, int] = {}
    sequence = 0
    for config, times in configs:
        for size, k in config.items():
            rows.setdefault(size, []).append((upto.get(size, 0), k, sequence))
            upto[size] = upto.get(size, 0) + k * times
        sequence += times
    return {s: tuple(np.array(x, np.int64) for x in zip(*r)) for s, r in rows.items()}


def _assigned(slots):
    def f(batches):
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            out = np.zeros(len(size), np.int64)
            for s in np.unique(size):
                first, k, sequence = slots.value[int(s)]
                at = np.flatnonzero(size == s)
                run = np.searchsorted(first, rank[at], "right") - 1
                out[at] = sequence[run] + (rank[at] - first[run]) // k[run]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "sequence_id"])

    return f


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """Pieces of documents' token ids and their places in sequences of at most `capacity` tokens.

    A document's ids are the tokenizer's, without special tokens, then `end`; longer ones are cut every `capacity` ids.
    The histogram of exact lengths (at most `capacity` numbers, whatever the input) is planned by plan(); a piece then
    finds its sequence from its rank among pieces of its length: ranks are counted per scan task and shifted by the counts
    of the tasks before, so that no length, however frequent, is gathered anywhere. Null and empty texts are the one id
    `end`. Repeated rows are packed as often as they occur; a null doc_id stays null; other columns are ignored; an
    empty table gives no rows. tokenizer: path of the vocabulary, the same on every machine.
    """
    spark = docs.sparkSession
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(given_back(_cut(tokenizer, capacity, end)), SCHEMA)
    cut = written(cut, "pieces")
    counts = cut.groupBy("chunk", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan(histogram, capacity)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")
    ranked = cut.join(counts.select("chunk", "length", before.alias("before")), ["chunk", "length"])
    ranked = ranked.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    placed = ranked.mapInArrow(_assigned(slots), "doc_id long, piece int, start long, length long, ids_crc32 long, rank long, sequence_id long")
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("offset", F.sum("length").over(ahead) - F.col("length")).drop("rank")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), vocabulary())
