"""Operator 4: language identification by a string kernel with Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty, written

#: Bounds of the sample that is fitted: rows and landmarks per language, and landmarks of all languages.
ROWS, LANDMARKS, MOST_LANDMARKS = 1000, 48, 2048
#: Languages up to which the table of their rows is broadcast.
FEW = 10_000
RIDGE = 1e-2
ORDERS, TABLE_BITS, BATCH_CHARS, CELLS = (1, 2, 3), 20, 1 << 20, 1 << 24
#: Odd factors of the hashes that n-grams are looked up by, one after the other.
_FACTORS = [np.uint64(0x9E3779B97F4A7C15 + 2 * i * 0x51AF3C7D) for i in range(64)]


def _codes(text: np.ndarray):
    """Codes of all n-grams of a code point array, order by order (code points have 21 bits: three fit a word)."""
    x = text.astype(np.uint64)
    for n in ORDERS:
        if len(x) >= n:
            code = x[: len(x) - n + 1] + np.uint64(1)
            for j in range(1, n):
                code = (code << np.uint64(21)) | (x[j : len(x) - n + 1 + j] + np.uint64(1))
            yield n, code


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _distinct(codes: np.ndarray) -> np.ndarray:
    codes = np.sort(codes)
    return codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes


def spectrum(points: np.ndarray) -> np.ndarray:
    """The distinct n-grams of a text, all orders, part by part (parts overlap by an n-gram)."""
    out = np.zeros(0, np.uint64)
    for at in range(0, len(points), BATCH_CHARS):
        part = points[at : at + BATCH_CHARS + max(ORDERS) - 1]
        out = _distinct(np.concatenate([out, *(c for _, c in _codes(part))]))
    return out


class Alphabet:
    """The n-grams of the landmarks, found by hash tables: what a slot of one table has no room for is in the next."""

    def __init__(self, grams: np.ndarray):
        self.grams, self.tables, self.bits = grams, [], TABLE_BITS
        left = np.arange(len(grams))
        while len(left):
            slot = self._slot(grams[left], len(self.tables))
            table, more = np.full(1 << self.bits, -1, np.int32), np.zeros(1 << self.bits, bool)
            table[slot] = left
            held = table[slot] == left
            more[slot[~held]] = True
            self.tables.append((table, more))
            left = left[~held]

    def _slot(self, codes: np.ndarray, level: int) -> np.ndarray:
        return ((codes * _FACTORS[level % len(_FACTORS)]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of those codes that are in the alphabet, and which of its n-grams they are."""
        at, places, found = np.arange(len(codes)), [], []
        for level, (table, more) in enumerate(self.tables):
            slot = self._slot(codes[at], level)
            which = table[slot]
            hit = np.flatnonzero(which >= 0)
            hit = hit[self.grams[which[hit]] == codes[at[hit]]]
            places.append(at[hit]), found.append(which[hit])
            rest = more[slot]
            rest[hit] = False
            at = at[rest]
            if not len(at):
                break
        return np.concatenate(places or [at[:0]]), np.concatenate(found or [np.zeros(0, np.int32)])

    def presence(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: 0 and 1 for the alphabet's n-grams that the whole text has, and how many distinct n-grams it has at all."""
        out, norm = np.zeros((len(texts), len(self.grams)), np.float32), np.zeros(len(texts))
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (size + len(texts[hi]) <= BATCH_CHARS or hi == lo):
                size += len(texts[hi])
                hi += 1
            if size > BATCH_CHARS:  # one long text
                grams = spectrum(texts[lo])
                out[lo, self.find(grams)[1]], norm[lo] = 1, len(grams)
            elif size:
                ends = np.cumsum([len(p) for p in texts[lo:hi]])
                begins = np.concatenate([[0], ends[:-1]])
                for n, code in _codes(np.concatenate(texts[lo:hi])):
                    at, col = self.find(code)
                    row = np.searchsorted(ends, at, "right")
                    whole = at + n <= ends[row]
                    out[lo + row[whole], col[whole]] = 1
                    for i, (a, b) in enumerate(zip(begins.tolist(), ends.tolist())):
                        if b - n >= a:
                            c = np.sort(code[a : b - n + 1])
                            norm[lo + i] += 1 + np.count_nonzero(c[1:] != c[:-1])
            lo = hi
        return out, norm

    def rows(self) -> int:
        """Texts whose rows are made at a time."""
        return max(1, min(256, CELLS // max(1, len(self.grams))))


class Model:
    """Normalised blended-spectrum presence kernel on landmarks, a Nyström map, and one ridge regression per language."""

    def __init__(self, landmarks: list[np.ndarray], languages: list[str]):
        """landmarks: the n-grams of each."""
        self.languages = languages
        self.alphabet = Alphabet(_distinct(np.concatenate(landmarks or [np.zeros(0, np.uint64)])))
        # every n-gram of a landmark is in the alphabet, so that inner products over it are those over all n-grams
        norm = [np.sqrt(max(len(g), 1)) for g in landmarks]
        # which landmarks have each n-gram: lists by n-gram, as few landmarks have most of them
        self.norm = np.array(norm, np.float32)
        at = np.concatenate([np.searchsorted(self.alphabet.grams, g) for g in landmarks] or [np.zeros(0, np.int64)])
        of = np.repeat(np.arange(len(landmarks), dtype=np.uint16), [len(g) for g in landmarks])
        order = np.argsort(at, kind="stable")
        self.first, self.of = np.searchsorted(at[order], np.arange(len(self.alphabet.grams) + 1)), of[order]
        gram, step = np.zeros((len(landmarks), len(landmarks))), max(1, CELLS // max(1, len(landmarks)))
        for lo in range(0, len(self.alphabet.grams), step):
            part = self._dense(lo, min(lo + step, len(self.alphabet.grams)))
            gram += part.T @ part
        self.whole = self._dense(0, len(self.alphabet.grams)) if len(self.alphabet.grams) * len(landmarks) <= CELLS else None
        value, vector = np.linalg.eigh(gram)
        keep = value > 1e-6 * max(value.max(initial=0), 1e-12)
        self.nystrom = vector[:, keep] / np.sqrt(value[keep])
        self.weights = np.zeros((self.nystrom.shape[1], len(languages)))

    def _dense(self, lo: int, hi: int) -> np.ndarray:
        """The landmarks' presence of the n-grams lo to hi, over the root of their own number of n-grams."""
        out, count = np.zeros((hi - lo, len(self.norm)), np.float32), np.diff(self.first[lo : hi + 1])
        of = self.of[self.first[lo] : self.first[hi]]
        out[np.repeat(np.arange(hi - lo), count), of] = 1 / self.norm[of]
        return out

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Of each text with each landmark: shared n-grams over the root of the product of both counts of n-grams.

        The landmarks are a dense matrix where that has CELLS cells at most; else only the rows of n-grams that the texts
        have are made, some at a time, so that memory holds a list of n-grams and landmarks, not their product.
        """
        x, norm = self.alphabet.presence([_points(t) for t in texts])
        if self.whole is not None:
            out = x @ self.whole
        else:
            out = np.zeros((len(texts), len(self.norm)), np.float32)
            have, step = np.flatnonzero(x.any(axis=0)), max(1, CELLS // max(1, 8 * len(self.norm)))
            for lo in range(0, len(have), step):
                some = have[lo : lo + step]
                count = self.first[some + 1] - self.first[some]
                begin = np.cumsum(count) - count
                of = self.of[np.repeat(self.first[some] - begin, count) + np.arange(count.sum())]
                rows = np.zeros((len(some), len(self.norm)), np.float32)
                rows[np.repeat(np.arange(len(some)), count), of] = 1 / self.norm[of]
                out += x[:, some] @ rows
        return out / np.sqrt(np.maximum(norm, 1))[:, None]

    def features(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.nystrom

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        f = self.features(texts) @ self.weights
        best = f.argmax(1)
        return [self.languages[i] for i in best], np.clip(f[np.arange(len(f)), best], 0, 1)


def _spectra(batches):
    for batch in batches:
        grams = [spectrum(_points(t)).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(grams, pa.binary())], ["lang", "h", "grams"])


def _sums(model):
    """A task's part of the normal equations."""

    def f(batches):
        m = model.value
        place = {k: i for i, k in enumerate(m.languages)}
        a, step = np.zeros((m.nystrom.shape[1], m.nystrom.shape[1] + len(m.languages))), m.alphabet.rows()
        for batch in batches:
            for lo in range(0, len(batch), step):
                part = batch.slice(lo, step)
                phi = m.features(part.column("text").to_pylist())
                y = np.zeros((len(part), len(place)))
                y[np.arange(len(part)), [place[k] for k in part.column("lang").to_pylist()]] = 1
                a += phi.T @ np.hstack([phi, y])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(a)), pa.int32()), pa.array([x.tobytes() for x in a], pa.binary())], ["i", "a"])

    return f


def fit(docs: DataFrame, rows: int = ROWS, landmarks: int = LANDMARKS) -> Model | None:
    """Learns from text and lang of docs; None if no row has both a lang and a letter.

    Fitted on a bounded sample: about `rows` rows of each language (1.5 times as many are drawn by a hash of doc_id and
    text, so that runs agree), whatever their texts' lengths; of these, `landmarks` per language, MOST_LANDMARKS in all,
    span the kernel's feature space. The sums of the normal equations are made by the tasks that hold the sample. The rows of
    a language are never fewer because of their lengths: languages without a sampled row aren't learned.
    """
    spark, ridge = docs.sparkSession, RIDGE
    some = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = written(some.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    languages = counts.count()
    if not languages:
        return None
    each = max(1, min(landmarks, MOST_LANDMARKS // languages))
    h = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    drawn = some.join(F.broadcast(counts) if languages <= FEW else counts, "lang").withColumn("h", h)
    sample = written(drawn.filter(F.col("h") * F.col("n") < 1.5 * rows).select("text", "lang", "h").repartition(8), "sample")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    first = sample.withColumn("nth", nth).filter(F.col("nth") <= each).drop("nth").mapInArrow(_spectra, "lang string, h double, grams binary")
    marks = sorted((r["lang"], r["h"], bytes(r["grams"])) for r in first.toLocalIterator())[:MOST_LANDMARKS]
    if not marks:
        return None
    learned = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    model = Model([np.frombuffer(g, np.uint64) for _, _, g in marks], learned)
    held = spark.sparkContext.broadcast(model)
    d = model.nystrom.shape[1]
    total = np.zeros((d, d + len(learned)))
    for r in sample.select("text", "lang").mapInArrow(_sums(held), "i int, a binary").toLocalIterator():
        total[r["i"]] += np.frombuffer(r["a"])
    held.destroy()
    model.weights = np.linalg.solve(total[:, :d] + ridge * np.eye(d), total[:, d:])
    return model


def _predicted(model):
    def f(batches):
        for batch in batches:
            langs, scores = [], []
            step = model.value.alphabet.rows() if model is not None else 256
            for lo in range(0, len(batch), step):
                texts = batch.column("text").slice(lo, step).to_pylist()
                found, s = model.value.predict(texts) if model is not None else (["und"] * len(texts), np.zeros(len(texts)))
                letters = [any(map(str.isalpha, t)) for t in texts]
                langs += [x if ok else "und" for x, ok in zip(found, letters)]
                scores += [float(x) if ok else 0.0 for x, ok in zip(s, letters)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return f


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every row, from its whole text alone.

    `und` with score 0 if the text is null, empty or without a letter, or if nothing could be learned. Repeated rows get
    equal predictions; a null doc_id stays null; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model) if model is not None else None
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_predicted(held), "doc_id long, lang_pred string, score double")


def held_out(modulus: int, remainder: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = identify(docs, fit(docs.filter(~held_out(4, 2))))
    return out.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
