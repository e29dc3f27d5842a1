"""Operator 10: secret scans by a trigram inverted index."""

from __future__ import annotations

import itertools
import re
import re._constants as C  # the parser of the standard library's regexes
import re._parser as parser
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, pieces, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, flags, and the least characters of a group (0: the match)."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    flags: int = re.ASCII
    base: bool = False

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in re.compile(self.pattern, self.flags).finditer(text) if len(m.group(self.group)) >= self.least]


# Kinds and patterns, the base kinds first, in the order that spans are listed in.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, re.ASCII | re.IGNORECASE, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, base=True),
    Rule("hex", r"[0-9a-f]+", 16, base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)

MOST = 64  # strings that a part of a pattern is followed through as; beyond, it counts as anything


def _lower(c: int) -> str:
    """A-Z lower-cased, as the index is; other characters as they are."""
    return chr(c).lower() if c < 128 else chr(c)


def _strings(tree) -> tuple[set[str] | None, list[frozenset[frozenset[str]]]]:
    """(all strings that this part matches exactly, or None if many; queries that hold whatever it matches).

    A query is a set of alternatives, each a set of strings that must all occur. Strings are lower-cased.
    """
    exact: set[str] | None = {""}
    queries = []

    def close():
        nonlocal exact
        if exact is not None and exact != {""}:
            queries.append(frozenset(frozenset([s]) for s in exact))
        exact = {""}

    for op, arg in tree:
        found: set[str] | None = None
        inner: list = []
        if op is C.LITERAL:
            found = {_lower(arg)}
        elif op is C.IN:
            chars = set()
            for o, a in arg:
                chars |= {_lower(a)} if o is C.LITERAL else {_lower(x) for x in range(a[0], a[1] + 1)} if o is C.RANGE and a[1] - a[0] < MOST else {None}
            found = None if None in chars or len(chars) > 8 else chars
        elif op is C.SUBPATTERN:
            found, inner = _strings(arg[-1])
        elif op is C.BRANCH:
            parts = [_strings(b) for b in arg[1]]
            if all(p[0] is not None for p in parts):
                found = set().union(*(p[0] for p in parts))
            elif all(p[1] for p in parts):
                inner = [frozenset(frozenset().union(*alts) for p in parts for alts in itertools.product(*p[1]))] if sum(len(p[1]) for p in parts) <= 8 else []
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, sub = arg
            s, q = _strings(sub)
            if s is not None and low == high and len(s) ** low <= MOST:
                found = {"".join(x) for x in itertools.product(s, repeat=low)}
            elif s is not None and low == 0 and high == 1:
                found = s | {""}
            elif low > 0:
                inner = q + ([frozenset(frozenset([x]) for x in s)] if s is not None else [])
        elif op is C.AT:
            found = {""}
        if found is not None and exact is not None and len(found) * len(exact) <= MOST:
            exact = {a + b for a in exact for b in found}
        else:
            close()
            if found is not None:
                exact = set(found)
                inner = []
            queries += inner
            if found is None:
                exact = {""}
    if queries:
        close()
        return None, queries
    return (exact, []) if len(tree) == 0 or exact != {""} or all(op in (C.AT, C.LITERAL, C.SUBPATTERN, C.BRANCH) for op, _ in tree) and not _open(tree) else (None, [])


def _open(tree) -> bool:
    """Whether a part can match something that isn't followed through."""
    return any(op in (C.MAX_REPEAT, C.MIN_REPEAT, C.ANY, C.IN, C.NOT_LITERAL, C.CATEGORY) or op is C.SUBPATTERN and _open(arg[-1]) for op, arg in tree)


def trigram_query(rule: Rule) -> list[frozenset[frozenset[bytes]]] | None:
    """A Boolean query over lower-case trigrams that every match of the rule satisfies: all of these, each any of its
    alternatives, each all of its trigrams. None if no trigram is mandatory: the rule scans fully."""
    tree = parser.parse(rule.pattern, rule.flags)
    if tree.state.flags & re.IGNORECASE and not tree.state.flags & re.ASCII:  # other scripts' letters match in either case, too
        return None
    exact, queries = _strings(tree)
    queries = list(queries) + ([frozenset(frozenset([s]) for s in exact)] if exact else [])
    out = []
    for q in queries:
        alts = set()
        for strings in q:
            grams = frozenset(b[i : i + 3] for s in strings for b in [s.encode()] for i in range(len(b) - 2))
            alts.add(grams)
        if alts and all(alts):
            out.append(frozenset(alts))
    return out or None


class Trigrams:
    """The trigrams of the rules' queries, any number of them, as sorted codes behind a small table of slots."""

    def __init__(self, grams: list[bytes]):
        self.grams = sorted(grams)
        self.codes = np.array([g[0] << 16 | g[1] << 8 | g[2] for g in self.grams], np.uint32)
        self.slots = np.zeros(1 << 16, bool)
        self.slots[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(0x9E3779B1)) >> np.uint32(16)

    def postings(self, buf: np.ndarray, starts: np.ndarray) -> dict[bytes, np.ndarray]:
        """The inverted index of a segment: for each of the trigrams, the rows whose text has it, rising."""
        low = LOWER[buf].astype(np.uint32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        at = np.flatnonzero(self.slots[self._slot(code)]) if len(self.codes) and len(low) > 2 else np.zeros(0, np.int64)
        which = np.minimum(np.searchsorted(self.codes, code[at]), len(self.codes) - 1)
        same = self.codes[which] == code[at] if len(at) else np.zeros(0, bool)
        at, which = at[same], which[same]
        row = np.searchsorted(starts, at, "right") - 1
        inside = at + 3 <= starts[row + 1]
        pair = np.unique(which[inside].astype(np.int64) << 40 | row[inside])
        gram, row = pair >> 40, pair & ((1 << 40) - 1)
        edge = np.searchsorted(gram, np.arange(len(self.grams) + 1))
        return {g: row[edge[i] : edge[i + 1]] for i, g in enumerate(self.grams)}


def candidates(query, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Rows that satisfy a query: postings of an alternative are intersected, alternatives united, parts intersected."""
    if query is None:
        return np.arange(n)
    out = None
    for alts in query:
        some = []
        for grams in alts:
            rows = None
            for g in sorted(grams, key=lambda g: len(index[g])):
                rows = index[g] if rows is None else np.intersect1d(rows, index[g], assume_unique=True)
            some.append(rows)
        rows = np.unique(np.concatenate(some))
        out = rows if out is None else np.intersect1d(out, rows, assume_unique=True)
    return out


def _found(rules: tuple[Rule, ...]):
    queries = [trigram_query(r) for r in rules]
    trigrams = Trigrams(list({g for q in queries if q for alts in q for a in alts for g in a}))

    def f(batches):
        for batch in batches:
            out = [[] for _ in range(len(batch))]
            text = batch.column("text")
            for lo, hi, buf, starts in pieces(text):
                index = trigrams.postings(buf, starts)
                for k, (rule, query) in enumerate(zip(rules, queries)):
                    for row in candidates(query, index, hi - lo).tolist():
                        out[lo + row] += [(a, k, b) for a, b in rule.spans(text[lo + row].as_py())]
            spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(x)] for x in out]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return f


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>>: what the rules match in each whole text, in code points.

    Each segment of a task's texts gets an inverted index of the rules' trigrams (A-Z lower-cased, so that it serves
    either case); a rule's candidates are the rows that its Boolean query keeps, and each is verified by the rule's
    regex over its whole text. A rule without mandatory trigrams runs over every text. Null and empty texts have no
    spans; repeated rows are scanned alike; a null doc_id stays null; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_found(rules), "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = [r.kind for r in RULES if r.base]
    joined = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in base], F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op10_secret_scan's result that SQL can express: base matches of each document."""
    return op10_secret_scan(spark, sf_dir).select("doc_id", *[f"n_{r.kind}" for r in RULES if r.base])


def _counted(rule: Rule) -> str:
    """SQL that counts a base rule's matches; letters in either case are spelt out, since folding there goes beyond ASCII."""
    pattern = rule.pattern.replace("'", "''")
    if rule.flags & re.IGNORECASE:
        words, rest = pattern.split(")", 1)
        pattern = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words) + ")" + rest
    return f"CAST(len([x for x in regexp_extract_all(coalesce(text, ''), '{pattern}', {rule.group}) if length(x) >= {rule.least}]) AS BIGINT) AS n_{rule.kind}"


SQL_COUNTS = f"SELECT doc_id, {', '.join(_counted(r) for r in RULES if r.base)} FROM documents"
