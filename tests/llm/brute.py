"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

SPACE = re.compile("[\x20\x09-\x0d]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, n: int) -> set:
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(docs: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = [(d, shingles(t, n)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            by[g].append(i)
    seen = set()
    for rows in by.values():
        for a in range(len(rows)):
            for b in range(a + 1, len(rows)):
                seen.add((rows[a], rows[b]))
    for a, b in seen:
        x, y = sets[a][1], sets[b][1]
        both = len(x & y)
        if 100 * both >= percent * (len(x) + len(y) - both):
            ra, rb = root(sets[a][0]), root(sets[b][0])
            parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(s), root(d)) for d, s in sets}


def repeated(docs: list[tuple[int, str | None]], length: int) -> dict[int, tuple[int, int, int, str]]:
    seen: set[bytes] = set()
    out = {}
    for d, t in sorted(docs):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        upto = 0
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                lo = max(i, upto)
                gone[lo : i + length] = b"\x01" * (i + length - lo)
                upto = i + length
            else:
                seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(said.encode()).hexdigest())


def pieces(text: str | None, tokenizer, capacity: int = 4096) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document."""
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    out = []
    for i, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at : at + capacity]
        out.append((i, at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    return out


def merkle(rows: list[tuple], fanout: int = 16) -> dict:
    """(doc_id, leaf) -> (subroot, root, digest of the proof) of rows (doc_id, source, lang, n_chars, text)."""
    h = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    runs = lambda x: [x[i : i + fanout] for i in range(0, len(x), fanout)]

    def tree(digests):
        """Root and, per leaf, the siblings on its way up."""
        paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
        while len(level) > 1:
            for i, p in enumerate(paths):
                run = level[at[i] // fanout * fanout :][:fanout]
                p += [d for j, d in enumerate(run) if j != at[i] % fanout]
            at = [i // fanout for i in at]
            level = [h(*r) for r in runs(level)]
        return level[0], paths

    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(((r[0] is not None, r[0] or 0), h(*map(field, r)), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([d for _, d, _ in sorted(by[s], key=lambda x: x[:2])]) for s in names]
    root, up = tree([t[0] for t in trees])
    out = {}
    for s, (subroot, paths), over in zip(names, trees, up):
        for (_, d, i), p in zip(sorted(by[s], key=lambda x: x[:2]), paths):
            out[i, d] = subroot, root, h(*p, *over)
    return out


def negatives(rows: list[tuple[int, int, list[int]]], every: int, positives: int = 5, most: int = 10) -> set:
    """Rows of hard negatives of (id, label, vector) where anchors are ids divisible by `every`."""
    out = set()
    for a, la, va in rows:
        if a % every:
            continue
        score = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in rows if i != a)
        for ps, p, _ in [x for x in score if x[2] == la][:positives]:
            found = [(n, i) for n, i, label in score if label != la and 30 * -ps <= 100 * -n <= 90 * -ps][:most]
            out |= {(a, p, k, i, -ps, -n) for k, (n, i) in enumerate(found, 1)}
    return out


def base_quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    by = defaultdict(list)
    for i in range(len(w) - 7):
        by[tuple(w[i : i + 8])].append(i)
    held = {j for at in by.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(held)
