"""The pipeline stage by stage against plain versions: each stage is held against what its predecessor kept."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import rows  # noqa: F401

import brute
import corpus_pipeline
from colsense.llm import packing


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):  # noqa: F811
    d = str(tmp_path_factory.mktemp("sf"))
    bad = "click here buy now cheap offer click buy now best cheap offer "
    docs = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in rows]
    docs += [(1000 + i, bad * (2 + i % 4), "en", "s1", 60) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 1000), 0) for i, *_ in docs], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert k == 4 or docs.columns == columns
        kept.append(docs.collect())
    all_, good, exact, near, mixed, packed = kept
    key = lambda r: tuple(r)

    # quality: rows go through whole or not at all; what is labelled bad goes, good documents of some length stay
    assert not Counter(map(key, good)) - Counter(map(key, all_))
    stay = {r["doc_id"] for r in good}
    assert not {i for i in stay if i >= 1000}
    assert {r["doc_id"] for r in all_ if r["doc_id"] < 1000 and len((r["text"] or "").split()) > 20} <= stay

    least = {}
    for r in sorted(good):
        least.setdefault(brute.SPACE.sub(" ", r["text"] or ""), r)
    assert Counter(map(key, exact)) == Counter(map(key, least.values()))

    groups = brute.components([(r["doc_id"], r["text"]) for r in exact], 5, 80)
    assert Counter(map(key, near)) == Counter(key(r) for r in exact if groups[r["doc_id"]][1] == r["doc_id"])

    copies = Counter(map(key, mixed))
    assert set(copies) <= set(map(key, near)) and max(copies.values()) <= 3
    size = lambda r: len(brute.WORD.findall(r["text"] or ""))
    have, took, target = defaultdict(int), defaultdict(int), {}
    for r in near:
        have[r["source"]] += size(r)
    for r in mixed:
        took[r["source"]] += size(r)
    names = sorted((s for s in have if s is not None)) + [None] * (None in have)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, free = sum(have.values()), set(names)
    while True:
        room = total - sum(3 * have[s] for s in names if s not in free)
        target = {s: room * weight[s] / sum(weight[x] for x in free) if s in free else 3 * have[s] for s in names}
        over = {s for s in free if target[s] > 3 * have[s]}
        if not over:
            break
        free -= over
    longest = max(map(size, near))
    assert all(abs(took[s] - target[s]) <= 2 * longest for s in names)

    tokenizer = packing._tokenizer(packing.vocabulary())
    want = Counter()
    for r in mixed:
        want.update((r["doc_id"], *p) for p in brute.pieces(r["text"], tokenizer))
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
    by = defaultdict(list)
    for r in packed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by.values():
        spans.sort()
        assert [o for o, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1]) and sum(n for _, n in spans) <= 4096


def test_run_gives_what_the_stages_give(spark, sf_dir):
    a = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    b = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert Counter(a) == Counter(b) and a


def test_run_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
