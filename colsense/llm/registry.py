"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import exact_dedup, jaccard, merkle, mixing, negatives, quality_rules, secrets, shards, suffix_dedup, topk
from .exact_dedup import op7_exact_dedup
from .jaccard import op3_ngram_jaccard
from .language import op4_language_id
from .merkle import op11_merkle_manifest
from .mixing import op5_source_mix
from .negatives import op12_hard_negatives
from .packing import op8_best_fit_packing
from .quality import op9_quality
from .quality_rules import op13_quality_rules
from .secrets import op10_secret_scan
from .shards import op2_size_tiered_shards
from .suffix_dedup import op6_suffix_dedup
from .topk import op1_exact_topk


def queries() -> dict:
    found = [op1_exact_topk, op2_size_tiered_shards, op3_ngram_jaccard, op4_language_id, op5_source_mix, op6_suffix_dedup, op7_exact_dedup, op8_best_fit_packing, op9_quality, op10_secret_scan, op11_merkle_manifest, op12_hard_negatives, op13_quality_rules]
    parts = [shards.shard_rows, mixing.mix_targets, secrets.secret_counts]  # of op2, op5 and op10: what SQL can express of them
    return {f.__name__: f for f in found + parts}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_topk": topk.SQL, "op3_ngram_jaccard": jaccard.SQL, "op6_suffix_dedup": suffix_dedup.SQL, "op7_exact_dedup": exact_dedup.SQL,
            "op11_merkle_manifest": merkle.SQL, "op12_hard_negatives": negatives.SQL, "op13_quality_rules": quality_rules.SQL,
            "shard_rows": shards.SQL_ROWS, "mix_targets": mixing.SQL_TARGETS, "secret_counts": secrets.SQL_COUNTS}
