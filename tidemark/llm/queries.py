"""The corpus queries, each an operator over its whole table, and their DuckDB equivalents."""

from __future__ import annotations

from . import bpe, exact, jaccard, langid, merkle, packing, pii, quality, suffixes, syncmers, tokenfiles, toxicity, whitening

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_fingerprints": syncmers.op2_fingerprints,
    "op3_exact_dedup": exact.op3_exact_dedup,
    "op4_suffix_dedup": suffixes.op4_suffix_dedup,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_bpe": bpe.op6_bpe,
    "op7_pii": pii.op7_pii,
    "op8_packing": packing.op8_packing,
    "op9_quality": quality.op9_quality,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_token_files": tokenfiles.op12_token_files,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {"op3_exact_dedup": exact.ORACLE, "op11_merkle_manifest": merkle.ORACLE}
