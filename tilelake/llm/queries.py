"""The queries of this folder, their DuckDB statements, and the pipeline."""

from __future__ import annotations

from tilelake.llm import bpe, divergence, fingerprints, katz, licenses, mixing, pages, pii, runs, simhash, superminhash, topk, toxicity

QUERIES = {
    "op1_simhash": simhash.op1,
    "op2_katz_score": katz.op2,
    "op3_toxicity": toxicity.op3,
    "op4_mix_sources": mixing.op4,
    "op5_topk_search": topk.op5,
    "op6_bpe": bpe.op6,
    "op7_pii": pii.op7,
    "op8_license_scan": licenses.op8,
    "op9_html_extract": pages.op9,
    "op10_fingerprints": fingerprints.op10,
    "op11_divergence": divergence.op11,
    "op12_runs": runs.op12,
    "op13_superminhash": superminhash.op13,
}

STATEMENTS = {
    "op4_mix_sources": mixing.SQL,
    "op5_topk_search": topk.SQL,
    "op8_license_scan": licenses.SQL,
    "op11_divergence": divergence.SQL,
    "op13_superminhash": superminhash.SQL,
}
