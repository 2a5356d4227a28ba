"""Queries of this folder, by name, and their SQL where SQL can state them."""

from __future__ import annotations

from tidemark.llm import balanced, divergence, lines, mixing, packing, parity, prefixtrie, quality, spotsigs, substring, suffixes, topk, toxicity

QUERIES = {
    "op1_ngram_jaccard_join": parity.query,
    "op2_substring_dedup": substring.query,
    "op3_exact_topk": topk.query,
    "op4_source_mixing": mixing.query,
    "op5_quality_classifier": quality.query,
    "op6_toxicity": toxicity.query,
    "op7_line_dedup": lines.query,
    "op8_spot_signatures": spotsigs.query,
    "op9_best_fit_packing": packing.query,
    "op10_suffix_array_dedup": suffixes.query,
    "op11_cost_balanced_packing": balanced.query,
    "op12_conversation_trie": prefixtrie.query,
    "op13_source_divergence": divergence.query,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_topk": topk.ORACLE,
    "op7_line_dedup": lines.ORACLE,
    "op12_conversation_trie": prefixtrie.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
