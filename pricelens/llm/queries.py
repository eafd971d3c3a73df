"""The contract queries of this package and the DuckDB SQL of those that have one."""

from __future__ import annotations

from . import (embed_dedup, hard_negatives, jaccard_join, katz, langid, mixing, packing, prefix_trie, quality_fm, suffix_dedup,
               token_counts, topk_search, url_filter)

QUERIES = {
    "op1_bm25_search": topk_search.op1_bm25_search,
    "op2_quality_fm": quality_fm.op2_quality_fm,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_katz_backoff": katz.op4_katz_backoff,
    "op5_pack_sequences": packing.op5_pack_sequences,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_embedding_neardup": embed_dedup.op7_embedding_neardup,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_language_id": langid.op9_language_id,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
}

SQL = {
    "op1_bm25_search": topk_search.SQL,
    "op7_embedding_neardup": embed_dedup.SQL,
    "op10_mix_sources": mixing.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_suffix_dedup": suffix_dedup.SQL,
}
