"""Queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from loomline.llm import (
    bpe, embeddings, html, language, mixing, ngram_lm, packing, pii, prefix_trie, quality, search, secrets, set_join,
)


def queries() -> dict:
    found = [
        pii.op1_pii, html.op2_html_text, secrets.op3_secret_scan, language.op4_language_id,
        mixing.op5_mix_sources, bpe.op6_byte_bpe, ngram_lm.op7_ngram_lm, set_join.op8_ngram_jaccard,
        embeddings.op9_embedding_dedup,
        quality.op10_quality_rules, search.op11_ranked_search, prefix_trie.op12_prefix_trie,
        packing.op13_packing,
    ]
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_mix_sources": mixing.OP5_SQL, "op8_ngram_jaccard": set_join.OP8_SQL,
            "op9_embedding_dedup": embeddings.OP9_SQL, "op11_ranked_search": search.OP11_SQL,
            "op12_prefix_trie": prefix_trie.OP12_SQL}
