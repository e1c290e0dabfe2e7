"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from footfall.llm import (bpe_chunks, html_text, merkle, ngram_join, ngram_lm, packing, pii, quality_rules, sharding,
                          spelling, suffix_dedup, token_store, top_k)

SPARK = {
    "op1_quality_rules": quality_rules.query,
    "op2_pii": pii.query,
    "op3_ngram_join": ngram_join.query,
    "op4_ngram_lm": ngram_lm.query,
    "op5_html_text": html_text.query,
    "op6_top_k": top_k.query,
    "op7_suffix_dedup": suffix_dedup.query,
    "op8_bpe_chunks": bpe_chunks.query,
    "op9_token_store": token_store.query,
    "op10_packing": packing.query,
    "op11_sharding": sharding.query,
    "op12_merkle": merkle.query,
    "op13_spelling": spelling.query,
}

SQL = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op6_top_k": top_k.ORACLE,
    "op11_sharding": sharding.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_spelling": spelling.ORACLE,
}
