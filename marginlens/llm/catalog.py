"""Queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

from marginlens.llm import (
    chat,
    fingerprints,
    hilbert,
    lattice,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality,
    repair,
    warc,
    whitening,
    wrappers,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_document_fingerprints": fingerprints.op2_document_fingerprints,
    "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
    "op4_warc": warc.op4_warc,
    "op5_html_extraction": wrappers.op5_html_extraction,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_hilbert_neighbours": hilbert.op9_hilbert_neighbours,
    "op10_quality_classifier": quality.op10_quality_classifier,
    "op11_lattice_near_duplicates": lattice.op11_lattice_near_duplicates,
    "op12_whitening": whitening.op12_whitening,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

SQL = {
    "op6_chat_formatting": chat.OP6_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op13_conversation_repair": repair.OP13_SQL,
}
