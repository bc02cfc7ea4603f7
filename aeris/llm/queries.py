"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from aeris.llm import (
    chat_format,
    decontamination,
    exact_dedup,
    fingerprint,
    html_extract,
    language_id,
    lexical_search,
    packing,
    sentencepiece_codec,
    simhash,
    spelling,
    suffix_dedup,
    token_count,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_fingerprints": fingerprint.op3_fingerprints,
    "op4_chat_format": chat_format.op4_chat_format,
    "op5_sentencepiece": sentencepiece_codec.op5_sentencepiece,
    "op6_packing": packing.op6_packing,
    "op7_simhash": simhash.op7_simhash,
    "op8_token_count": token_count.op8_token_count,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_html_extract": html_extract.op10_html_extract,
    "op11_spelling": spelling.op11_spelling,
    "op12_decontaminate": decontamination.op12_decontaminate,
    "op13_search": lexical_search.op13_search,
}
ORACLE_SQL = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op11_spelling": spelling.OP11_SQL,
    "op12_decontaminate": decontamination.OP12_SQL,
    "op13_search": lexical_search.OP13_SQL,
}
