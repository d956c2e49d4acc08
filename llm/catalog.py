"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from llm import (
    chat_format,
    decontaminate,
    embedding_dedup,
    html_extract,
    jaccard_join,
    language_id,
    licenses,
    mixing,
    prefix_trie,
    quality,
    secrets,
    spelling,
    substring_dedup,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_mixing": mixing.op2_mixing,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_html_extraction": html_extract.op4_html_extraction,
    "op5_secrets": secrets.op5_secrets,
    "op6_quality": quality.op6_quality,
    "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
    "op8_licenses": licenses.op8_licenses,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_chat_format": chat_format.op12_chat_format,
    "op13_spelling": spelling.op13_spelling,
}

ORACLES = {
    "op3_substring_dedup": substring_dedup.ORACLE_OP3,
    "op7_embedding_dedup": embedding_dedup.ORACLE_OP7,
    "op9_jaccard_join": jaccard_join.ORACLE_OP9,
    "op10_decontamination": decontaminate.ORACLE_OP10,
    "op11_prefix_trie": prefix_trie.ORACLE_OP11,
    "op12_chat_format": chat_format.ORACLE_OP12,
    "op13_spelling": spelling.ORACLE_OP13,
}
