"""Queries of the training-data operators and their DuckDB SQL, as ``__spark_entry__`` adds them."""

from __future__ import annotations

from sluice.llm import (
    chat,
    decontaminate,
    jaccard_join,
    language_id,
    lexical_search,
    packing,
    quality,
    substring_dedup,
    token_count,
    token_file,
    topk,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_decontaminate": decontaminate.query,
    "op3_topk": topk.query,
    "op4_language_id": language_id.query,
    "op5_packing": packing.query,
    "op6_url_filter": url_filter.query,
    "op7_jaccard_join": jaccard_join.query,
    "op8_quality": quality.query,
    "op9_token_count": token_count.query,
    "op10_chat": chat.query,
    "op11_token_file": token_file.query,
    "op12_lexical_search": lexical_search.query,
    "op13_whitening": whitening.query,
}
ORACLES = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op3_topk": topk.SQL,
    "op6_url_filter": url_filter.SQL,
    "op10_chat": chat.SQL,
    "op12_lexical_search": lexical_search.SQL,
}
