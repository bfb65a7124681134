"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from relevo.llm import (
    alignment,
    decontamination,
    line_dedup,
    near_duplicates,
    packing,
    prefix_trie,
    quality_crf,
    sentencepiece_fst,
    sharding,
    suffix_dedup,
    toxicity,
    url_filters,
    vector_search,
)

_MODULES = (sharding, toxicity, vector_search, suffix_dedup, near_duplicates, sentencepiece_fst, quality_crf, decontamination, url_filters, line_dedup, alignment, prefix_trie, packing)

QUERIES = {m.NAME: m.query for m in _MODULES}
ORACLES = {m.NAME: m.ORACLE_SQL for m in _MODULES if m.ORACLE_SQL}
