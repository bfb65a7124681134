"""Column expressions (cleaning, tokens, cells, scores)."""

from relevo.functions.formats import (
    CELL_SCHEMA,
    SCORE_FAMILY,
    SCORE_QUALIFIER,
    TEXT_FAMILY,
    class_probability,
    itemset_line,
    output_name,
    parse_cell,
    run_stamp,
)
from relevo.functions.stopwords import ENGLISH_STOP_WORDS
from relevo.functions.text import (
    CLEAN_PATTERN,
    clean_text,
    collection_of,
    contains_all,
    remove_stop_words,
    strip_html,
    tokenize,
    unique_tokens,
)

__all__ = [
    "CELL_SCHEMA",
    "CLEAN_PATTERN",
    "ENGLISH_STOP_WORDS",
    "SCORE_FAMILY",
    "SCORE_QUALIFIER",
    "TEXT_FAMILY",
    "class_probability",
    "clean_text",
    "collection_of",
    "contains_all",
    "itemset_line",
    "output_name",
    "parse_cell",
    "remove_stop_words",
    "run_stamp",
    "strip_html",
    "tokenize",
    "unique_tokens",
]
