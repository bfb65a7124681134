"""Token columns for a table of cleaned texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.functions.text import remove_stop_words, tokenize, unique_tokens


def prepare_texts(
    texts: DataFrame,
    text_col: str = "text",
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Add ``words`` (lower-case tokens) and ``filtered`` (stop words removed).

    One projection; no shuffle.
    """
    return texts.withColumn("words", tokenize(text_col)).withColumn(
        "filtered", remove_stop_words("words", stop_words)
    )


def transactions(prepared: DataFrame, tokens_col: str = "filtered", keep: Iterable[str] = ("id", "collection_id", "text")) -> DataFrame:
    """One transaction per text: its distinct non-empty tokens (``items``),
    as frequent item-set mining requires."""
    return prepared.select(*keep, unique_tokens(tokens_col).alias("items"))
