"""Text cleaning and tokenising as built-in Spark expressions.

Every function here takes and returns a ``Column`` so that the work stays in
the JVM (regexp, split and higher-order array functions) and composes into one
projection; no Python row function is involved.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from relevo.functions.stopwords import ENGLISH_STOP_WORDS

# ---------------------------------------------------------------------------
# Fixed values that results must agree on.
#
# Cleaning pattern: every match becomes one blank.  Java regex semantics (ASCII
# \w and \s): at each position the first alternative that matches wins, so a
# mention, else one character that is not a letter, digit, blank or tab, else a
# URL-like run "word://non-blanks".
CLEAN_PATTERN = r"(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|(\w+:\/\/\S+)"
# The same matches in linear time: a URL match never starts right after a
# letter or digit (that position was already consumed by a greedy match or
# failed on the same word run), and ":" is not a word character, so the word
# run never needs to give characters back.  Without these two facts Java's
# engine rescans the rest of every word from each of its positions.
# tests/test_text.py checks both patterns give the same result.
CLEAN_PATTERN_LINEAR = r"(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|((?<![0-9A-Za-z])\w++:\/\/\S+)"
# The pattern's first part, and the ASCII characters of its second one.
_MENTION = r"@[A-Za-z0-9]+"
_ASCII_SIGNS = "".join(chr(i) for i in range(128) if not chr(i).isalnum() and chr(i) not in " \t")
# Characters stripped from both ends after the replacement.
CLEAN_STRIP_CHARS = " \t"
# Terms (split on a single blank) shorter than this are dropped.
MIN_TERM_LENGTH = 3
# Blanks, and the line ends that a pattern's ``$`` also stands before.
_BLANK_ENDS = " \t\n\x0b\x0c\r\u0085\u2028\u2029"
# Separator between collection id and text id inside a row key.
KEY_SEPARATOR = "-"
# Web-page markup removed before cleaning (report's web-page variant).
HTML_BLOCK_PATTERN = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->"
HTML_TAG_PATTERN = r"(?s)<[^>]*>"
HTML_ENTITY_PATTERN = r"&(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def keep_long_terms(col: Column | str, min_length: int = MIN_TERM_LENGTH) -> Column:
    """Terms (runs between single blanks) of at least ``min_length``
    characters, joined by one blank.

    A pattern for short terms would look around at every place of the text;
    parting it at the blanks takes half the time."""
    return F.array_join(F.filter(F.split(_c(col), " "), lambda w: F.length(w) >= min_length), " ")


def clean_text(col: Column | str) -> Column:
    """Replace mentions, punctuation and URLs by blanks, strip the ends and
    keep only terms of at least ``MIN_TERM_LENGTH`` characters.

    The pattern costs by the number of its matches, and nearly all are single
    signs.  A text without ``://`` can hold no URL match: its mentions go by
    the pattern's first part (only if it has an ``@``), its ASCII signs by a
    character table, and what isn't ASCII by a class (only if there is any).
    The table's result is bound as a lambda's variable: written out, it would
    be made anew wherever it is used."""
    c = _c(col)
    mentions = F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, F.lit(_MENTION), F.lit(" "))).otherwise(c)
    signs = F.translate(mentions, _ASCII_SIGNS, " " * len(_ASCII_SIGNS))

    def ascii_only(x: Column) -> Column:
        return F.when(F.octet_length(x) > F.length(x), F.regexp_replace(x, F.lit(r"[^\x00-\x7F]"), F.lit(" "))).otherwise(x)

    plain = F.get(F.transform(F.array(signs), ascii_only), F.lit(0))
    replaced = F.when(F.contains(c, F.lit("://")), F.regexp_replace(c, F.lit(CLEAN_PATTERN_LINEAR), F.lit(" "))).otherwise(plain)
    stripped = F.btrim(replaced, F.lit(CLEAN_STRIP_CHARS))
    return keep_long_terms(stripped)


def tokenize(col: Column | str) -> Column:
    """Lower-case and split on single whitespace characters.

    Same result as ``pyspark.ml.feature.Tokenizer`` (Java ``String.split``):
    trailing empty tokens are dropped, and an empty text gives ``[""]``.  Only
    a text that ends with a blank or a line end can have any to drop.
    """
    c = _c(col)
    low = F.lower(c)
    body = F.regexp_replace(low, r"\s+$", "")
    blank_end = reduce(or_, [F.endswith(c, F.lit(x)) for x in _BLANK_ENDS])
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(~blank_end, F.split(low, r"\s"))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, r"\s"))
    )


def remove_stop_words(
    col: Column | str,
    stop_words: Iterable[str] | None = None,
    case_sensitive: bool = False,
) -> Column:
    """Drop stop words from an array of tokens (order and repeats kept).

    The literal list becomes a hash set (``InSet``) inside the lambda.
    """
    words = list(ENGLISH_STOP_WORDS if stop_words is None else stop_words)
    if case_sensitive:
        return F.filter(_c(col), lambda w: ~w.isin(words))
    lowered = sorted({w.lower() for w in words})
    return F.filter(_c(col), lambda w: ~F.lower(w).isin(lowered))


def unique_tokens(col: Column | str) -> Column:
    """Drop empty tokens and repeats; sorted so the output is repeatable."""
    return F.array_sort(F.array_distinct(F.array_remove(_c(col), "")))


def contains_all(tokens: Column | str, pattern: Column) -> Column:
    """True when every word of ``pattern`` occurs in ``tokens`` (empty pattern
    gives true)."""
    return F.size(F.array_except(pattern, _c(tokens))) == 0


def collection_of(key: Column | str) -> Column:
    """Collection id = the part of a row key before the first separator."""
    return F.substring_index(_c(key), KEY_SEPARATOR, 1)


def strip_html(col: Column | str) -> Column:
    """Remove script/style blocks, comments, tags and character entities."""
    no_blocks = F.regexp_replace(_c(col), F.lit(HTML_BLOCK_PATTERN), F.lit(" "))
    no_tags = F.regexp_replace(no_blocks, F.lit(HTML_TAG_PATTERN), F.lit(" "))
    return F.regexp_replace(no_tags, F.lit(HTML_ENTITY_PATTERN), F.lit(" "))
