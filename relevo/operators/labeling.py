"""Weak labels from a chosen word pattern.

Positives: every pattern word is among the text's stop-word-free tokens.
Negative candidates: not every pattern word is among all its tokens.  A text
whose pattern holds only with stop words counts as neither.  Negatives are a
sample of the candidates with, per collection, the fraction positives / texts
(or positives / candidates for the balanced form).  The sample is a hash of
seed and id, so it does not depend on partitioning and is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relevo.functions.text import contains_all
from relevo.operators.joins import attach_small

# Fixed value: seed of the negative sample.
SAMPLE_SEED = 12345
# Hash values are 32-bit unsigned integers; a row is kept when its hash is
# below fraction * HASH_RANGE.
HASH_RANGE = 4294967296


def hash_unit(id_col: Column | str, seed: int = SAMPLE_SEED) -> Column:
    """First 32 bits of ``md5("<seed>:<id>")`` as a non-negative long."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def label_flags(prepared: DataFrame, pattern_col: str = "pattern") -> DataFrame:
    """Add ``is_positive`` and ``is_candidate`` (negative candidate) flags."""
    pattern = F.col(pattern_col)
    return prepared.withColumn("is_positive", contains_all("filtered", pattern)).withColumn(
        "is_candidate", ~contains_all("words", pattern)
    )


def positive_stats(flagged: DataFrame, by: str = "collection_id") -> DataFrame:
    """Per collection: texts, positives, negative candidates and the fractions
    (``try_divide``: an empty group gives null, not an error)."""
    return flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if("is_positive").alias("n_positive"),
        F.count_if("is_candidate").alias("n_candidates"),
    ).select(
        by,
        "n_texts",
        "n_positive",
        "n_candidates",
        F.try_divide(F.col("n_positive").cast("double"), F.col("n_texts")).alias("positive_fraction"),
        F.least(
            F.lit(1.0), F.try_divide(F.col("n_positive").cast("double"), F.col("n_candidates"))
        ).alias("balanced_fraction"),
    )


def sample_training(flagged: DataFrame, by: str = "collection_id", seed: int = SAMPLE_SEED, balanced: bool = False) -> DataFrame:
    """Positives (``label`` 1.0) and the sampled negative candidates (0.0) of a
    flagged table, with its other columns.  Two reads of ``flagged``: one small
    aggregate for the fractions, then one filter."""
    stats = positive_stats(flagged, by).select(
        by, F.col("balanced_fraction" if balanced else "positive_fraction").alias("_fraction")
    )
    keep_negative = F.col("is_candidate") & (
        hash_unit("id", seed) < F.coalesce(F.col("_fraction"), F.lit(0.0)) * F.lit(float(HASH_RANGE))
    )
    joined = attach_small(flagged, stats, on=by).filter(F.col("is_positive") | keep_negative)
    return joined.withColumn("label", F.when(F.col("is_positive"), F.lit(1.0)).otherwise(F.lit(0.0))).drop("_fraction")


def training_set(
    prepared: DataFrame,
    feature_col: str = "words",
    pattern_col: str = "pattern",
    by: str = "collection_id",
    seed: int = SAMPLE_SEED,
    balanced: bool = False,
) -> DataFrame:
    """Positives (label 1.0) plus sampled negative candidates (label 0.0).

    ``prepared`` has ``id, text, words, filtered`` and the collection's
    pattern.  ``feature_col`` (default ``words``: stop words stay in the
    model) is returned as ``filtered``.
    """
    sampled = sample_training(label_flags(prepared, pattern_col), by, seed, balanced)
    return sampled.select("id", by, "text", F.col(feature_col).alias("filtered"), "label")


def testing_set(prepared: DataFrame, feature_col: str = "words", by: str = "collection_id") -> DataFrame:
    """Every text with its feature tokens as ``filtered``."""
    return prepared.select("id", by, F.col(feature_col).alias("filtered"))


def multiclass_flags(prepared: DataFrame, pattern_col: str = "pattern") -> DataFrame:
    """Add ``class_no`` (1-based, 0 for none) and ``is_candidate`` (a text that
    holds none of the classes in any of its tokens).

    ``pattern`` holds one word set per class, each as space-joined words; a
    text's class is the first whose words all occur in its stop-word-free
    tokens."""
    classes = F.transform(F.col(pattern_col), lambda p: F.split(p, " "))
    hits = F.transform(classes, lambda c: F.size(F.array_except(c, F.col("filtered"))) == 0)
    in_words = F.exists(classes, lambda c: F.size(F.array_except(c, F.col("words"))) == 0)
    return prepared.withColumn("class_no", F.array_position(hits, True)).withColumn("is_candidate", ~in_words)


def sample_multiclass(flagged: DataFrame, by: str = "collection_id", seed: int = SAMPLE_SEED) -> DataFrame:
    """Texts of a class (``label`` 1.0, 2.0, ..) and the sampled candidates of
    class 0 (0.0; fraction labelled / all texts, as in the binary case) of a
    flagged table, with its other columns.  Two reads of ``flagged``."""
    stats = flagged.groupBy(by).agg(F.try_divide(F.count_if(F.col("class_no") > 0).cast("double"), F.count(F.lit(1))).alias("_fraction"))
    keep_zero = F.col("is_candidate") & (hash_unit("id", seed) < F.coalesce(F.col("_fraction"), F.lit(0.0)) * F.lit(float(HASH_RANGE)))
    kept = attach_small(flagged, stats, on=by).filter((F.col("class_no") > 0) | keep_zero)
    return kept.withColumn("label", F.col("class_no").cast("double")).drop("_fraction")


def multiclass_training_set(
    prepared: DataFrame,
    feature_col: str = "words",
    pattern_col: str = "pattern",
    by: str = "collection_id",
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Weak labels for a multi-class collection (``multiclass_flags`` and
    ``sample_multiclass`` as one call)."""
    sampled = sample_multiclass(multiclass_flags(prepared, pattern_col), by, seed)
    return sampled.select("id", by, "text", F.col(feature_col).alias("filtered"), "label")
