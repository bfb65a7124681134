"""Summaries of labels and scores: histograms, shares, errors, audit samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relevo.operators.joins import attach_small
from relevo.operators.labeling import SAMPLE_SEED, hash_unit

# Fixed value: number of equal-width bins of the score histograms.
HISTOGRAM_BINS = 10


def _edge(lo: Column, width: Column, i: Column) -> Column:
    return lo + i * width


def histogram(
    df: DataFrame,
    value_col: str,
    by: str | list[str],
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Equal-width histogram of ``value_col`` per group over [min, max].

    Same bins as numpy's ``histogram`` (what a pandas ``hist`` draws): edges
    ``lo + i * (hi - lo) / bins`` with the last bin closed on the right; when
    all values are equal the range is widened to [v - 0.5, v + 0.5].  Nulls
    are ignored.  Two scans: a per-group min/max aggregate (broadcast back
    after a size check), then a partially aggregated count per (group, bin).
    Result: group columns, ``bin`` (int), ``bin_lo``, ``bin_hi``, ``n``.
    """
    keys = [by] if isinstance(by, str) else list(by)
    vals = df.select(*keys, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    stats = vals.groupBy(*keys).agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx")).select(
        *keys,
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
    ).withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    joined = attach_small(vals, stats, on=keys)
    lo, hi, w, v = F.col("_lo"), F.col("_hi"), F.col("_w"), F.col("_v")
    last = F.lit(bins - 1)
    raw = F.least(last, F.floor(((v - lo) / (hi - lo)) * F.lit(float(bins))).cast("int"))
    # numpy's correction against the exact edges
    down = F.when(v < _edge(lo, w, raw), raw - 1).otherwise(raw)
    up_edge = F.when(down + 1 == F.lit(bins), hi).otherwise(_edge(lo, w, down + 1))
    idx = F.when((v >= up_edge) & (down != last), down + 1).otherwise(down)
    binned = joined.select(*keys, "_lo", "_hi", "_w", idx.alias("bin"))
    return binned.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.first("_lo").alias("_lo"),
        F.first("_w").alias("_w"),
        F.first("_hi").alias("_hi"),
    ).select(
        *keys,
        "bin",
        _edge(F.col("_lo"), F.col("_w"), F.col("bin")).alias("bin_lo"),
        F.when(F.col("bin") == last, F.col("_hi"))
        .otherwise(_edge(F.col("_lo"), F.col("_w"), F.col("bin") + 1))
        .alias("bin_hi"),
        "n",
    )


def training_error(
    training_predictions: DataFrame,
    stats: DataFrame,
    by: str = "collection_id",
) -> DataFrame:
    """Per collection: misclassified training rows, divided both by all texts
    of the collection (the original job's figure) and by training rows."""
    agg = training_predictions.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_training"),
        F.count_if(F.col("label") != F.col("prediction")).alias("n_wrong"),
    )
    joined = attach_small(agg, stats.select(by, "n_texts"), on=by)
    return joined.select(
        by,
        "n_texts",
        "n_training",
        "n_wrong",
        F.try_divide(F.col("n_wrong").cast("double"), F.col("n_texts")).alias("error_all_texts"),
        F.try_divide(F.col("n_wrong").cast("double"), F.col("n_training")).alias("error_training"),
    )


def relevance_share(scores: DataFrame, by: str = "collection_id", probability_col: str = "probability_relevant") -> DataFrame:
    """Per collection: scored texts, texts predicted relevant, their share and
    the mean probability of relevance."""
    return scores.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if(F.col("prediction") == 1.0).alias("n_relevant"),
        F.avg("prediction").alias("relevant_share"),
        F.avg(probability_col).alias("mean_probability"),
    )


def audit_sample(
    df: DataFrame,
    class_col: str,
    k: int = 5,
    by: str = "collection_id",
    seed: int = SAMPLE_SEED,
    id_col: str = "id",
) -> DataFrame:
    """Up to ``k`` texts per (collection, class) for manual review, chosen by
    a seeded hash of the id (repeatable, independent of partitioning; the
    row_number limit is applied partially before the shuffle)."""
    h = hash_unit(id_col, seed)
    w = Window.partitionBy(by, class_col).orderBy("_h", id_col)
    return (
        df.withColumn("_h", h)
        .withColumn("sample_rank", F.row_number().over(w))
        .filter(F.col("sample_rank") <= k)
        .drop("_h")
    )
