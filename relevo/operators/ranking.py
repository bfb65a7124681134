"""Numbering and ranking inside groups of any size.

Rows are put in order by Spark's range partitioning; a partition's rows are
numbered by their place, and what the earlier partitions hold of a group is
carried over as one number for each (group, partition).  So neither a group's
rows nor its distinct scores have to pass through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relevo.session import materialize


def _placed(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """The rows in order of (by, order), written once, with ``_at`` (rising in
    that order) and ``_part`` (the range they are in).  A hash of the whole
    row comes last, so ties don't have to share a range."""
    keys = [*by, *order]
    ranged = df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    return materialize(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), name)


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], as_col: str = "number") -> DataFrame:
    """Number the rows of every group from 1 in the given order (ties in any
    order)."""
    by = list(by)
    placed = _placed(df, by, order, "numbered")
    starts = placed.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_own"), (F.coalesce(before, F.lit(0)) + 1 - F.col("_first")).alias("_shift"))
    same = F.col("_part") == F.col("_own")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return placed.join(starts, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(as_col))


def area_under_roc(scored: DataFrame, by: Sequence[str], score: str = "score", label: str = "label") -> DataFrame:
    """``*by, n_positive, n_negative, auc``: the exact area under the ROC
    curve of every group; equal scores count half, as the trapezoids over them
    do.  Rows without score or label don't count; a group of one class has
    null.

    The area is the share of (positive, negative) pairs in order: each
    distinct score's positives times the negatives below it and half of those
    at it."""
    by = list(by)
    rows = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    # -0.0 and 0.0 are one score
    levels = rows.groupBy(*by, (F.col(score) + F.lit(0.0)).alias("_score")).agg(F.count_if(F.col(label) > 0.5).cast("double").alias("_p"), F.count_if(F.col(label) <= 0.5).cast("double").alias("_n"))
    placed = _placed(levels, by, ["_score"], "levels")
    inside = Window.partitionBy(*by, "_part").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_below", F.coalesce(F.sum("_n").over(inside), F.lit(0.0)))
    parts = local.groupBy(*by, "_part").agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"), F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2)).alias("_pairs"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("_pairs", F.col("_pairs") + F.col("_p") * F.coalesce(F.sum("_n").over(earlier), F.lit(0.0)))
    sums = carried.groupBy(*by).agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"), F.sum("_pairs").alias("_pairs"))
    return sums.select(*by, F.col("_p").cast("long").alias("n_positive"), F.col("_n").cast("long").alias("n_negative"), F.try_divide(F.col("_pairs"), F.col("_p") * F.col("_n")).alias("auc"))


def weighted_f1(predicted: DataFrame, by: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``*by, f1``: F1 of every class weighted by its rows, as the library's
    multi-class evaluator has it, from the counts of (label, prediction)."""
    by = list(by)
    cells = predicted.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))
    both = F.explode(F.array(F.struct(F.col(label).alias("c"), F.col("n").alias("real"), F.lit(0).cast("long").alias("said")), F.struct(F.col(prediction).alias("c"), F.lit(0).cast("long").alias("real"), F.col("n").alias("said"))))
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    sides = cells.select(*by, both.alias("s"), hit.alias("hit")).groupBy(*by, "s.c").agg(F.sum("s.real").alias("real"), F.sum("s.said").alias("said"), F.sum("hit").alias("hits"))
    # each hit is there on both sides, so it was counted twice
    f1 = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("real") + F.col("said")), F.lit(0.0))
    return sides.groupBy(*by).agg((F.sum(f1 * F.col("real")) / F.sum("real")).alias("f1"))
