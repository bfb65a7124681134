"""Frequent word sets per collection and the shortlist a person picks from."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relevo.operators.joins import attach_small
from relevo.session import materialize

# Fixed value: minimum support of the mining phase.
MIN_SUPPORT = 0.02
# Fewest texts of a frequent set, whatever the support.  With 1, every subset
# of every text is frequent in a collection of few texts.
MIN_COUNT = 1
# Collections whose wanted counts are within this factor are mined together.
BAND = 1.1


def _tag(by: str) -> Column:
    """A collection's mark before its items; it holds no colon."""
    return F.base64(F.encode(F.col(by), "UTF-8"))


def frequent_itemsets(
    transactions: DataFrame,
    min_support: float = MIN_SUPPORT,
    items_col: str = "items",
    by: str = "collection_id",
    num_partitions: int | None = None,
    min_count: int = MIN_COUNT,
    band: float = BAND,
) -> DataFrame:
    """Word sets occurring in at least ``max(ceil(min_support * n),
    min_count)`` texts of their collection: ``collection_id, items (sorted),
    freq``.

    Items are marked with their collection, so one run of Spark's distributed
    FP-growth mines many collections: all whose wanted counts lie within a
    factor ``band`` (its least count is the run's; what a collection wants
    beyond that is filtered after).  The runs grow with the logarithm of the
    largest count, not with the collections.  The sets are mined here, once,
    and written to the shared folder; what reads the result doesn't mine
    again.  Rows without a collection don't count.
    """
    spark = transactions.sparkSession
    least = F.greatest(F.ceil(F.lit(min_support) * F.col("_n")), F.lit(min_count)).cast("long")
    wanted = transactions.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("_n")).select(F.col(by), least.alias("_least"))
    wanted = materialize(wanted.withColumn("_band", F.floor(F.log("_least") / F.lit(math.log(band)))), "wanted")
    marked = attach_small(transactions.select(by, F.col(items_col).alias("_items")), wanted, by)
    marked = marked.select("_band", "_least", F.transform("_items", lambda x: F.concat(_tag(by), F.lit(":"), x)).alias("items"))
    marked = materialize(marked, "transactions", ["_band"])
    bands = marked.groupBy("_band").agg(F.min("_least"), F.count(F.lit(1))).collect()

    def mine(task) -> DataFrame:
        number, count, n = task
        # the support that FP-growth turns back into the wanted count
        fp = FPGrowth(itemsCol="items", minSupport=min(1.0, (count - 0.5) / n))
        if num_partitions:
            fp = fp.setNumPartitions(num_partitions)
        model = fp.fit(marked.filter(F.col("_band") == number).select("items"))
        own = F.decode(F.unbase64(F.substring_index(F.get("items", F.lit(0)), ":", 1)), "UTF-8")
        bare = F.array_sort(F.transform("items", lambda x: F.substring(x, F.position(F.lit(":"), x) + 1, F.length(x))))
        sets = model.freqItemsets.select(own.alias(by), bare.alias("items"), F.col("freq").cast("long").alias("freq"))
        return materialize(attach_small(sets, wanted, by).filter("freq >= _least").select(by, "items", "freq"), "itemsets")

    with ThreadPoolExecutor(max_workers=max(1, spark.sparkContext.defaultParallelism // 2)) as pool:
        parts = list(pool.map(inheritable_thread_target(spark)(mine), [tuple(r) for r in bands]))
    if not parts:
        return spark.createDataFrame([], f"{by} string, items array<string>, freq long")
    return reduce(DataFrame.unionByName, parts)


def sorted_itemsets(itemsets: DataFrame) -> DataFrame:
    """Frequency descending, ties by item list descending (pattern file order)."""
    return itemsets.orderBy(F.desc("freq"), F.desc("items"))


def shortlist(
    itemsets: DataFrame,
    k: int = 10,
    min_size: int = 2,
    max_size: int = 4,
    by: str = "collection_id",
) -> DataFrame:
    """The ``k`` most frequent sets of ``min_size``..``max_size`` words per
    collection (ties by item text).  ``row_number() <= k`` lets Spark insert a
    partial window-group limit before the shuffle, so a collection's task
    sees at most ``k`` rows per input partition."""
    w = Window.partitionBy(by).orderBy(F.desc("freq"), F.array_join("items", " "))
    return (
        itemsets.filter(F.size("items").between(min_size, max_size))
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
    )
