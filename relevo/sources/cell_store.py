"""A cell table kept as sorted files, read by key range and written by runs.

A run's cells (``row_key, column_family, qualifier, value``) lie in a folder of
their own below the store, range-partitioned and sorted by row key, so the
files' own statistics tell which row groups hold a range of keys.  A run
appears by one rename when it is complete: a repeated write replaces the run's
own cells, a failed one leaves nothing to be read.  Of several runs' cells for
one (row key, family, qualifier) the newest run's counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.functions.text import KEY_SEPARATOR
from relevo.session import publish

CELLS = "row_key string, column_family string, qualifier string, value string"
_CELL = ["row_key", "column_family", "qualifier"]


def write_cells(cells: DataFrame, path: str, run_ts: str, row_group_bytes: int = 8 << 20) -> None:
    """Put a run's cells (of one cell written twice in a run the greater value
    counts)."""
    spark = cells.sparkSession
    unique = cells.groupBy(*_CELL).agg(F.max("value").alias("value"))
    ordered = unique.repartitionByRange("row_key", "column_family", "qualifier").sortWithinPartitions(*_CELL)
    part = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    ordered.write.option("parquet.block.size", row_group_bytes).parquet(part)
    publish(spark, part, f"{path.rstrip('/')}/run_ts={run_ts}")


def key_range(low: str | None = None, high: str | None = None, key: str = "row_key") -> Column:
    """Keys from ``low`` up to, but without, ``high``; comparisons that the
    scan checks against the files' statistics."""
    parts = ([F.col(key) >= low] if low is not None else []) + ([F.col(key) < high] if high is not None else [])
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def after_prefix(prefix: str) -> str | None:
    """The least key behind all that begin with ``prefix`` (None: there is no
    end to them).  Keys compare by their UTF-8 bytes, as code points do."""
    while prefix:
        last = ord(prefix[-1]) + 1
        if last <= 0x10FFFF:
            return prefix[:-1] + chr(0xE000 if 0xD800 <= last <= 0xDFFF else last)
        prefix = prefix[:-1]
    return None


def prefix_range(prefix: str, key: str = "row_key") -> Column:
    return key_range(prefix, after_prefix(prefix), key)


def read_cells(spark: SparkSession, path: str, where: Column | None = None, collections: Sequence[str] | None = None, delimited: bool = True) -> DataFrame:
    """``row_key, column_family, qualifier, value``, each cell once.  ``where``
    (such as ``key_range``) and the key ranges of ``collections`` are applied
    by the scan, before the newest cells are chosen."""
    cells = spark.read.schema(f"{CELLS}, run_ts string").parquet(path)
    if where is not None:
        cells = cells.filter(where)
    if collections is not None:
        ends = KEY_SEPARATOR if delimited else ""
        cells = cells.filter(reduce(lambda a, b: a | b, [prefix_range(c + ends) for c in collections], F.lit(False)))
    newest = cells.groupBy(*_CELL).agg(F.max(F.struct("run_ts", "value")).alias("newest"))
    return newest.select(*_CELL, "newest.value")


def as_rows(cells: DataFrame) -> DataFrame:
    """``row_key, cells``: a key's cells as JSON objects joined by newlines,
    in order, as the cell sources take them.  A key has as many cells as it
    has families and qualifiers."""
    one = F.to_json(F.struct(F.col("column_family").alias("columnFamily"), "qualifier", "value"))
    held = F.transform(F.array_sort(F.collect_list(F.struct("column_family", "qualifier", one.alias("json")))), lambda x: x["json"])
    return cells.groupBy("row_key").agg(F.array_join(held, "\n").alias("cells"))
