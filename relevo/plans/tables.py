"""Roles of the driver's test tables.

* ``documents``: texts with row key ``<source>-<doc_id>``; collection = source.
* ``conversations``: short texts ("tweets") for item-set mining; row key
  ``<conv_id>-<turn>``, one collection per role.
* wide-column cells and tab-separated lines are rendered from ``documents`` by
  Spark itself, so their work grows with the table.
* ``pages``: raw web pages; ``events``: numeric values and JSON properties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.functions.formats import TEXT_FAMILY
from relevo.session import spread


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; an under-split file (the test tables are one row group
    each) is spread over the session's cores."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, collection_id, raw`` (raw, uncleaned text)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("collection_id"),
        F.col("text").alias("raw"),
    )


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, collection_id, raw`` for every turn of ``conversations``; the
    role is the collection."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("role").alias("collection_id"),
        F.col("text").alias("raw"),
    )


def _cell(family: str, qualifier: str, value) -> F.Column:
    return F.to_json(
        F.struct(
            F.lit(family).alias("columnFamily"),
            F.lit(qualifier).alias("qualifier"),
            value.alias("value"),
        )
    )


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_key, cells``: each document as a wide-column row whose JSON cells
    are joined by newlines.  Family ``collection-management`` holds the text
    and, for multi-line texts, a second qualifier with the first line; family
    ``metadata`` holds language and source."""
    d = read_table(spark, sf_dir, "documents")
    title = F.when(
        F.col("text").contains("\n"),
        _cell(TEXT_FAMILY, "title", F.substring_index("text", "\n", 1)),
    )
    cells = F.array_compact(
        F.array(
            _cell("metadata", "lang", F.col("lang")),
            _cell(TEXT_FAMILY, "text", F.col("text")),
            title,
            _cell("metadata", "source", F.col("source")),
        )
    )
    return d.select(
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("row_key"),
        F.array_join(cells, "\n").alias("cells"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: documents rendered as a tab-separated text file
    (``<key> TAB <text>``), one row per physical line."""
    t = document_texts(spark, sf_dir)
    record = F.concat_ws("\t", "id", "raw")
    return t.select(F.explode(F.split(record, "\n")).alias("value"))
