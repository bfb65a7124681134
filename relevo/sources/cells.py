"""Wide-column cell tables: ``(row_key, cells)`` where ``cells`` holds the
row's JSON cell objects joined by newlines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.functions.formats import TEXT_FAMILY, parse_cell
from relevo.functions.text import KEY_SEPARATOR, clean_text, collection_of
from relevo.operators.joins import attach_small
from relevo.session import spread


def load_cells(df: DataFrame, key_col: str = "row_key", cells_col: str = "cells") -> DataFrame:
    """Normalise any ``(key, joined cells)`` source to ``row_key, cells``.

    The store connector is the caller's ``spark.read.format(...)``; this only
    fixes the column names (and spreads an under-split input).
    """
    return spread(df).select(F.col(key_col).cast("string").alias("row_key"), F.col(cells_col).alias("cells"))


def explode_cells(cells: DataFrame) -> DataFrame:
    """One row per cell: ``row_key, cell`` (decoded once with ``from_json``)."""
    return cells.select(
        "row_key", F.explode(F.split("cells", "\n")).alias("raw")
    ).select("row_key", parse_cell("raw").alias("cell"))


def cells_to_texts(
    cells: DataFrame,
    family: str = TEXT_FAMILY,
    qualifier: str | None = None,
) -> DataFrame:
    """Texts of one column family: ``id, collection_id, text`` (cleaned).

    Every cell of the family becomes a text, whatever its qualifier, unless
    ``qualifier`` is given; so one key can give several rows.
    """
    exploded = explode_cells(cells).filter(F.col("cell.columnFamily") == family)
    if qualifier is not None:
        exploded = exploded.filter(F.col("cell.qualifier") == qualifier)
    return exploded.select(
        F.col("row_key").alias("id"),
        collection_of("row_key").alias("collection_id"),
        clean_text(F.col("cell.value")).alias("text"),
    )


def key_prefix_filter(key_col: str, collection_id: str, delimited: bool = True):
    """Row-key prefix predicate for one collection (pushed to the scan as
    ``StartsWith``).  Without ``delimited`` id ``60`` also matches ``602-...``."""
    prefix = collection_id + KEY_SEPARATOR if delimited else collection_id
    return F.col(key_col).startswith(prefix)


def _outer_ids(config_ids: DataFrame) -> DataFrame:
    """``_cid, _inner``: the longer configured ids that begin with a
    configured id and a separator (``new`` and ``new-york``)."""
    parts = F.split("_inner", KEY_SEPARATOR)
    outer = F.transform(F.sequence(F.lit(1), F.size("_parts") - 1), lambda n: F.array_join(F.slice("_parts", F.lit(1), n), KEY_SEPARATOR))
    longer = config_ids.select(F.col("_cid").alias("_inner")).select("_inner", parts.alias("_parts")).filter(F.size("_parts") > 1)
    return longer.select("_inner", F.explode(outer).alias("_cid")).groupBy("_cid").agg(F.collect_set("_inner").alias("_inner"))


def select_collections(
    texts: DataFrame,
    config: DataFrame,
    key_col: str = "id",
    delimited: bool = True,
) -> DataFrame:
    """Texts of every configured collection, with the config row attached.

    A key is expanded to its prefixes of the configured id lengths, which keeps
    this an equi join instead of a nested-loop prefix match.  ``delimited``: the
    separator must follow the prefix (so an id may hold separators itself), and
    of several such ids the longest has the text; else a key belongs to every
    configured id it starts with.
    """
    cfg = config.withColumnRenamed("collection_id", "_cid")
    lengths = sorted(r[0] for r in cfg.select(F.length("_cid")).distinct().collect() if r[0] is not None)
    key = F.col(key_col)
    follows = (lambda n: F.substring(key, n + 1, F.lit(1)) == KEY_SEPARATOR) if delimited else (lambda n: F.length(key) >= n)
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), follows)
    keyed = texts.withColumn("_len", F.explode(fits)).withColumn("_cid", F.substring(key, F.lit(1), F.col("_len")))
    if delimited:
        cfg = cfg.join(_outer_ids(cfg.select("_cid").distinct()), "_cid", "left")
    out = attach_small(keyed.drop("_len", "collection_id"), cfg, on="_cid")
    if delimited:
        inner = F.exists(F.coalesce("_inner", F.array().cast("array<string>")), lambda x: key.startswith(F.concat(x, F.lit(KEY_SEPARATOR))))
        out = out.filter(~inner).drop("_inner")
    return out.withColumnRenamed("_cid", "collection_id")
