"""Collection configuration: which collections to process and the chosen
word pattern of each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

COLLECTION_SCHEMA = StructType(
    [
        StructField("Id", StringType()),
        StructField("name", StringType()),
        StructField("type", StringType()),
        StructField("FP", ArrayType(StringType())),
    ]
)
CONFIG_FILE_SCHEMA = StructType([StructField("collections", ArrayType(COLLECTION_SCHEMA))])

# Columns of a config table as used by the operators.
CONFIG_COLUMNS = ["collection_id", "name", "type", "pattern"]


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Read a config file ``{"collections": [{Id, name, type, FP}, ...]}``.

    One row per collection: ``collection_id, name, type, pattern``.
    """
    raw = spark.read.schema(CONFIG_FILE_SCHEMA).option("multiLine", True).json(path)
    return _normalise(raw.select(F.explode("collections").alias("c")).select("c.*"))


def config_from_rows(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """Config table from in-memory rows (same keys as the file)."""
    data = [(str(r["Id"]), r.get("name"), r.get("type", "binary"), list(r.get("FP", []))) for r in rows]
    return _normalise(spark.createDataFrame(data, COLLECTION_SCHEMA))


def config_for_texts(
    texts: DataFrame,
    pattern: Sequence[str],
    collection_col: str = "collection_id",
    kind: str = "binary",
) -> DataFrame:
    """Config with one row per collection present in ``texts``, all sharing
    ``pattern`` (a distinct over the collection column, partially aggregated
    before its shuffle)."""
    pat = F.array(*[F.lit(w) for w in pattern]).cast("array<string>")
    return (
        texts.select(F.col(collection_col).alias("collection_id"))
        .distinct()
        .select(
            "collection_id",
            F.col("collection_id").alias("name"),
            F.lit(kind).alias("type"),
            pat.alias("pattern"),
        )
    )


def _normalise(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("Id").cast("string").alias("collection_id"),
        F.col("name"),
        F.coalesce(F.col("type"), F.lit("binary")).alias("type"),
        F.coalesce(F.col("FP"), F.array().cast("array<string>")).alias("pattern"),
    )
