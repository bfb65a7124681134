"""Tab-separated text files: ``<collectionId>-<textId> TAB <text>`` per line."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.functions.text import clean_text, collection_of

# Fixed value: blanks stripped from both ends of a line before splitting
# (ASCII whitespace, information separators, NEL and Unicode spaces).
LINE_BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]"


# Fixed value: folder of one collection's text files below the input root.
COLLECTION_FOLDER = "z_{}"


def read_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """Scan a text directory (one row per line, column ``value``).

    A missing path gives ``None`` so that a caller can skip the collection.
    """
    try:
        return spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_collections(spark: SparkSession, root: str, ids: Iterable[str]) -> tuple[DataFrame | None, list[str]]:
    """Lines of all configured collections from their folders ``z_<id>`` below
    ``root``, and the ids whose folder is absent.  The folders that are there
    become one scan."""
    found, absent = [], []
    for cid in ids:
        path = f"{root.rstrip('/')}/{COLLECTION_FOLDER.format(cid)}"
        if read_lines(spark, path) is None:
            absent.append(cid)
        else:
            found.append(path)
    return (spark.read.text(found) if found else None), absent


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Keep lines with exactly two tab-separated fields (after stripping the
    ends) and return ``id, collection_id, text`` with the text cleaned."""
    stripped = F.regexp_replace(F.col(value_col), f"^{LINE_BLANKS}+|{LINE_BLANKS}+$", "")
    fields = F.split(stripped, "\t")
    return (
        lines.select(fields.alias("f"))
        .filter(F.size("f") == 2)
        .select(F.col("f")[0].alias("id"), F.col("f")[1].alias("raw"))
        .select("id", collection_of("id").alias("collection_id"), clean_text("raw").alias("text"))
    )
