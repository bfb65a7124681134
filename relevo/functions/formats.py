"""Small scalar expressions for cells, scores and output lines."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Field names of one wide-column cell (JSON object), the column
# family that holds the texts, and the cell written back for each score.
CELL_SCHEMA = StructType(
    [
        StructField("columnFamily", StringType()),
        StructField("qualifier", StringType()),
        StructField("value", StringType()),
    ]
)
TEXT_FAMILY = "collection-management"
SCORE_FAMILY = "classification"
SCORE_QUALIFIER = "probability2"
# Run stamp format used in output names (yyyyMMdd-HHmmss).
RUN_STAMP_FORMAT = "yyyyMMdd-HHmmss"
RELEVANT_CLASS = 1


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_cell(col: Column | str) -> Column:
    """Decode one JSON cell into ``struct<columnFamily, qualifier, value>``;
    other fields are ignored."""
    return F.from_json(_c(col), CELL_SCHEMA)


def class_probability(col: Column | str = "probability", index: int = RELEVANT_CLASS) -> Column:
    """Pick one class probability out of an ML probability vector."""
    return vector_to_array(_c(col))[index]


def itemset_line(freq: Column | str, items: Column | str) -> Column:
    """``freq item item ...`` (pattern file line)."""
    return F.concat_ws(" ", _c(freq).cast("string"), F.array_join(_c(items), " "))


def run_stamp(ts: Column | str) -> Column:
    return F.date_format(_c(ts), RUN_STAMP_FORMAT)


def output_name(ts: Column | str, collection_id: Column | str, name: Column | str) -> Column:
    """``<yyyyMMdd-HHmmss>_<Id>_<name>`` output name."""
    return F.concat_ws("_", run_stamp(ts), _c(collection_id), _c(name))
