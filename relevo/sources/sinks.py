"""Sinks: score cells, prediction files, pattern files, fitted models.

All writes go straight from the executors (``DataFrame.write``); nothing is
collected to the driver.  Outputs are partitioned by collection and run stamp
so that reruns with the same stamp are repeatable.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from relevo.functions.formats import SCORE_FAMILY, SCORE_QUALIFIER, itemset_line
from relevo.operators.joins import attach_small
from relevo.operators.ranking import numbered

PREDICTION_FILE_SCHEMA = StructType(
    [StructField("id", StringType()), StructField("Probability", DoubleType())]
)
# Partition columns of the output folders; given when reading, so that
# collection ids stay text.
_FOLDERS = [StructField("collection_id", StringType()), StructField("run_ts", StringType())]
# Only the folders of the collections and stamps that are written are replaced.
_KEEP_OTHERS = {"partitionOverwriteMode": "dynamic"}
_FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def score_cells(
    scores: DataFrame,
    family: str = SCORE_FAMILY,
    qualifier: str = SCORE_QUALIFIER,
    id_col: str = "id",
    probability_col: str = "probability_relevant",
) -> DataFrame:
    """One output cell per scored text: ``row_key, column_family, qualifier,
    value`` (probability as text)."""
    return scores.select(
        F.col(id_col).cast("string").alias("row_key"),
        F.lit(family).alias("column_family"),
        F.lit(qualifier).alias("qualifier"),
        F.col(probability_col).cast("string").alias("value"),
    )


def write_score_cells(scores: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Write score cells back keyed by row key.  A wide-column store connector
    is passed as ``fmt`` plus its options (it puts cells, so a rerun replaces
    them); for a file format the folder of the run is replaced, so a rerun
    doesn't double the cells."""
    mode = "overwrite" if fmt in _FILE_FORMATS else "append"
    score_cells(scores).write.format(fmt).options(**options).mode(mode).save(path)


def write_predictions_tsv(
    scores: DataFrame,
    path: str,
    run_ts: str,
    probability_col: str = "probability_relevant",
) -> None:
    """Prediction files ``id TAB Probability`` with a header, one folder per
    collection and run stamp; other collections' and runs' folders stay."""
    (
        scores.select(
            "id",
            F.col(probability_col).alias("Probability"),
            "collection_id",
            F.lit(run_ts).alias("run_ts"),
        )
        .write.mode("overwrite")
        .options(**_KEEP_OTHERS)
        .partitionBy("collection_id", "run_ts")
        .option("sep", "\t")
        .option("header", True)
        .csv(path)
    )


def read_predictions_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Read prediction files back (header ``id, Probability``) with their
    ``collection_id`` and ``run_ts``, both text."""
    return (
        spark.read.option("sep", "\t")
        .option("header", True)
        .schema(StructType([*PREDICTION_FILE_SCHEMA.fields, *_FOLDERS]))
        .csv(path)
    )


def prediction_runs(spark: SparkSession, path: str) -> DataFrame:
    """``collection_id, run_ts, newest`` of the runs below ``path``, from the
    names of the files alone (stamps sort by time)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    # folder names are written with %XX for special characters
    part = lambda name: F.url_decode(F.replace(F.regexp_extract("path", rf"{name}=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    runs = files.select(part("collection_id").alias("collection_id"), part("run_ts").alias("run_ts")).distinct()
    last = runs.groupBy("collection_id").agg(F.max("run_ts").alias("last"))
    return runs.join(last, "collection_id").select("collection_id", "run_ts", (F.col("run_ts") == F.col("last")).alias("newest"))


def newest_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions of each collection's newest run, in one scan: the join on
    the folder columns keeps older runs' files unread."""
    newest = prediction_runs(spark, path).filter("newest").select("collection_id", "run_ts")
    return attach_small(read_predictions_tsv(spark, path), newest, ["collection_id", "run_ts"])


def pattern_lines(itemsets: DataFrame) -> DataFrame:
    """Pattern file lines ``freq item item ...`` in file order per collection
    (frequency descending, ties by item list descending)."""
    return itemsets.orderBy("collection_id", F.desc("freq"), F.desc("items")).select(
        "collection_id", itemset_line("freq", "items").alias("line")
    )


def numbered_lines(itemsets: DataFrame) -> DataFrame:
    """Pattern file lines with their number in the collection's file
    (``line_no`` from 1).  The order is one range-partitioned sort over all
    collections with carried offsets."""
    lines = numbered(itemsets.select("collection_id", "items", "freq"), ["collection_id"], [F.desc("freq"), F.desc("items")], "line_no")
    return lines.select("collection_id", "line_no", itemset_line("freq", "items").alias("line"))


def write_patterns(itemsets: DataFrame, path: str, run_ts: str) -> None:
    """Pattern files (UTF-8 text) per collection and run stamp, plus the item
    sets as Parquet next to them; other collections' and runs' folders stay."""
    lines = pattern_lines(itemsets).withColumn("run_ts", F.lit(run_ts))
    folders = ("collection_id", "run_ts")
    lines.write.mode("overwrite").options(**_KEEP_OTHERS).partitionBy(*folders).text(f"{path}/lines")
    itemsets.withColumn("run_ts", F.lit(run_ts)).write.mode("overwrite").options(**_KEEP_OTHERS).partitionBy(*folders).parquet(f"{path}/itemsets")


def write_run_names(config: DataFrame, path: str, run_ts: str) -> None:
    """The run's output name ``<stamp>_<Id>_<name>`` of every collection, one
    folder per stamp."""
    named = config.select("collection_id", F.concat_ws("_", F.lit(run_ts), "collection_id", "name").alias("output_name"), F.lit(run_ts).alias("run_ts"))
    named.write.mode("overwrite").options(**_KEEP_OTHERS).partitionBy("run_ts").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
