"""Running counts of newly arriving texts, by collection.

A stateful stream: a text whose row key was met within the watermark's delay
is a repetition and dropped; the others are counted by collection.  The state
is a row key's time of expiry and two numbers a collection, in the stream's
checkpoint; a stopped stream goes on from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

COUNTS = "collection_id string, n_texts long, n_relevant long"


def relevance_counts(texts: DataFrame, relevant: Column) -> DataFrame:
    """``collection_id, n_texts, n_relevant`` of a batch or a stream."""
    return texts.groupBy("collection_id").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(F.coalesce(relevant, F.lit(False))).alias("n_relevant"))


def with_share(counts: DataFrame) -> DataFrame:
    return counts.withColumn("relevant_share", F.try_divide(F.col("n_relevant").cast("double"), F.col("n_texts")))


def running_counts(stream: DataFrame, relevant: Column, time_col: str = "ts", id_col: str = "id", delay: str = "1 hour") -> DataFrame:
    """The counts of a stream with ``id, collection_id`` and an event time."""
    unique = stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])
    return relevance_counts(unique, relevant)


def start_counts(counts: DataFrame, path: str, checkpoint_path: str, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Write all collections' counts after each micro-batch to the batch's own
    folder, which a repeated batch replaces."""

    def write(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "10 seconds")
    return writer.start()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts after the last batch, with the share of relevant texts."""
    every = spark.read.schema(f"{COUNTS}, batch long").parquet(path)
    last = every.select(F.max("batch")).scalar()
    return with_share(every.filter(F.col("batch") == last).drop("batch"))
