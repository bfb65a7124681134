"""Score newly arriving texts with already trained models.

Stateless Structured Streaming: file source -> cleaning and tokens (built-in
expressions) -> the join with the models' table -> one Parquet folder per
micro-batch, checkpointed under the shared checkpoint folder.
``trigger(availableNow=True)`` processes what is there and stops.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relevo.functions.text import clean_text, collection_of
from relevo.operators.model import CollectionModel, as_table, score
from relevo.operators.model_table import ModelTable
from relevo.operators.preprocess import prepare_texts
from relevo.session import is_folder, work_folder


def score_batch(texts: DataFrame, models: dict[str, CollectionModel] | ModelTable, feature_col: str = "words") -> DataFrame:
    """``id, collection_id, text`` -> scores with ``status``, one row per text
    (texts of collections without a model are kept)."""
    rows = prepare_texts(texts).select("id", "collection_id", F.col(feature_col).alias("filtered"))
    return score(models, rows)


def start_scoring(
    stream: DataFrame,
    models: dict[str, CollectionModel] | ModelTable,
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Score each micro-batch: its texts are read and tokenised once, joined
    with the models' table (written once, before the first batch), and written
    to the batch's own folder, which a repeated batch replaces."""
    table = as_table(models, stream)

    def write(batch: DataFrame, number: int) -> None:
        score_batch(batch, table).write.mode("overwrite").partitionBy("collection_id").parquet(f"{sink_path}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "10 seconds")
    return writer.start()


#: Bytes of files that a micro-batch of the documents reads.
BATCH_BYTES = 512 << 20
SCORES = "id string, prediction double, probability_relevant double, status string, batch long, collection_id string"


def read_scores(spark: SparkSession, sink_path: str) -> DataFrame:
    """What the stream has written; collection ids are text."""
    return spark.read.schema(SCORES).parquet(sink_path)


def score_document_stream(spark: SparkSession, sf_dir: str, run) -> DataFrame:
    """Stream ``documents`` through the trained models of ``run`` and return
    what the sink holds.  The table is one file or a folder of files."""
    folder = sf_dir.rstrip("/")
    path = f"{folder}/documents.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", BATCH_BYTES)
    if not is_folder(spark, path):  # a stream's source is a folder, here the one that holds the file
        reader, path = reader.option("pathGlobFilter", "documents.parquet"), folder
    raw = reader.parquet(path)
    texts = raw.select(
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("id"),
        collection_of(F.concat_ws("-", "source", F.col("doc_id").cast("string"))).alias("collection_id"),
        clean_text("text").alias("text"),
    )
    base = f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
    query = start_scoring(texts, run.table, f"{base}/sink", f"{base}/checkpoint")
    query.awaitTermination()
    return read_scores(spark, f"{base}/sink").drop("batch")
