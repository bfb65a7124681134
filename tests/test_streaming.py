"""Stream scoring: the stream gives the same scores as the batch path."""

import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from relevo.functions.text import clean_text, collection_of
from relevo.operators.model import TuningSpec, as_table, score, train_collections
from relevo.operators.preprocess import prepare_texts
from relevo.session import checkpoint_dir
from relevo.streaming.scoring import read_scores, score_document_stream, start_scoring


def test_stream_equals_batch(spark, tmp_path):
    rows = []
    for i in range(40):
        pos = i % 2 == 0
        text = "storm flood river warning" if pos else "music party dance tonight"
        rows.append((f"s-{i}", f"{text} item{i % 3}"))
    rows.append(("unknown-1", "a text of no collection"))
    src = tmp_path / "in"
    spark.createDataFrame(rows, "key string, body string").write.parquet(str(src))

    static = spark.read.parquet(str(src))
    texts = static.select(F.col("key").alias("id"), collection_of("key").alias("collection_id"), clean_text("body").alias("text"))
    prepared = prepare_texts(texts)
    train = prepared.filter("collection_id = 's'").select(
        "id", "collection_id", F.col("words").alias("filtered"),
        F.when(F.array_contains("words", "storm"), 1.0).otherwise(0.0).alias("label"),
    )
    models = train_collections(train, TuningSpec(num_features=(64,), reg_params=(0.01,), num_folds=2), concurrency=1)

    stream = spark.readStream.schema(static.schema).parquet(str(src))
    stexts = stream.select(F.col("key").alias("id"), collection_of("key").alias("collection_id"), clean_text("body").alias("text"))
    base = f"{checkpoint_dir(spark)}/test-stream-{uuid.uuid4().hex}"
    q = start_scoring(stexts, models, f"{base}/sink", f"{base}/ckpt")
    q.awaitTermination()
    out = read_scores(spark, f"{base}/sink").collect()
    assert {r.id: r.status for r in out}["unknown-1"] == "untrained" and len(out) == 41
    got = {r.id: r.probability_relevant for r in out if r.status == "trained"}
    want = {r.id: r.probability_relevant for r in score(models, prepared.filter("collection_id = 's'").select("id", "collection_id", F.col("words").alias("filtered"))).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("files", [0, 3])
def test_documents_as_a_file_or_a_folder(spark, tmp_path, files):
    words = ["storm flood river", "music party dance"]
    docs = spark.createDataFrame([(i, words[i % 2], "en", f"s{i % 2}", 9) for i in range(12)], "doc_id long, text string, lang string, source string, n_chars long")
    at = tmp_path / "documents.parquet"
    docs.repartition(files or 1).write.parquet(str(at if files else tmp_path / "x"))
    if not files:
        next((tmp_path / "x").glob("part-*.parquet")).rename(at)
    run = SimpleNamespace(table=as_table({}, docs))
    out = score_document_stream(spark, str(tmp_path), run).collect()
    assert sorted((r.id, r.collection_id, r.status) for r in out) == sorted((f"s{i % 2}-{i}", f"s{i % 2}", "untrained") for i in range(12))


def test_running_counts_go_on_from_the_checkpoint(spark, tmp_path):
    from relevo.streaming.counts import read_counts, relevance_counts, running_counts, start_counts, with_share

    schema = "id string, collection_id string, ts timestamp, p double"
    src = str(tmp_path / "in")
    hours = [[("a-1", "a", 0, 0.9), ("a-2", "a", 1, 0.1), ("a-1", "a", 0, 0.9), ("b-1", "b", 2, None)], [("a-2", "a", 2, 0.1), ("a-3", "a", 3, 0.8), ("b-2", "b", 3, 0.7)]]

    def arrive(rows):
        at = [(i, c, f"2024-01-01 00:{10 * h:02d}:00", p) for i, c, h, p in rows]
        df = spark.createDataFrame(at, "id string, collection_id string, t string, p double")
        df.select("id", "collection_id", F.col("t").cast("timestamp").alias("ts"), "p").write.mode("append").parquet(src)

    def go():
        stream = spark.readStream.schema(schema).parquet(src)
        start_counts(running_counts(stream, F.col("p") > 0.5), str(tmp_path / "c"), str(tmp_path / "k")).awaitTermination()
        return {tuple(r) for r in read_counts(spark, str(tmp_path / "c")).select("collection_id", "n_texts", "n_relevant", "relevant_share").collect()}

    arrive(hours[0])
    assert go() == {("a", 2, 1, 0.5), ("b", 1, 0, 0.0)}
    arrive(hours[1])  # a stopped stream goes on: a-2 was met before
    last = go()
    batch = with_share(relevance_counts(spark.read.schema(schema).parquet(src).dropDuplicates(["id"]), F.col("p") > 0.5))
    assert last == {tuple(r) for r in batch.select("collection_id", "n_texts", "n_relevant", "relevant_share").collect()} == {("a", 3, 2, 2 / 3), ("b", 2, 1, 0.5)}
