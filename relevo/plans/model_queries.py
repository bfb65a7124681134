"""Registered queries built on trained models (rows-only checks; their
properties are tested in ``tests/test_model.py``).

The classification of the document collections is trained once per session
and test folder and shared by these queries.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.operators.labeling import multiclass_flags, sample_multiclass, testing_set
from relevo.operators.model import TuningSpec, apply_multiclass, default_concurrency, ensemble, train_collections
from relevo.operators.model_table import model_table
from relevo.operators.report import relevance_share
from relevo.plans.jobs import Classification, classify, score_histograms
from relevo.plans.queries import DOCUMENT_PATTERN, RUN_STAMP, cleaned_documents, language_documents
from relevo.session import materialize, work_folder
from relevo.sources.config import config_for_texts
from relevo.sources.sinks import read_predictions_tsv, score_cells, write_predictions_tsv

_LOCK = threading.RLock()
_RUNS: dict[tuple, object] = {}


def _cached(spark: SparkSession, sf_dir: str, kind: str, build):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    with _LOCK:
        if key not in _RUNS:
            # one folder's runs at a time
            for old in [k for k in _RUNS if k[:2] != key[:2]]:
                del _RUNS[old]
            _RUNS[key] = build()
        return _RUNS[key]


def release_runs() -> None:
    """Forget trained runs, so that the next query trains anew."""
    with _LOCK:
        _RUNS.clear()


def document_classification(spark: SparkSession, sf_dir: str) -> Classification:
    def build() -> Classification:
        texts = cleaned_documents(spark, sf_dir)
        config = config_for_texts(texts, DOCUMENT_PATTERN)
        return classify(texts, config)

    return _cached(spark, sf_dir, "logistic", build)


def _naive_bayes(spark: SparkSession, sf_dir: str):
    run = document_classification(spark, sf_dir)
    spec = TuningSpec(classifiers=("naive_bayes",), parallelism=run.spec.parallelism)
    return _cached(spark, sf_dir, "naive_bayes", lambda: train_collections(run.training, spec, prefix="nb_", hashed=run.hashed))


def q_relevance_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_classification(spark, sf_dir).scores()


def q_score_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_cells(document_classification(spark, sf_dir).scores())


def q_training_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_classification(spark, sf_dir).training_error()


def q_score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_histograms(document_classification(spark, sf_dir).scores())


def q_relevance_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relevance_share(document_classification(spark, sf_dir).scores())


def q_classifier_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per collection of the texts: cross-validated AUC of logistic regression
    and naive Bayes and the better of the two (null where neither was tuned)."""
    run = document_classification(spark, sf_dir)
    metric = "collection_id string, kind string, auc double"
    pairs = [("logistic", run.models), ("naive_bayes", _naive_bayes(spark, sf_dir))]
    tuned = spark.createDataFrame([(cid, kind, m.cv_auc) for kind, models in pairs for cid, m in sorted(models.items())], metric)
    wide = tuned.groupBy("collection_id").pivot("kind", ["logistic", "naive_bayes"]).agg(F.max("auc"))
    wide = run.prepared.select("collection_id").distinct().join(wide, "collection_id", "left")
    a, b = F.col("logistic"), F.col("naive_bayes")
    best = F.when(a.isNull() & b.isNull(), None).when(b.isNull() | (a >= b), "logistic").otherwise("naive_bayes")
    return wide.select("collection_id", a.alias("logistic_auc"), b.alias("naive_bayes_auc"), best.alias("best"))


def q_scored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with what its score rests on."""
    return document_classification(spark, sf_dir).scores().select("id", "collection_id", "status")


def q_multiclass_scored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_multiclass_scores(spark, sf_dir).select("id", "collection_id", "status")


def q_ensemble_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = document_classification(spark, sf_dir)
    return ensemble(run.table, _naive_bayes(spark, sf_dir), run.testing())


def q_prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction files (``id TAB Probability`` with header, one folder per
    collection and run stamp) written and read back."""
    run = document_classification(spark, sf_dir)
    path = f"{work_folder(spark)}/predictions-{uuid.uuid4().hex}"
    write_predictions_tsv(run.scores(), path, run_ts=RUN_STAMP)
    return read_predictions_tsv(spark, path).select("id", "Probability", "collection_id", "run_ts")


def q_stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from relevo.streaming.scoring import score_document_stream

    run = document_classification(spark, sf_dir)
    return score_document_stream(spark, sf_dir, run)


def _multiclass(spark: SparkSession, sf_dir: str):
    """(tokens of every text, models' table) of the documents by language."""

    def build():
        flagged = multiclass_flags(language_documents(spark, sf_dir))
        prepared = materialize(flagged.select("id", "collection_id", "words", "class_no", "is_candidate"), "language_prepared", ["collection_id"])
        train = sample_multiclass(prepared).select("id", "collection_id", F.col("words").alias("filtered"), "label")
        spec = TuningSpec(classifiers=("multinomial",), parallelism=default_concurrency(spark)[1])
        models = train_collections(materialize(train, "language_training", ["collection_id"]), spec)
        return prepared, model_table(spark, models)

    return _cached(spark, sf_dir, "multiclass", build)


def q_multiclass_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-class collections (documents by language): multinomial logistic
    regression tuned per collection by cross-validated F1; predicted class
    and its probability for every text."""
    prepared, models = _multiclass(spark, sf_dir)
    return apply_multiclass(models, testing_set(prepared))


MODEL_QUERIES = {
    "relevance_scores": q_relevance_scores,
    "score_cells": q_score_cells,
    "training_error": q_training_error,
    "score_histogram": q_score_histogram,
    "relevance_share": q_relevance_share,
    "classifier_choice": q_classifier_choice,
    "ensemble_scores": q_ensemble_scores,
    "prediction_files": q_prediction_files,
    "stream_scores": q_stream_scores,
    "multiclass_scores": q_multiclass_scores,
    "scored_ids": q_scored_ids,
    "multiclass_scored_ids": q_multiclass_scored_ids,
}
