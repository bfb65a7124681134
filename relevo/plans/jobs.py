"""End-to-end jobs: mine patterns (J1), classify and score (J2), histograms of
the scores or of prediction files (J3).  The data work for all collections is
one plan; FP-growth runs once a band of wanted counts, only the model fits loop
over collections, and scores come from the table of the models."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.operators.labeling import label_flags, positive_stats, sample_training
from relevo.operators.model import (
    CollectionModel,
    TuningSpec,
    apply_models,
    default_concurrency,
    hashed_training,
    score,
    train_collections,
)
from relevo.operators.model_table import ModelTable, model_table
from relevo.operators.patterns import MIN_COUNT, MIN_SUPPORT, frequent_itemsets
from relevo.operators.preprocess import prepare_texts, transactions
from relevo.operators.report import histogram, training_error
from relevo.session import materialize
from relevo.sources.cells import select_collections
from relevo.sources.models import save_models
from relevo.sources.sinks import newest_predictions, read_predictions_tsv, write_patterns, write_predictions_tsv


def mine_patterns(
    texts: DataFrame,
    config: DataFrame | None = None,
    min_support: float = MIN_SUPPORT,
    out_path: str | None = None,
    run_ts: str | None = None,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """J1: cleaned texts (``id, collection_id, text``) -> frequent word sets
    per collection (``collection_id, items, freq``); optionally written as
    pattern files."""
    if config is not None:
        texts = select_collections(texts, config.select("collection_id"))
    tx = transactions(prepare_texts(texts), keep=("collection_id",))
    sets = frequent_itemsets(materialize(tx, "transactions"), min_support=min_support, min_count=min_count)
    if out_path:
        write_patterns(sets, out_path, run_ts or "run")
    return sets


@dataclass
class Classification:
    prepared: DataFrame
    training: DataFrame
    models: dict[str, CollectionModel]
    stats: DataFrame
    spec: TuningSpec
    table: ModelTable
    hashed: DataFrame | None = field(default=None, repr=False)
    _scores: DataFrame | None = field(default=None, repr=False)

    def testing(self) -> DataFrame:
        return self.prepared.select("id", "collection_id", "filtered")

    def scores(self) -> DataFrame:
        """Scores of every text, computed once and written under the
        checkpoint folder (partitioned by collection); every summary reads
        that table instead of re-running the models."""
        if self._scores is None:
            self._scores = materialize(score(self.table, self.testing()), "scores", ["collection_id"])
        return self._scores

    def training_predictions(self) -> DataFrame:
        return apply_models(self.table, self.training, keep=("label",))

    def training_error(self) -> DataFrame:
        err = training_error(self.training_predictions(), self.stats)
        spark = self.training.sparkSession
        aucs = spark.createDataFrame(
            [(cid, m.kind, m.cv_auc) for cid, m in sorted(self.models.items())],
            "collection_id string, classifier string, cv_auc double",
        )
        return err.join(aucs, "collection_id", "left")


def classify(
    texts: DataFrame,
    config: DataFrame,
    spec: TuningSpec | None = None,
    feature_col: str = "words",
    balanced: bool = False,
    concurrency: int | None = None,
    predictions_path: str | None = None,
    run_ts: str | None = None,
    models_path: str | None = None,
) -> Classification:
    """J2: cleaned texts + config -> weak labels -> one tuned model per
    collection -> scores for every text.

    The tokens and label flags are written once under the checkpoint folder
    (neither texts nor a second token column), partitioned by collection, so
    the model loop reads only each collection's files and never recomputes the
    cleaning.
    """
    spec = spec or TuningSpec(parallelism=default_concurrency(texts.sparkSession)[1])
    flagged = label_flags(select_collections(prepare_texts(texts), config))
    flagged = flagged.select("id", "collection_id", "is_positive", "is_candidate", F.col(feature_col).alias("filtered"))
    prepared = materialize(flagged, "prepared", ["collection_id"])
    train = sample_training(prepared, balanced=balanced).select("id", "collection_id", "filtered", "label")
    train = materialize(train, "training", ["collection_id"])
    hashed = hashed_training(train, spec)
    models = train_collections(train, spec, concurrency=concurrency, hashed=hashed)
    table = model_table(texts.sparkSession, models)
    if models_path:
        save_models(models, models_path, table)
    result = Classification(prepared, train, models, positive_stats(prepared), spec, table, hashed)
    if predictions_path:
        write_predictions_tsv(result.scores(), predictions_path, run_ts or "run")
    return result


def file_histograms(spark: SparkSession, path: str, run_ts: str | None = None) -> DataFrame:
    """J3 over the prediction files below ``path``: each collection's newest
    run, or those of one stamp.  Result with the run stamp."""
    scores = newest_predictions(spark, path) if run_ts is None else read_predictions_tsv(spark, path).filter(F.col("run_ts") == run_ts)
    return histogram(scores, "Probability", ["collection_id", "run_ts"])


def score_histograms(scores: DataFrame, probability_col: str = "probability_relevant") -> DataFrame:
    """J3: 10-bin histogram of the relevance probability per collection."""
    return histogram(scores, probability_col, "collection_id")
