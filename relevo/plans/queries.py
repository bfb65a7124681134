"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole test tables.  Computed columns carry the same names as in
``relevo.plans.oracle``."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.functions.formats import class_probability, itemset_line, output_name, parse_cell
from relevo.functions.text import clean_text, strip_html
from relevo.operators.features import fold_frequencies, fold_idf, hash_tokens, term_idf, tf_idf
from relevo.operators.labeling import (
    HASH_RANGE,
    hash_unit,
    label_flags,
    multiclass_flags,
    positive_stats,
    sample_multiclass,
    sample_training,
    testing_set,
)
from relevo.operators.model import NUM_FOLDS, fold_of, score
from relevo.operators.model_table import ModelTable, naive_bayes_table
from relevo.operators.patterns import shortlist
from relevo.operators.preprocess import prepare_texts, transactions
from relevo.operators.ranking import area_under_roc
from relevo.operators.report import audit_sample, histogram, relevance_share, training_error
from relevo.plans import tables
from relevo.plans.jobs import file_histograms, mine_patterns
from relevo.session import materialize, work_folder
from relevo.sources.cell_store import read_cells, write_cells
from relevo.sources.cells import cells_to_texts, load_cells, select_collections
from relevo.sources.config import config_for_texts
from relevo.sources.lines import parse_lines
from relevo.sources.sinks import numbered_lines, read_predictions_tsv, score_cells, write_predictions_tsv, write_score_cells
from relevo.streaming.counts import read_counts, running_counts, start_counts

# Pattern chosen for every document collection of the test data (what a
# person would put in the config after reading the mined sets).
DOCUMENT_PATTERN = ("ing", "tion")
SHORTLIST_K = 10
AUDIT_K = 5
# Events above this value count as relevant in the running counts.
RELEVANT_VALUE = 50.0
# Support and least count of the mining queries (long assistant turns make the
# default support explode; the job's default stays as it is).
MINING_SUPPORT = 0.1
MINING_MIN_COUNT = 2
# Hash sizes of the feature queries: one a power of two, one not.
FEATURE_SIZES = (1024, 1000)
BAYES_FEATURES = 1000
# Run stamp of the queries that write files.
RUN_STAMP = "20240102-030405"
OLDER_STAMP = "20231231-235959"
# Multi-class collections: documents grouped by language, one word set per
# class (space-joined); class 0 = none of them.
LANGUAGE_CLASSES = ("ing tion", "les des", "der die")


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables.document_texts(spark, sf_dir)
    return t.select("id", "collection_id", clean_text("raw").alias("text"))


def prepared_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_texts(cleaned_documents(spark, sf_dir))


def configured_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared documents with their collection's config row (pattern)."""
    prepared = prepared_documents(spark, sf_dir)
    config = config_for_texts(prepared, DOCUMENT_PATTERN)
    return select_collections(prepared, config, key_col="id")


def flagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow label table ``id, collection_id, is_positive, is_candidate,
    n_features``, written once: the fractions and the sample both read it, and
    no text is written or shuffled."""
    flagged = label_flags(configured_documents(spark, sf_dir))
    narrow = flagged.select("id", "collection_id", "is_positive", "is_candidate", F.size("words").cast("long").alias("n_features"))
    return materialize(narrow, "flagged_documents")


def language_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared documents keyed ``<lang>-<doc_id>`` (collection = language)
    with the multi-class config attached."""
    d = tables.read_table(spark, sf_dir, "documents")
    texts = d.select(
        F.concat_ws("-", "lang", F.col("doc_id").cast("string")).alias("id"),
        F.col("lang").alias("collection_id"),
        clean_text("text").alias("text"),
    )
    prepared = prepare_texts(texts)
    config = config_for_texts(prepared, LANGUAGE_CLASSES, kind="multiclass")
    return select_collections(prepared, config, key_col="id")


def _joined(col: str) -> F.Column:
    return F.array_join(col, " ")


# --- scans, projections, scalar functions ---------------------------------


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_documents(spark, sf_dir)


def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = transactions(prepared_documents(spark, sf_dir), keep=("id", "words", "filtered"))
    return p.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        _joined("words").alias("words"),
        F.size("filtered").cast("long").alias("n_filtered"),
        _joined("filtered").alias("filtered"),
        _joined("items").alias("items"),
    )


def q_cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = load_cells(tables.document_cells(spark, sf_dir))
    texts = cells_to_texts(cells)
    return texts.select("id", "collection_id", "text")


def q_cell_qualifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per (family, qualifier): JSON decoded once per cell."""
    cells = load_cells(tables.document_cells(spark, sf_dir))
    decoded = cells.select(F.explode(F.split("cells", "\n")).alias("raw")).select(parse_cell("raw").alias("c"))
    return decoded.groupBy(
        F.col("c.columnFamily").alias("column_family"), F.col("c.qualifier").alias("qualifier")
    ).agg(F.count(F.lit(1)).alias("n_cells"), F.sum(F.length("c.value")).cast("long").alias("n_chars"))


def q_prefix_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts per configured collection under delimited and raw key-prefix
    matching (raw: id ``src1`` also takes ``src10-...``)."""
    texts = cleaned_documents(spark, sf_dir)
    config = config_for_texts(texts, DOCUMENT_PATTERN)
    delimited = select_collections(texts, config, delimited=True).groupBy("collection_id").agg(
        F.count(F.lit(1)).alias("n_delimited")
    )
    raw = select_collections(texts, config, delimited=False).groupBy("collection_id").agg(
        F.count(F.lit(1)).alias("n_raw")
    )
    return delimited.join(raw, "collection_id", "full_outer")


def q_line_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(tables.document_lines(spark, sf_dir))


def q_page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.read_table(spark, sf_dir, "pages")
    return pages.select(
        F.col("page_id").alias("id"),
        clean_text(strip_html("html")).alias("text"),
    )


def q_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON field read on ``events.props`` per event type."""
    ev = tables.read_table(spark, sf_dir, "events")
    k = F.from_json("props", "k long")["k"]
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count(k).alias("n_with_k"),
        F.sum(k).alias("sum_k"),
    )


# --- weak labels ------------------------------------------------------------


def q_positive_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = label_flags(configured_documents(spark, sf_dir))
    stats = positive_stats(flagged)
    return stats.select(
        "collection_id",
        "n_texts",
        "n_positive",
        "n_candidates",
        F.round("positive_fraction", 6).alias("positive_fraction"),
    )


def _training(spark: SparkSession, sf_dir: str, balanced: bool) -> DataFrame:
    t = sample_training(flagged_documents(spark, sf_dir), balanced=balanced)
    return t.select("id", "collection_id", "label", "n_features")


def q_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir, balanced=False)


def q_training_set_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir, balanced=True)


def q_multiclass_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = multiclass_flags(language_documents(spark, sf_dir))
    narrow = flagged.select("id", "collection_id", "class_no", "is_candidate", F.size("words").cast("long").alias("n_features"))
    t = sample_multiclass(materialize(narrow, "flagged_languages"))
    return t.select("id", "collection_id", "label", "n_features")


def q_testing_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = testing_set(prepared_documents(spark, sf_dir))
    return t.select("id", "collection_id", F.size("filtered").cast("long").alias("n_features"), _joined("filtered").alias("features"))


def q_audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_training(flagged_documents(spark, sf_dir))
    return audit_sample(t, "label", k=AUDIT_K).select(
        "collection_id", "label", F.col("sample_rank").cast("long").alias("sample_rank"), "id"
    )


# --- features, item sets, histograms ----------------------------------------


def q_term_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    idf = term_idf(prepared_documents(spark, sf_dir), tokens_col="words")
    return idf.select("term", "df", F.round("idf", 6).alias("idf"))


def _training_tokens(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(flagged documents, training rows) with the model's tokens as
    ``filtered``, written once."""
    flagged = label_flags(configured_documents(spark, sf_dir))
    rows = flagged.select("id", "collection_id", "is_positive", "is_candidate", F.col("words").alias("filtered"))
    rows = materialize(rows, "document_tokens")
    return rows, sample_training(rows).select("id", "collection_id", "filtered", "label")


def q_hashed_tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse features of every document by its collection's training rows."""
    rows, training = _training_tokens(spark, sf_dir)
    return tf_idf(rows, training, FEATURE_SIZES).select("id", "collection_id", "num_features", "idx", "tf", *[F.round(c, 6).alias(c) for c in ("idf", "tf_idf")])


def q_fold_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDF of every training part of the cross-validation."""
    _, training = _training_tokens(spark, sf_dir)
    folded = training.withColumn("fold", fold_of("id", NUM_FOLDS).cast("int"))
    hashed = materialize(hash_tokens(folded, FEATURE_SIZES).drop("filtered"), "hashed")
    n_rows = hashed.groupBy("collection_id", "fold").agg(F.count(F.lit(1)).alias("n_rows"))
    out = fold_idf(fold_frequencies(hashed, FEATURE_SIZES), n_rows)
    return out.select("collection_id", "num_features", "fold", "idx", "df", F.round("idf", 6).alias("idf"))


def _stored_bayes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ModelTable]:
    """(documents' tokens, naive Bayes models of all collections stored as
    tables and loaded again)."""
    rows, training = _training_tokens(spark, sf_dir)
    path = f"{work_folder(spark)}/stored-models-{uuid.uuid4().hex}"
    naive_bayes_table(materialize(training, "training_tokens"), BAYES_FEATURES).save(path)
    return rows, ModelTable.load(spark, path)


def q_bayes_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a join with the stored models."""
    rows, models = _stored_bayes(spark, sf_dir)
    out = score(models, rows)
    return out.select("id", "collection_id", "prediction", F.round("probability_relevant", 6).alias("probability_relevant"), "status")


def q_bayes_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored coefficients."""
    w = _stored_bayes(spark, sf_dir)[1].weights
    return w.select("collection_id", "idx", F.round("idf", 6).alias("idf"), *[F.round(F.get("weights", F.lit(c)), 6).alias(f"weight_{c}") for c in (0, 1)])


def mined_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item sets of all conversation turns, one collection per role; mined
    anew by each query that reads them."""
    turns = tables.conversation_turns(spark, sf_dir)
    cleaned = turns.select("id", "collection_id", clean_text("raw").alias("text"))
    return mine_patterns(cleaned, min_support=MINING_SUPPORT, min_count=MINING_MIN_COUNT)


def q_frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = mined_turns(spark, sf_dir)
    return sets.select(
        "collection_id",
        _joined("items").alias("items"),
        F.size("items").cast("long").alias("size"),
        "freq",
        itemset_line("freq", "items").alias("line"),
    )


def q_pattern_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = shortlist(mined_turns(spark, sf_dir), k=SHORTLIST_K)
    return sets.select("collection_id", F.col("rank").cast("long").alias("rank"), _joined("items").alias("items"), "freq")


def q_event_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tables.read_table(spark, sf_dir, "events")
    return histogram(ev, "value", "event_type")


# --- sinks and reports on a given score -------------------------------------


def q_pattern_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the pattern files with their number in the file."""
    return numbered_lines(mined_turns(spark, sf_dir))


def _event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores taken from ``events``: value as the probability."""
    ev = tables.read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("collection_id"),
        F.col("value").cast("double").alias("probability_relevant"),
    )


def q_prediction_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction files written and read back."""
    path = f"{work_folder(spark)}/predictions-{uuid.uuid4().hex}"
    write_predictions_tsv(_event_scores(spark, sf_dir), path, run_ts=RUN_STAMP)
    back = read_predictions_tsv(spark, path)
    return back.select("id", "collection_id", "run_ts", F.col("Probability").alias("probability"))


def q_file_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms of the newest prediction files: an older run of all
    collections, and a newer one of those whose name has an even length."""
    path = f"{work_folder(spark)}/predictions-{uuid.uuid4().hex}"
    scores = _event_scores(spark, sf_dir)
    write_predictions_tsv(scores.withColumn("probability_relevant", -F.col("probability_relevant")), path, run_ts=OLDER_STAMP)
    write_predictions_tsv(scores.filter(F.length("collection_id") % 2 == 0), path, run_ts=RUN_STAMP)
    return file_histograms(spark, path)


def q_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted by a stream in which every third one arrives twice."""
    folder = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    twice = raw.withColumn("_copy", F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    texts = twice.select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("collection_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    base = f"{work_folder(spark)}/counts-{uuid.uuid4().hex}"
    start_counts(running_counts(texts, F.col("value") > RELEVANT_VALUE), f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return read_counts(spark, f"{base}/counts").withColumn("relevant_share", F.round("relevant_share", 6))


def q_score_cell_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score cells written twice for one run and read back (once)."""
    path = f"{work_folder(spark)}/cells-{uuid.uuid4().hex}/run_ts={RUN_STAMP}"
    scores = _event_scores(spark, sf_dir)
    write_score_cells(scores, path)
    write_score_cells(scores, path)
    cells = spark.read.schema(score_cells(scores).schema).parquet(path)
    return cells.select("row_key", "column_family", "qualifier", F.col("value").cast("double").alias("value"))


def q_cell_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents put into a cell store by two runs (the second one replaces
    the languages of every third document) and read back."""
    path = f"{work_folder(spark)}/store-{uuid.uuid4().hex}"
    d = tables.read_table(spark, sf_dir, "documents")
    key = F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("row_key")
    cell = lambda family, qualifier, value: F.struct(F.lit(family).alias("column_family"), F.lit(qualifier).alias("qualifier"), value.alias("value"))
    both = F.explode(F.array(cell("metadata", "lang", F.col("lang")), cell("collection-management", "chars", F.col("n_chars").cast("string")))).alias("c")
    write_cells(d.select(key, both).select("row_key", "c.*"), path, OLDER_STAMP)
    again = d.filter(F.col("doc_id") % 3 == 0).select(key, cell("metadata", "lang", F.upper("lang")).alias("c"))
    write_cells(again.select("row_key", "c.*"), path, RUN_STAMP)
    return read_cells(spark, path)


def q_run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output names of runs stamped with the events' times."""
    ev = tables.read_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return ev.select("event_id", output_name("ts", F.col("event_id").cast("string"), kind).alias("output_name"))


def q_fold_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validation fold of every document."""
    t = tables.document_texts(spark, sf_dir)
    return t.select("id", "collection_id", fold_of("id", NUM_FOLDS).cast("long").alias("fold"))


def q_vector_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probability picked out of a vector built from columns."""
    ev = tables.read_table(spark, sf_dir, "events")
    vector = array_to_vector(F.array(-F.col("value").cast("double"), F.col("value").cast("double")))
    return ev.filter("value is not null").select("event_id", class_probability(vector).alias("probability"))


def _labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A documented score for the labelled documents: the hash of the id as
    the probability, ``quality`` as the label."""
    d = tables.read_table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("collection_id"))
    labels = tables.read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    p = hash_unit("id") / F.lit(float(HASH_RANGE))
    rows = d.join(labels, "doc_id").select(F.col("doc_id").cast("string").alias("id"), "collection_id", "label")
    return rows.withColumn("probability_relevant", p).withColumn("prediction", F.when(F.col("probability_relevant") > 0.5, 1.0).otherwise(0.0))


def q_label_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misclassified rows per collection for the documented score."""
    texts = tables.read_table(spark, sf_dir, "documents").groupBy(F.col("source").alias("collection_id")).agg(F.count(F.lit(1)).alias("n_texts"))
    out = training_error(_labelled_scores(spark, sf_dir), texts)
    return out.select("collection_id", "n_texts", "n_training", "n_wrong", *[F.round(c, 6).alias(c) for c in ("error_all_texts", "error_training")])


def q_label_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share predicted relevant per collection for the documented score."""
    out = relevance_share(_labelled_scores(spark, sf_dir))
    return out.select("collection_id", "n_texts", "n_relevant", *[F.round(c, 6).alias(c) for c in ("relevant_share", "mean_probability")])


def q_quality_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact area under ROC of the documented score, rounded so that scores
    tie, and of the text's length, against ``labels.quality``; one row for
    each collection and score."""
    rows = _labelled_scores(spark, sf_dir)
    length = tables.read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.length("text").cast("double").alias("length"))
    kinds = F.explode(F.array(F.struct(F.lit("hash").alias("kind"), F.round("probability_relevant", 2).alias("score")), F.struct(F.lit("length").alias("kind"), F.col("length").alias("score"))))
    scored = rows.join(length, "id").select("collection_id", "label", kinds.alias("k")).select("collection_id", "label", "k.*")
    out = area_under_roc(scored, ["collection_id", "kind"])
    return out.select("collection_id", "kind", "n_positive", "n_negative", F.round("auc", 6).alias("auc"))


SQL_CHECKED = {
    "clean_text": q_clean_text,
    "tokens": q_tokens,
    "cell_texts": q_cell_texts,
    "cell_qualifiers": q_cell_qualifiers,
    "prefix_collections": q_prefix_collections,
    "line_texts": q_line_texts,
    "page_texts": q_page_texts,
    "event_props": q_event_props,
    "positive_share": q_positive_share,
    "training_set": q_training_set,
    "training_set_balanced": q_training_set_balanced,
    "multiclass_training_set": q_multiclass_training_set,
    "testing_set": q_testing_set,
    "audit_sample": q_audit_sample,
    "term_idf": q_term_idf,
    "hashed_tf_idf": q_hashed_tf_idf,
    "fold_idf": q_fold_idf,
    "bayes_scores": q_bayes_scores,
    "bayes_weights": q_bayes_weights,
    "quality_auc": q_quality_auc,
    "frequent_itemsets": q_frequent_itemsets,
    "pattern_shortlist": q_pattern_shortlist,
    "event_histogram": q_event_histogram,
    "pattern_file_lines": q_pattern_file_lines,
    "prediction_roundtrip": q_prediction_roundtrip,
    "file_histogram": q_file_histogram,
    "running_counts": q_running_counts,
    "score_cell_rows": q_score_cell_rows,
    "cell_store": q_cell_store,
    "run_names": q_run_names,
    "fold_numbers": q_fold_numbers,
    "vector_probability": q_vector_probability,
    "label_error": q_label_error,
    "label_share": q_label_share,
}
