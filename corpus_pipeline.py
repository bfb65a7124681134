"""Corpus pipeline: quality, repeated lines, near duplicates, benchmark
decontamination, tokens.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame.  All but the last return the columns of the
documents they get, so a stage works on all that the one before it kept:

* ``quality_classifier`` drops the documents whose line-field score is low;
* ``line_dedup`` removes lines that repeat an earlier one (a document left
  without words goes);
* ``ngram_jaccard_join`` keeps one document, the least id, of every class of
  near duplicates;
* ``benchmark_decontamination`` cuts the words of benchmark windows out of the
  texts (a document left without words goes);
* ``sentencepiece`` adds the ids of the pieces, and tells whether they decode
  to the text.

``run`` writes each stage as Parquet to the folder that the cluster shares and
reads it back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relevo.llm.common import table
from relevo.llm.decontamination import remove_contamination
from relevo.llm.line_dedup import remove_repeated_lines
from relevo.llm.near_duplicates import keep_one_of_each
from relevo.llm.quality_crf import keep_good
from relevo.llm.sentencepiece_fst import encode_documents
from relevo.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: The classifier's fit and the encoder can't be said in SQL; the tests hold
#: the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
