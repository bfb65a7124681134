"""The pipeline against plain versions of its stages."""

import corpus_pipeline
import pytest
from brute import BLANKS, contamination, dedup_lines, near_classes, without_words

from relevo.llm.near_duplicates import shingle_set
from relevo.llm.quality_crf import fit_quality

sentencepiece = pytest.importorskip("sentencepiece")


def test_equal_to_plain_stages(spark, sf_small):
    read = lambda name: spark.read.parquet(f"{sf_small}/{name}.parquet")
    model = fit_quality(read("documents"), read("labels"))
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    rows = [r for r, s in zip(rows, model.scores([t for _, t in rows]), strict=True) if s >= 0.5]
    lines = dedup_lines(rows)
    rows = [(i, lines[i]) for i, t in rows if lines[i] == t or lines[i].translate(BLANKS).strip(" \n")]
    classes = {i: c for i, c, _ in near_classes(rows, lambda t: set(shingle_set(t).tolist()))}
    rows = [(i, t) for i, t in rows if classes[i] == i]
    out = {}
    for i, t in rows:
        n, hit, _ = contamination(t, items)
        if not hit or len(hit) < n:
            out[i] = without_words(t, hit) if hit else t
    library = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    got = corpus_pipeline.run(spark, sf_small).collect()
    assert {r.doc_id: r.text for r in got} == out and len(got) == len(out)
    assert all(r.ids == library.encode(r.text) and r.round_trip for r in got)
    assert all(r.n_chars == len(r.text) for r in got)


def test_stages_keep_the_columns_of_documents(spark, sf_small, odd_rows):
    docs = spark.createDataFrame([(i, t, "en", "src", None, "more") for i, t in odd_rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for part in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, part, sf_small)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, part, sf_small).collect()
