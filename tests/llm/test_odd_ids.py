"""Null ids, repeated rows and clashing columns in the operators and stages
that have no such test of their own."""

import corpus_pipeline
import pytest

from relevo.llm import decontamination, quality_crf, sharding, toxicity, vector_search

GOOD = "The river runs past the old mill and the children play there.\n" * 3
BAD = "$$ 11 || ## 99 %% 00\n" * 4


@pytest.fixture
def rows():
    return [(None, GOOD), (None, GOOD), (None, None), (None, ""), (1, GOOD), (1, GOOD), (2, BAD), (3, GOOD + "One more line of words stands here."), (None, BAD)]


@pytest.fixture
def docs(spark, rows):
    schema = "doc_id long, text string, size string, shard string, slot int, score string, spans int, n_words string"
    return spark.createDataFrame([(*r, "x", "y", 1, "z", 2, "w") for r in rows], schema).repartition(3)


def test_shards_take_rows_without_an_id(docs, rows):
    out = sharding.shard_documents(docs, 2, 4).collect()
    assert len(out) == len(rows) and sum(r.doc_id is None for r in out) == 5
    for s in (0, 1):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_classifiers_score_rows_without_an_id(spark, docs, rows, label):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 0), (4, 1)], f"doc_id long, {label} int")
    if label == "quality":
        out = quality_crf.score_quality(docs, quality_crf.fit_quality(docs, labels)).collect()
    else:
        out = toxicity.score_toxicity(docs, toxicity.learn_lexicon(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    same = {}
    for r in out:
        same.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in same.values())  # equal texts are scored alike


def test_contamination_of_rows_without_an_id(spark, docs, rows):
    bench = spark.createDataFrame([(7, "the old mill and the children play there the river runs"), (None, "river runs"), (8, None)], "item_id long, text string")
    out = decontamination.find_contamination(docs, bench).collect()
    assert len(out) == len(rows)
    assert all((len(r.spans) > 0) == bool(r.text and "river" in r.text) for r in out)


def test_search_ignores_clashing_columns(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0], 5, 6, "s", 7) for i in range(30)], "vec_id long, embedding array<double>, query_id int, rank int, score string, q int")
    got = {tuple(r) for r in vector_search.top_k(vectors, vectors.filter("vec_id = 20"), 2).collect()}
    assert got == {(20, 1, 29, 29 * 20 * 4096 + 4096), (20, 2, 28, 28 * 20 * 4096 + 4096)}


def test_very_long_text_of_matches_and_exceptions():
    lexicon = toxicity.Lexicon({" idio": 5.0, " trash ": 3.0}, {toxicity.fold("trash can")})
    text = "trash can idiot " * 20_000
    assert len(list(lexicon.matches(toxicity.fold(text)))) == 20_000


def test_stages_take_rows_without_an_id(spark, sf_small, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
        assert out.count() <= len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() == len(rows)
