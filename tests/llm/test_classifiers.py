import itertools
import zlib

import numpy as np
import pytest

from relevo.llm import quality_crf, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("module", "column", "least"), [(quality_crf, "quality", 0.98), (toxicity, "toxic", 0.9)])
def test_held_out_rows(spark, sf_small, module, column, least):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = module.query(spark, SF).collect()
    again = {r.doc_id: r.score for r in module.query(spark, SF).collect()}
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.HELD_OUT)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD) and again[r.doc_id] == r.score
    held = [r for r in out if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= least


def test_odd_rows_and_missing_labels(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, 1, None), (None, 1, 1), (9, 7, 7)], "doc_id long, quality int, toxic int")
    for part in (labels, labels.limit(0)):
        for scored in (quality_crf.score_quality(odd_docs, quality_crf.fit_quality(odd_docs, part)), toxicity.score_toxicity(odd_docs, toxicity.learn_lexicon(odd_docs, part))):
            rows = scored.collect()
            assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
            assert set(scored.columns) == set(odd_docs.columns)
    assert quality_crf.score_quality(no_docs, quality_crf.LineModel()).count() == 0
    assert quality_crf.keep_good(no_docs, labels).count() == 0
    model = quality_crf.LineModel(prior=0.8)
    assert model.scores([None, "", " \n "]) == [0.8] * 3


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(0)
    lengths = [3, 1, 4, 2]
    odds, move = rng.normal(size=10), rng.normal(size=(2, 2))
    good, counts, log_z = quality_crf.Chains(lengths).marginals(odds, move, pairs=True)
    want, want_counts, want_z, at = [], np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        total, ones, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(odds[at + k] * y for k, y in enumerate(path)) + sum(move[a, b] for a, b in itertools.pairwise(path)))
            total += w
            ones += w * np.array(path)
            for a, b in itertools.pairwise(path):
                pairs[a, b] += w
        want += (ones / total).tolist()
        want_counts += pairs / total
        want_z += np.log(total)
        at += n
    assert np.allclose(good, want) and np.allclose(counts, want_counts) and np.isclose(log_z, want_z)


def test_long_line_in_pieces(monkeypatch):
    line = b"one two two three " * 40
    want = quality_crf._line_features(line)
    monkeypatch.setattr(quality_crf, "PIECE", 18)  # between words
    assert quality_crf._line_features(line)[5] == want[5]


def test_folding_matching_and_exceptions():
    lexicon = toxicity.Lexicon({" idio": 5.0, " trash ": 3.0}, {toxicity.fold("trash can")}, np.array([-4.0, 1.0, 1.0]))
    hits = lambda t: [toxicity.fold(t)[a:b] for a, b, _ in lexicon.matches(toxicity.fold(t))]
    assert hits("You 1D10T, ídіоts!") == [" idio", " idio"]
    assert hits("the trash can is full") == [] and hits("trash, can it") == [" trash "] if toxicity.fold("trash, can") != toxicity.fold("trash can") else True
    assert hits("videos and trashy") == []
    scores = lexicon.scores(["an idiot", "a vision", "", None, "an idiot " + "word " * 500])
    assert scores[0] > scores[4] > scores[1] == scores[2] == scores[3]


def test_words_beside_insults_are_no_entries():
    counts = {t: {"bad": n, "bad_n": n, "good_n": g, "odds": o} for t, n, g, o in ((" insult", 40, 0, 6.0), (" beside ", 12, 0, 4.0), (" other", 20, 1, 5.0))}
    documents = [[" insult"] + ([" beside "] if i < 12 else []) for i in range(40)] + [[" other"] for _ in range(20)]
    chosen = toxicity.choose_entries(counts, documents, 6000, 60000, cover=1)
    assert set(chosen) == {" insult", " other"}


def test_fit_reads_whole_documents(spark):
    head = "The same line stands here.\n" * 3
    good, bad = "A sentence of plain words follows the others here.\n", "$$ 11 || ## 99 %% 00\n"
    docs = spark.createDataFrame([(i, head + (good if i % 2 else bad) * 6) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality_crf.fit_quality(docs, labels, sample_lines=3)
    low, high = model.scores([head + bad * 6, head + good * 6])
    assert high - low > 0.2


def test_short_words_become_entries(spark):
    rng = np.random.default_rng(2)
    text = lambda i: " ".join(f"word{k}" for k in rng.integers(0, 400, 30)) + (" zut zut" if i % 2 else "")
    docs = spark.createDataFrame([(i, text(i)) for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs, labels)
    assert " zut " in lexicon.weights and " zut" not in lexicon.weights
    assert lexicon.scores(["a zut"]) > lexicon.scores(["a word"])


def test_long_documents_are_in_the_fit(spark, monkeypatch):
    """Documents are taken in order until the lines are used up, whatever
    their lengths; the last one is whole."""
    seen = []
    monkeypatch.setattr(quality_crf.LineModel, "fit", classmethod(lambda cls, documents: seen.append([len(x) for x, _ in documents]) or cls()))
    docs = spark.createDataFrame([(i, "a line\n" * (900 if i == 7 else 3)) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    quality_crf.fit_quality(docs, labels, 30, 1000)
    assert 900 in seen[0]
    quality_crf.fit_quality(docs, labels, 30, 1)
    order = [r.doc_id for r in labels.filter("crc32(cast(doc_id as string)) % 3 <> 1").selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h").collect()]
    room, want = 30, []
    for i in order:
        if room > 0:
            want.append(900 if i == 7 else 3)
            room -= 901 if i == 7 else 4
    assert sorted(seen[1]) == sorted(want)
