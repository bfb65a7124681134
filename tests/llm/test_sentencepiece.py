import itertools
import os
import random

import pytest

from relevo.llm import sentencepiece_fst as m

sentencepiece = pytest.importorskip("sentencepiece")
needs_model = pytest.mark.skipif(not os.path.exists(m.MODEL), reason="no model file")


@needs_model
def test_equal_to_the_library():
    theirs, ours = sentencepiece.SentencePieceProcessor(model_file=m.MODEL), m.Transducer.read(m.MODEL)
    texts = ["", " ", "   x  y    ", "\n", "\n\n  \nfoo", "▁", "a▁b", "<s>", "<unk> </s> <0x0A>", "é日本語 العربية 😀", "\x00\t x", "a" * 40, " " * 37 + "x", "x" * 5000, open(__file__).read()]
    rng = random.Random(1)
    alphabet = " \n  abcdetheing▁éñ0123456789.,!?'\"<>_-日本😀́"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    for t in texts:
        ids = ours.encode(t).tolist()
        assert ids == theirs.encode(t)
        assert ours.decode(ids) == theirs.decode(ids) == t.replace("▁", " ")


@needs_model
def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    theirs = sentencepiece.SentencePieceProcessor(model_file=m.MODEL)
    out = m.encode_documents(odd_docs)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.ids == (None if r.text is None else theirs.encode(r.text))
        assert r.n_tokens == len(r.ids or []) and r.round_trip == (None if r.text is None else True)
    back = m.decode_documents(out.drop("text")).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(odd_rows, key=repr)
    assert m.encode_documents(no_docs).count() == 0


@needs_model
def test_query_round_trips(spark, sf_small):
    out = m.query(spark, sf_small)
    assert out.filter("not round_trip").count() == 0 and out.count() == spark.read.parquet(f"{sf_small}/documents.parquet").count()


def test_shortest_path_of_scores_equals_all_paths():
    rng = random.Random(2)
    parts = ["a", "b", "c", "ab", "bc", "abc", "ca", "▁", "▁a", "cab"]
    pieces = [("<unk>", 0.0, 2)] + [(p, -rng.random() * 5, 1) for p in parts]
    fst = m.Transducer(pieces, merges=False, byte_fallback=False, prefix=True)
    score = dict((p, s) for p, s, _ in pieces[1:])
    for n in range(1, 8):
        word = "".join(rng.choice("abc") for _ in range(n))
        best = max((c for k in range(n) for cuts in itertools.combinations(range(1, n), k) if all((p := word[a:b]) in score for a, b in itertools.pairwise((0, *cuts, n))) and (c := sum(score[word[a:b]] for a, b in itertools.pairwise((0, *cuts, n)))) is not None), default=None)
        assert sum(score[p] for p in fst.shortest_path(word)) == pytest.approx(best)
    assert fst.encode("xy").tolist() == [8, 0]


def test_bounded_tables(monkeypatch):
    monkeypatch.setattr(m, "KNOWN_WORDS", 2)
    monkeypatch.setattr(m, "KNOWN_PAIRS", 2)
    pieces = [("<unk>", 0.0, 2), ("ab", -1.0, 1), ("bc", -2.0, 1), ("a", -3.0, 1), ("b", -4.0, 1), ("c", -5.0, 1), ("▁", -6.0, 1)]
    fst = m.Transducer(pieces, merges=True, byte_fallback=False, prefix=True)
    assert [fst.shortest_path(w) for w in ("abc", "bca", "cab", "abab", "bbc")] == [fst.merged(w) for w in ("abc", "bca", "cab", "abab", "bbc")]
    assert len(fst.words) <= 2 and len(fst.pairs) <= 2
