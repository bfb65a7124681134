import random

import numpy as np
from brute import contamination, without_words

from relevo.llm import decontamination as m
from relevo.llm.fm_index import FMIndex


def test_index_finds_all_places():
    rng = np.random.default_rng(1)
    for n, sigma, rate in ((0, 2, 4), (1, 1, 4), (60, 2, 5), (2000, 6, 16)):
        seq = rng.integers(1, sigma + 1, n)
        index = FMIndex(seq, rate)
        for length in (1, 3, 6):
            patterns = rng.integers(1, sigma + 1, (30, length))
            patterns = patterns[(patterns < index.sigma).all(axis=1)]
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high, strict=True):
                assert sorted(index.locate(np.arange(a, b))) == [i for i in range(n - length + 1) if (seq[i : i + length] == p).all()]


def _tables(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)] + ["Über", "naïve", "日本"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((30, 12, 10, 3, 2, 0))] + [(6, None), (7, "W1 w2, W3"), (7, "w1 w2 w3"), (None, "w9 w9 w9")]
    docs = [(i, text(40) + ("\n" + items[i % 5][1].upper() + "! " if i % 2 else "") + text(9)) for i in range(25)] + [(90, None), (91, ""), (92, "..."), (93, items[0][1])]
    d = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, spans int, items string").repartition(2)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id long")
    return docs, items, d, b


def test_equal_to_plain_search(spark):
    docs, items, d, b = _tables(spark)
    for block in (1 << 20, 60):  # one block of the benchmark, and several
        for r in m.find_contamination(d, b, block_bytes=block).collect():
            n, hit, found = contamination(dict(docs)[r.doc_id], items)
            assert r.n_words == n
            assert {w for s in r.spans for w in range(s.start, s.end)} == hit
            assert r["items"] == sorted(str(x) for x in found if x is not None)
            assert all(x.end < y.start for x, y in zip(r.spans, r.spans[1:], strict=False))


def test_words_are_cut_out(spark):
    docs, items, d, b = _tables(spark)
    out = {r.doc_id: r.text for r in m.remove_contamination(d, b).collect()}
    for i, t in docs:
        n, hit, _ = contamination(t, items)
        if hit and len(hit) == n:
            assert i not in out
        else:
            assert out[i] == (t if t is None else without_words(t, hit))


def test_empty_tables(spark, odd_docs, odd_rows, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.spans and not r["items"] for r in m.find_contamination(odd_docs, bench).collect())
    assert m.find_contamination(no_docs, bench).count() == 0
    kept = m.remove_contamination(odd_docs, bench)
    assert kept.columns == odd_docs.columns and sorted(kept.collect(), key=repr) == sorted(odd_docs.collect(), key=repr)


def test_long_texts_are_split_between_words(monkeypatch):
    text = "ab cd, " * 50
    want = list(m.words(text))
    monkeypatch.setattr(m, "PIECE", 7)
    assert [w for p in m.pieces(text.encode(), 7) for w in m._WORD.findall(p)] == want and b"".join(m.pieces(text.encode(), 7)) == text.encode()
