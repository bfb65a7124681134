import itertools
import os
import zlib

import numpy as np
import pytest

from relevo.llm import packing as m

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


def fewest(lengths, capacity):
    """The least number of sequences, by trying every way."""
    best = len(lengths)

    def place(i, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if i == len(lengths):
            best = len(loads)
            return
        for k in range(len(loads)):
            if loads[k] + lengths[i] <= capacity:
                place(i + 1, [*loads[:k], loads[k] + lengths[i], *loads[k + 1 :]])
        place(i + 1, [*loads, lengths[i]])

    place(0, [])
    return best


def held(rows, capacity=m.CAPACITY):
    """Sequences of (sequence_id, offset, length) rows, gapless and in bounds."""
    count = 0
    for _, own in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        at = 0
        for _, offset, length in own:
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        count += 1
    return count


def test_bounds_and_best_fit_against_every_way():
    rng = np.random.default_rng(5)
    certified = 0
    for _ in range(150):
        lengths = rng.integers(1, 13, rng.integers(1, 9)) if rng.random() < 0.5 else rng.choice([3, 4, 5, 6, 7], rng.integers(1, 9))
        exact, bound = fewest(sorted(lengths.tolist(), reverse=True), 12), m.lower_bound(lengths, 12)
        which, offset, free = m.best_fit_decreasing(lengths, 12)
        assert bound <= exact <= len(free) == held(list(zip(which.tolist(), offset.tolist(), lengths.tolist(), strict=True)), 12)
        certified += bound == len(free)
    assert certified > 100


def test_bound_beyond_the_volume():
    assert m.lower_bound([1100] * 10) == 10  # two never fit
    assert m.lower_bound([700] * 10) == 5  # two fit, three don't
    assert m.lower_bound([]) == 0


def test_documents_change_places(spark):
    """Small partitions have gaps; the rounds bring the whole near what one
    partition of all would need."""
    rng = np.random.default_rng(2)
    lengths = [int(x) for x in np.concatenate([rng.integers(1, 2049, 600), rng.integers(600, 1100, 600)])]
    rows = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").repartition(4)
    out = m.pack(rows, partition_pieces=200)
    got = out.collect()
    assert sorted(r.doc_id for r in got) == list(range(1200))
    alone = sum(len(m.best_fit_decreasing(np.array([lengths[i] for i in range(k, 1200, 6)]))[2]) for k in range(6))
    whole = len(m.best_fit_decreasing(np.array(lengths))[2])
    count = held([(r.sequence_id, r.offset, r.length) for r in got])
    assert m.bound_of(out) <= count < alone and count <= 1.01 * whole + 1


def test_pieces_equal_the_library(spark, odd_docs, odd_rows, no_docs):
    theirs = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    rows = [*odd_rows, (None, "null id"), (20, "Tab\tand\x0bother\x85 blanks here now\x1cend 'S don't É é ΑΣ Σ"), (23, "word. Word, e\u0301t\u00e9. e\u0301. x;y -a- 'tis don't. it's; (a) [b] 1.5 a1. \u00aaz \u00d7 stra\u00dfe! \u0130stanbul. ab\u0301."), (21, "many words, one text. " * 3000), (22, "a" * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    pieces = m.encode_pieces(docs, with_ids=True)
    got = m.pack(pieces).collect()
    want = []
    for i, t in rows:
        ids = [*theirs.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            cut = ids[k : k + 2048]
            want.append((i, k // 2048, k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), cut))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    held([(r.sequence_id, r.offset, r.length) for r in got])
    assert m.pack_documents(odd_docs).count() == len(odd_rows) + sum(1 for x in want if x[1] and x[0] < 20)
    assert m.pack_documents(no_docs).collect() == []


def test_words_equal_whole_texts(monkeypatch):
    import random

    import pyarrow as pa

    path = public.path("word_bpe_49k.json")
    theirs = tokenizers.Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        encoder = m.WordEncoder(f.read())
    monkeypatch.setattr(m, "KNOWN_WORDS", 400)
    rng = random.Random(3)
    alphabet = " \n\t\r  aAbcEéÀßŒñÑtheingsmd''.,!?;-_()0129\u0301\u0338=<\u00a0\u2003\x0b\x1c日本😀ΣσĀİªº²×÷|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    for at in range(0, len(texts), 100):
        ids, begin = encoder.encode(pa.array(texts[at : at + 100]))
        for t, a, b in zip(texts[at:], begin, begin[1:]):
            assert ids[a:b].tolist() == theirs.encode(t, add_special_tokens=False).ids, t


def test_query(spark, sf_small):
    got = m.query(spark, sf_small)
    rows = got.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(os.path.join(sf_small, "documents.parquet")).select("doc_id").collect()}
    count = held([(r.sequence_id, r.offset, r.length) for r in rows])
    assert count <= 1.01 * m.bound_of(got) + 1
