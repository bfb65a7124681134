import itertools
import random

import numpy as np
from brute import near_classes

from relevo.llm import near_duplicates as m
from relevo.llm.components import components


def _sets(text):
    return set(m.shingle_set(text).tolist())


def _variants(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(1000)}"
        rows.append((i + 100, " ".join(text)))
    return rows


def test_odd_rows_and_large_group(spark, odd_rows, monkeypatch):
    rows = odd_rows + _variants(40) + [(None, "a b c d e f g"), (200, "a b c d e f g"), (300, None), (301, "!!")]
    docs = spark.createDataFrame([(i, t, 5, "z") for i, t in rows], "doc_id long, text string, node int, links string").repartition(3)
    want = near_classes(rows, _sets)
    for block in (256, 7):  # one block, and many pairs of blocks
        monkeypatch.setattr(m, "BLOCK", block)
        got = sorted(((r.doc_id, r.class_id, r.n_links) for r in m.classes(docs).collect()), key=repr)
        assert got == want


def test_one_of_each_class_stays(spark, odd_docs, odd_rows, no_docs):
    kept = m.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(((i, t) for i, t in odd_rows if i not in (5, 6, 12)), key=lambda r: r[0])
    assert m.keep_one_of_each(no_docs).count() == 0
    assert m.classes(no_docs).count() == 0


def test_query_finds_every_link(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in m.query(spark, sf_small).collect()), key=repr)
    assert got == near_classes(rows, _sets)


def test_pruning_and_both_ways_of_counting():
    rows = _variants(30, seed=4)
    sets = [m.shingle_set(t) for _, t in rows]
    sigs = np.stack([m.min_hashes(s) for s in sets])
    i, j = m.surviving_pairs(sigs, sigs, True)
    far = np.stack([m.min_hashes(m.shingle_set(f"other text number {k} " + " ".join(map(str, range(k, k + 50))))) for k in range(0, 600, 60)])
    assert not len(m.surviving_pairs(sigs, far, False)[0])
    dense = set(zip(*(x.tolist() for x in m.exact_links(sets, i, j)), strict=True))
    single = {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if len(m.exact_links(sets, np.array([a]), np.array([b]))[0])}
    full = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if len(np.intersect1d(sets[a], sets[b])) * 5 >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert dense == single == full
    assert m.least_matches(150) > m.least_matches(15) >= 1


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(7, 7), (200, 201), (201, 200)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 120), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_without_words_stay_and_null_ids_have_one_keeper(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "!!!"), (None, "???"), (None, None), (3, "..."), (3, "--"), (None, base), (None, base + " more"), (None, base)]
    rows += [(4, base.replace("w", "v")), (4, base.replace("w", "v") + " more")]
    kept = [r.text for r in m.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert len(kept) == 7 and {"!!!", "???", None, "...", "--"} <= set(kept)
    assert sum(bool(t) and t.startswith("w0") for t in kept) == sum(bool(t) and t.startswith("v0") for t in kept) == 1
