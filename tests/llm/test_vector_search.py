import math

from relevo.llm import vector_search
from relevo.llm.vector_search import Best, top_k


def _plain(rows, queries, k):
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    ints = lambda v: [math.floor(64 * x) for x in v]
    out = []
    for q, v in queries:
        if good(v) and q is not None:
            a = ints(v)
            best = sorted((-sum(x * y for x, y in zip(a, ints(w))), i) for i, w in rows if good(w) and i is not None and i != q)[:k]  # noqa: B905
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_ties_nulls_and_odd_vectors(spark):
    rows = [(i, [float((i * 7 + d * 3) % 5) - 2.0 for d in range(20)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None] + [0.0] * 18), (62, [math.nan] * 20), (63, [math.inf] + [0.0] * 19), (64, []), (65, [1.0, 2.0]), (None, [1.0] * 20), (66, [3e7] * 20), (67, [1e300] * 2)]
    rows += [(10, [9.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    queries = [r for r in rows if r[0] is not None and r[0] % 4 == 0]
    got = sorted(tuple(r) for r in top_k(df, df.filter("vec_id % 4 = 0"), 7).collect())
    big = (1 << 63) - 1
    want = sorted((q, r, i, max(-big - 1, min(big, s))) for q, r, i, s in _plain(rows, queries, 7))
    assert got == want


def test_blocks_and_pruning_keep_the_result():
    import numpy as np

    rng = np.random.default_rng(3)
    c, q = np.floor(rng.normal(size=(40, 500)) * 20), np.floor(rng.normal(size=(40, 30)) * 20)
    best = Best(np.arange(1000, 1030), q, 5)
    for i in range(0, 500, 50):
        best.search(np.arange(i, i + 50), c[:, i : i + 50], step=4)
    full = q.T @ c
    for k in range(30):
        want = sorted((-s, i) for i, s in enumerate(full[k]))[:5]
        assert list(zip(-best.scores[k], best.found[k], strict=True)) == want


def test_few_candidates_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 1, 64 * 128)]
    assert top_k(df.limit(0), df.limit(0)).count() == 0
    assert vector_search.K == 20


def test_rows_of_the_querys_own_id_take_no_place():
    import numpy as np

    c = np.arange(200.0, 0, -1).reshape(1, 200)
    ids = np.concatenate([np.full(8, 7), np.arange(1000, 1192)])
    best = Best(np.array([7]), np.ones((1, 1)), 5)
    best.search(ids, c)
    assert best.found[0].tolist() == [1000, 1001, 1002, 1003, 1004] and best.scores[0].tolist() == [192, 191, 190, 189, 188]
