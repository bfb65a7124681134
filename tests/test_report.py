"""Histograms against numpy, error and share summaries (FIXTURES §4 histogram)."""

import numpy as np

from relevo.operators.report import audit_sample, histogram


def _np_hist(values):
    counts, edges = np.histogram(np.asarray(values, dtype=float), bins=10)
    return {i: int(c) for i, c in enumerate(counts) if c}, edges


def _ours(spark, values, group="g"):
    df = spark.createDataFrame([(group, v) for v in values], "g string, v double")
    return {r.bin: r.n for r in histogram(df, "v", "g").collect()}, histogram(df, "v", "g")


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(7)
    for values in (rng.random(500).tolist(), (rng.normal(size=300) * 1e3).tolist(), [0.0, 0.1, 0.2, 0.30000000000000004, 1.0]):
        want, _ = _np_hist(values)
        got, _ = _ours(spark, values)
        assert got == want


def test_histogram_all_equal(spark):
    want, edges = _np_hist([0.7] * 5)
    got, df = _ours(spark, [0.7] * 5)
    assert got == want == {5: 5}
    row = df.first()
    assert abs(row.bin_lo - edges[5]) < 1e-12 and abs(row.bin_hi - edges[6]) < 1e-12


def test_histogram_max_in_last_bin_and_nulls(spark):
    got, _ = _ours(spark, [0.0, 0.5, 1.0, None])
    assert got == {0: 1, 5: 1, 9: 1}


def test_histogram_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert histogram(df, "v", "g").count() == 0


def test_audit_sample_per_class(spark):
    rows = [(f"c-{i}", "c", float(i % 2)) for i in range(50)]
    df = spark.createDataFrame(rows, "id string, collection_id string, label double")
    s = audit_sample(df, "label", k=3).collect()
    assert sorted((r.label, r.sample_rank) for r in s) == [(0.0, 1), (0.0, 2), (0.0, 3), (1.0, 1), (1.0, 2), (1.0, 3)]
    again = audit_sample(df.repartition(5), "label", k=3).collect()
    assert sorted(r.id for r in s) == sorted(r.id for r in again)
