"""Weak labels, fractions and the hash sample (FIXTURES §4 labels)."""

from pyspark.sql import functions as F

from relevo.operators.labeling import hash_unit, label_flags, positive_stats, training_set
from relevo.operators.preprocess import prepare_texts


def _prepared(spark, rows, pattern):
    df = spark.createDataFrame(rows, "id string, collection_id string, text string")
    pat = F.array(*[F.lit(w) for w in pattern]).cast("array<string>")
    return prepare_texts(df).withColumn("pattern", pat)


ROWS = [
    ("c-1", "c", "happy independenceday everyone"),
    ("c-2", "c", "happy birthday friend"),
    ("c-3", "c", "nothing here matches"),
    ("c-4", "c", "independenceday fireworks happy"),
]


def test_flags_and_fraction(spark):
    stats = positive_stats(label_flags(_prepared(spark, ROWS, ["happy", "independenceday"]))).first()
    assert (stats.n_texts, stats.n_positive, stats.n_candidates) == (4, 2, 2)
    assert stats.positive_fraction == 0.5


def test_stop_word_in_pattern_gives_neither_class(spark):
    flags = label_flags(_prepared(spark, [("c-1", "c", "the happy day")], ["the", "happy"])).first()
    assert flags.is_positive is False and flags.is_candidate is False


def test_empty_pattern_all_positive(spark):
    t = training_set(_prepared(spark, ROWS, []))
    assert sorted(r.label for r in t.collect()) == [1.0] * 4


def test_no_match_fraction_zero(spark):
    s = positive_stats(label_flags(_prepared(spark, ROWS, ["zebra"]))).first()
    assert s.n_positive == 0 and s.positive_fraction == 0.0
    assert training_set(_prepared(spark, ROWS, ["zebra"])).count() == 0


def test_empty_collection(spark):
    empty = _prepared(spark, [], ["happy"])
    assert positive_stats(label_flags(empty)).count() == 0
    assert training_set(empty).count() == 0


def test_hash_sample_independent_of_partitioning(spark):
    rows = [(f"c-{i}", "c", "word other thing" if i % 3 else "happy independenceday yes") for i in range(400)]
    p = _prepared(spark, rows, ["happy", "independenceday"])
    a = sorted(r.id for r in training_set(p.repartition(7)).collect())
    b = sorted(r.id for r in training_set(p.coalesce(1)).collect())
    assert a == b
    n_pos = sum(1 for i in range(400) if i % 3 == 0)
    n_neg = len(a) - n_pos
    expected = (400 - n_pos) * n_pos / 400
    assert abs(n_neg - expected) < 4 * expected**0.5


def test_balanced_sample_is_close_to_positives(spark):
    rows = [(f"c-{i}", "c", "word other thing" if i % 5 else "happy independenceday yes") for i in range(1000)]
    t = training_set(_prepared(spark, rows, ["happy", "independenceday"]), balanced=True)
    counts = {r.label: r["count"] for r in t.groupBy("label").count().collect()}
    assert abs(counts[0.0] - counts[1.0]) < 4 * counts[1.0] ** 0.5


def test_hash_unit_matches_python_md5(spark):
    import hashlib

    df = spark.createDataFrame([("712-1",), ("x",)], "id string")
    got = [r[0] for r in df.select(hash_unit("id")).collect()]
    want = [int(hashlib.md5(f"12345:{i}".encode()).hexdigest()[:8], 16) for i in ("712-1", "x")]
    assert got == want
