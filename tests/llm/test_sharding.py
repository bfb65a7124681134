import zlib

from relevo.llm.sharding import shard_documents


def _check(rows, out, shards):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == sorted((i, size(t), None if t is None else zlib.crc32(t.encode())) for i, t in rows) if all(t is not None for _, t in rows) else len(out) == len(rows)
    sums = [0] * shards
    for s in range(shards):
        own = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        sums[s] = sum(r.size for r in own)
    largest = max((size(t) for _, t in rows), default=0)
    assert max(sums) - min(sums) <= 2 * largest
    assert {r.law for r in out} <= {"bytes"}


def test_odd_rows(odd_docs, odd_rows):
    out = shard_documents(odd_docs, 3).collect()
    _check(odd_rows, out, 3)
    assert {r.doc_id: r.text_crc32 for r in out}[3] is None


def test_hot_text_is_split_and_overfull_ranges_subdivide(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i} " + "z" * (i % 50)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _check(rows, shard_documents(docs, 8, rows_per_range=20).collect(), 8)


def test_same_rows_and_empty_table(spark, no_docs):
    docs = spark.createDataFrame([(1, "a")] * 40, "doc_id long, text string")
    _check([(1, "a")] * 40, shard_documents(docs, 8).collect(), 8)
    assert shard_documents(no_docs).count() == 0
