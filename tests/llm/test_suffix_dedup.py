import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from brute import cut_repeats as plain

from relevo.llm import suffix_dedup as m


def _digest(r):
    return (r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())


def test_odd_rows(odd_docs, odd_rows, no_docs):
    got = sorted((_digest(r.asDict()) for r in m.cut_repeats(odd_docs).collect()), key=repr)
    assert got == plain(odd_rows)
    assert m.cut_repeats(no_docs).count() == 0


def test_null_id_is_the_least(spark):
    rows = [(None, "q" * 60), (1, "q" * 70), (1, "q" * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((_digest(r.asDict()) for r in m.cut_repeats(docs).collect()), key=repr) == plain(rows)


def test_query_on_given_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in m.query(spark, sf_small).collect()), key=repr) == plain(rows)


def _tasks(rows, shards, buckets):
    """All steps in this process, with many shards and buckets."""
    parts = collections.defaultdict(list)
    for k, r in enumerate(rows):
        parts[k % shards].append(r)
    tables = {s: pa.table({"shard": pa.array([s] * len(v), pa.int64()), "doc_id": pa.array([x[0] for x in v], pa.int64()), "text": pa.array([x[1] for x in v], pa.string())}) for s, v in parts.items()}

    def grouped(ts, key):
        t = pa.concat_tables(ts)
        return {k: t.filter(pc.equal(t[key], k)) for k in set(t[key].to_pylist())}

    first = grouped([m._answer_tags(t) for t in grouped([m._send_tags(buckets)(t) for t in tables.values()], "bucket").values()], "shard")
    none = m._table(m._REPLY, shard=[], bucket=[], kind=[], bits=[], more=[])
    sent = [m._send_stretches(buckets)(t, first.get(s, none)) for s, t in tables.items()]
    second = grouped([m._answer_stretches(t) for t in grouped(sent, "bucket").values()], "shard")
    out = []
    for s, t in tables.items():
        out += map(_digest, m._cut_shards(buckets)(t, pa.concat_tables([first.get(s, none), second.get(s, none)])).to_pylist())
    return sorted(out, key=repr)


@pytest.mark.parametrize(("everywhere", "run", "piece", "at_once"), [(256, 64, 1 << 19, 1 << 18), (0, 64, 1 << 19, 1 << 18), (1, 5, 700, 300)])
def test_many_shards_and_small_limits(monkeypatch, everywhere, run, piece, at_once):
    for name, value in (("EVERYWHERE", everywhere), ("RUN", run), ("PIECE", piece), ("SORTED", at_once)):
        monkeypatch.setattr(m, name, value)
    rng = random.Random(5)
    base = "".join(rng.choice("abc ") for _ in range(400))
    part = lambda n: base[rng.randrange(300) :][: rng.randrange(n)]
    rows = [(i // 2 if i % 7 == 0 else i, part(200) + rng.choice(["", "é" * 30, "a" * rng.randrange(300)]) + part(120)) for i in range(120)]
    assert _tasks(rows, 4, 3) == plain(rows)


def test_sorted_windows_and_collisions(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1200] = data[:200]
    start, group = np.arange(0, 2900, 3), np.arange(0, 2900, 3) % 5
    order = m.sort_windows(data, m.Hashes(data), start, group)
    keys = [(int(group[k]), data[start[k] : start[k] + m.LENGTH].tobytes()) for k in order]
    assert keys == sorted(keys)
    # hashes that call everything equal: the bytes decide
    monkeypatch.setattr(m.Hashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    data = np.frombuffer(b"a" * 55 + b"a" * 50 + b"b" * 6 + b"b" * 56, np.uint8)
    start, size, doc = np.array([0, 55, 111]), np.array([55, 56, 56]), np.array([3, 1, 2])
    least = m.least_documents(data, m.Hashes(data), start, size, doc, np.array([7, 7, 7]))
    assert least.tolist() == [1] * 6 + [1] * 7 + [2] * 7
    s = m.Stretches(data, m.Hashes(data), np.array([0, 1, 111, 112]), np.array([50, 50, 50, 50]), np.array([5, 4, 3, 2]), np.zeros(4, np.uint64))
    assert s.windows.sum() >= 2 and (s.least[s.unique] <= s.doc).all() and s.unique[0] != s.unique[2]


def test_windows_without_an_equal_are_not_sorted(monkeypatch):
    """Of a tag's different stretches only the windows that stand in several
    are sorted, however many share the tag by chance."""
    rng = np.random.default_rng(3)
    stretches = [rng.integers(97, 123, 65).astype(np.uint8) for _ in range(200)]
    stretches[150][5:60] = stretches[20][10:65]
    data = np.concatenate(stretches)
    start, size = np.arange(200) * 65, np.full(200, 65)
    sorted_, plain_sort = [], m.sort_windows
    monkeypatch.setattr(m, "sort_windows", lambda d, h, s, g: sorted_.append(len(s)) or plain_sort(d, h, s, g))
    least = m.least_documents(data, m.Hashes(data), start, size, np.arange(200)[::-1].copy(), np.full(200, 9)).reshape(200, 16)
    want = np.repeat(np.arange(200)[::-1], 16).reshape(200, 16)
    want[20, 10:16] = want[150, 5]
    assert (least == want).all() and sum(sorted_) == 12
