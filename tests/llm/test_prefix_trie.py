import hashlib
import os
import zlib

import numpy as np
import pytest

from relevo.llm import prefix_trie as m

TURN = "conv_id long, turn long, role string, text string, node int, depth string, k1 long, row int"


def plain(rows, group=None, most=9):
    """Nodes of (conv_id, turn, role, text) rows, by dictionaries."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    paths = own
    if group:
        paths = {}
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % most
            paths[c] = own.get(c - int(np.fmod(c, group)), [])[:h] + v[h:]
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(tuple(p[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(1 for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below))
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(p))
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), parent, len(members), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def turns():
    """A common first turn, long chains, copies, ties, nulls, repeated rows."""
    rng = np.random.default_rng(4)
    out = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "system", "b"), (None, 0, "user", "lost"), (2, 5, "user", ""), (-7, 1, "user", "ü日"), (-5, 1, None, "x" * 3000)]
    for c in range(10, 40):
        path = ["hello"] * int(rng.integers(0, 9)) + [str(x) for x in rng.integers(0, 3, rng.integers(1, 6))]
        out += [(c, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(path)]
    out += [(c, i, "user", f"t{i}") for c in (50, 51, 52) for i in range(40 + c % 3)]
    return out


def frame(spark, turns):
    return spark.createDataFrame([(*t, 1, "a", 2, 3) for t in turns], TURN).repartition(5)


@pytest.mark.parametrize("piece", [m.PIECE, 200, 12])
def test_against_dictionaries(spark, turns, piece):
    assert rows_of(m.conversation_trie(frame(spark, turns), piece)) == plain(turns)


def test_shared_beginnings(spark, turns):
    got = m.prefix_trie(*m.share_beginnings(m.number_turns(frame(spark, turns))))
    assert rows_of(got) == plain(turns, 5)


def test_long_conversations_are_cut_to_blocks(spark, turns, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 4)
    monkeypatch.setattr(m, "RUN_IDS", 2)
    assert rows_of(m.conversation_trie(frame(spark, turns))) == plain(turns)


def test_many_conversations_end_at_a_node(spark):
    rows = [(c, 0, "user", "same") for c in range(20_000)]
    got = m.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()
    assert {r.depth: (r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in got} == {0: (20_000, 1, 1, 79_996), 1: (20_000, 0, 1, 79_996)}
    assert {r.depth: r.ends_sha256 for r in got}[1] == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()


def test_empty_table(spark):
    assert m.conversation_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_centroids_of_forests():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 60, 400):
        for shape in ("random", "chain", "star"):
            up = np.array([-1 if i == 0 or rng.random() < 0.05 else i - 1 if shape == "chain" else 0 if shape == "star" else rng.integers(0, i) for i in range(n)])
            own = rng.integers(1, 5, n)
            values = rng.integers(0, 9, (n, 2))
            below, want = own.copy(), values.copy()
            for i in range(n - 1, 0, -1):
                if up[i] >= 0:
                    below[up[i]] += below[i]
                    want[up[i]] += want[i]
            assert np.array_equal(m.centroid_rollup(up, below, values), want)


def test_query(spark, sf_small):
    got = rows_of(m.query(spark, sf_small))
    rows = spark.read.parquet(os.path.join(sf_small, "conversations.parquet")).select("conv_id", "turn", "role", "text").collect()
    assert got == plain([tuple(r) for r in rows], 5)
