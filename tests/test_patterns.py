"""Frequent item sets against brute-force enumeration (FIXTURES §4 item sets)."""

import math
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from relevo.operators.patterns import frequent_itemsets, shortlist, sorted_itemsets
from relevo.operators.preprocess import transactions
from relevo.sources.sinks import pattern_lines

TX = [
    ["a", "b", "c"],
    ["a", "b"],
    ["a", "c", "c"],
    ["b", "c", "d"],
    ["a", "b", "c", "d"],
    [""],
    ["e"],
]


def brute(rows, min_support):
    n = len(rows)
    m = math.ceil(min_support * n)
    cnt = Counter()
    for r in rows:
        items = sorted(set(x for x in r if x))
        for k in range(1, len(items) + 1):
            for s in combinations(items, k):
                cnt[s] += 1
    return {s: c for s, c in cnt.items() if c >= m}


def _tx(spark, rows, cid="c"):
    df = spark.createDataFrame(
        [(f"{cid}-{i}", cid, "", r) for i, r in enumerate(rows)],
        "id string, collection_id string, text string, filtered array<string>",
    )
    return transactions(df)


def test_itemsets_equal_brute_force(spark):
    for support in (0.2, 0.3, 3 / 7, 0.5):
        got = {tuple(r["items"]): r["freq"] for r in frequent_itemsets(_tx(spark, TX), support).collect()}
        assert got == brute(TX, support), support


def test_support_is_relative_to_each_collection(spark):
    big = [["x", "y"]] * 10 + [["z"]] * 10
    small = [["x"], ["q"]]
    tx = _tx(spark, big, "big").unionByName(_tx(spark, small, "small"))
    got = {(r.collection_id, tuple(r["items"])): r.freq for r in frequent_itemsets(tx, 0.5).collect()}
    assert got == {
        ("big", ("x",)): 10, ("big", ("y",)): 10, ("big", ("x", "y")): 10, ("big", ("z",)): 10,
        ("small", ("x",)): 1, ("small", ("q",)): 1,
    }


def test_sort_and_lines(spark):
    sets = frequent_itemsets(_tx(spark, TX), 0.3)
    ordered = [(r.freq, r["items"]) for r in sorted_itemsets(sets).collect()]
    assert ordered == sorted(ordered, key=lambda t: (t[0], t[1]), reverse=True)
    first = pattern_lines(sets).first().line
    assert first.split(" ")[0] == str(ordered[0][0])


def test_shortlist_top_k_and_plan(spark):
    tx = _tx(spark, TX, "c").unionByName(_tx(spark, TX, "d"))
    sets = frequent_itemsets(tx, 0.2)
    top = shortlist(sets, k=2)
    rows = top.collect()
    assert len(rows) == 4 and all(2 <= len(r["items"]) <= 4 for r in rows)
    assert {r.collection_id for r in rows} == {"c", "d"}
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert F is not None


def test_least_count(spark):
    tx = _tx(spark, [["a", "b"], ["a", "c"], ["d"]])
    got = {(tuple(r["items"])): r.freq for r in frequent_itemsets(tx, 0.1, min_count=2).collect()}
    assert got == {("a",): 2}
    assert frequent_itemsets(tx, 0.1, min_count=5).count() == 0
    assert frequent_itemsets(tx.limit(0), 0.1).count() == 0


def test_collections_of_like_size_are_mined_together(spark, monkeypatch):
    """Collections of many sizes need one run a band, and get their own sets."""
    import random

    import relevo.operators.patterns as P

    rng = random.Random(3)
    rows = {f"c:{k}-ü": [[rng.choice("abcdefg") for _ in range(rng.randint(0, 5))] for _ in range(n)] for k, n in enumerate([30, 31, 29, 30, 12, 12, 3, 1])}
    tx = None
    for cid, own in rows.items():
        one = _tx(spark, own, cid)
        tx = one if tx is None else tx.unionByName(one)
    fits = []
    real = P.FPGrowth.fit
    monkeypatch.setattr(P.FPGrowth, "fit", lambda self, df: fits.append(1) or real(self, df))
    got = {(r.collection_id, tuple(r["items"])): r.freq for r in frequent_itemsets(tx, 0.2, min_count=2).collect()}
    want = {}
    for cid, own in rows.items():
        n = sum(1 for _ in own)
        want |= {(cid, s): c for s, c in brute(own, 0.2).items() if c >= max(2, math.ceil(0.2 * n))}
    assert got == want and len(fits) <= 4
    lost = _tx(spark, [["a"], ["a"]], "x").withColumn("collection_id", F.lit(None).cast("string"))
    assert frequent_itemsets(lost, 0.5).collect() == []
