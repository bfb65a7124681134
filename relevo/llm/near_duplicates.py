"""Near-duplicate join on n-gram Jaccard similarity with Bayesian candidate
pruning (operator 5).

Two documents are linked if the Jaccard similarity of their sets of five-word
shingles reaches the threshold (0.8).  Texts of the same set are one node of
the join, so copies are never expanded into pairs.

1. One pass makes each text's shingle hashes and ``HASHES`` MinHash values;
   bands of them are the candidate keys (a pair at the threshold shares none
   with a chance below 1e-5).
2. Every node is tied to the least node of each of its keys, and the ties'
   connected components bound where links can be.
3. Within a component the MinHash values are compared step by step.  A pair is
   dropped as soon as the posterior probability (uniform prior) that its
   similarity reaches the threshold falls below ``TOLERANCE``; all others get
   their exact Jaccard.  Components are dealt in blocks of about ``BLOCK``
   nodes, every pair of blocks a group of its own, so that a large component
   is spread over many tasks; what a group gives back, link counts and a
   spanning forest, is linear in its nodes.
4. The exact links' components are the classes.

Words are runs of letters, digits and underscores of the lower-cased text;
texts of fewer than five words, but not none, are one shingle.  Shingles are
compared by 64-bit hashes.

Defined results: null texts and texts without words have no links and are a
class each by their row's id; rows of one id are told apart by their texts;
null ids are carried; an empty table gives an empty result; other columns are
ignored (the stage passes them through).
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relevo.llm.common import map_columns, mix64, table
from relevo.llm.components import components
from relevo.session import materialize

NAME = "op5_ngram_jaccard_join"
ORACLE_SQL = None
SHINGLE = 5
#: The threshold as a fraction of integers: 4 / 5.
NUMERATOR, DENOMINATOR = 4, 5
BANDS, BAND = 30, 5
HASHES = BANDS * BAND
STEP = 15
TOLERANCE = 1e-5
BLOCK = 256
_WORD = re.compile(r"\w+")
_RNG = np.random.default_rng(20)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_C = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    import xxhash

    words = _WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    known: dict[str, int] = {}
    for w in set(words):
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter((known[w] for w in words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.full(n, min(len(h), SHINGLE), np.uint64)
    for k in range(min(SHINGLE, len(h))):
        out = mix64(out + h[k : k + n] * _C[k])
    return np.unique(out)


def min_hashes(shingles: np.ndarray, piece: int = 4096) -> np.ndarray:
    """The least value of each hash function over the set (upper 32 bits)."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), piece):
        np.minimum(least, (shingles[i : i + piece, None] * _A + _B).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sketch(texts: list):
    nodes, sizes, sigs, bands = [], [], [], []
    for t in texts:
        s = shingle_set(t)
        sizes.append(len(s))
        if not len(s):
            nodes.append(None), sigs.append(None), bands.append([])
            continue
        sig = min_hashes(s)
        nodes.append(set_key(s)), sigs.append(sig.tobytes())
        key = np.arange(BANDS, dtype=np.uint64)
        for column in sig.reshape(BANDS, BAND).T:
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + column)
        bands.append(key.view(np.int64).tolist())
    return nodes, sizes, sigs, bands


_SKETCH = [
    T.StructField("node", T.BinaryType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("sig", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
]


def least_matches(total: int, tolerance: float = TOLERANCE, threshold: float = NUMERATOR / DENOMINATOR) -> int:
    """Fewest equal values among ``total`` that keep a pair: with fewer the
    posterior chance of a similarity of the threshold is below tolerance."""
    chance = 0.0
    for m in range(total + 1):
        chance += math.comb(total + 1, m) * threshold**m * (1 - threshold) ** (total + 1 - m)
        if chance >= tolerance:
            return m
    return total


_LEAST = [(e, least_matches(e)) for e in range(STEP, HASHES + 1, STEP)]


def surviving_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that the comparison of MinHash values leaves."""
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij"))
    if same:
        i, j = i[i < j], j[i < j]
    equal, start = np.zeros(len(i), np.int32), 0
    for end, least in _LEAST:
        for h in range(start, end):
            equal += left[i, h] == right[j, h]
        stay = equal >= least
        if not stay.all():
            i, j, equal = i[stay], j[stay], equal[stay]
        start = end
    return i, j


def exact_links(sets: list, i: np.ndarray, j: np.ndarray, piece: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose exact Jaccard similarity reaches the threshold."""
    if not len(i):
        return i, j
    used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = back[: len(i)], back[len(i) :]
    sizes = np.array([len(sets[k]) for k in used])
    if len(i) < 8 * len(used):
        common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j, strict=True)])
    else:
        # many pairs of few sets: common shingles by products of membership columns
        owner = np.repeat(np.arange(len(used)), sizes)
        _, column, times = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        keep = times[column] > 1
        owner, column = owner[keep], shared[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        product = np.zeros((len(used), len(used)))
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, piece):
            lo, hi = np.searchsorted(column, [start, start + piece])
            member = np.zeros((len(used), piece), np.float32)
            member[owner[lo:hi], column[lo:hi] - start] = 1
            product += member @ member.T
        common = product[a, b].astype(np.int64)
    linked = common * DENOMINATOR >= NUMERATOR * (sizes[a] + sizes[b] - common)
    return i[linked], j[linked]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(x), find(y)
        if a != b:
            root[b] = a
            out.append((x, y))
    return out


def _verified(batches):
    """Rows ``u, v`` (a link of the forest) and ``u, links`` from groups of
    members that stand together (the partition is sorted by group)."""
    import pyarrow as pa

    def judged(rows):
        sigs = np.stack([np.frombuffer(r["sig"], np.uint32) for r in rows])
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        left = [k for k, r in enumerate(rows) if r["block"] == r["lo"]]
        if rows[0]["lo"] == rows[0]["hi"]:
            i, j = surviving_pairs(sigs, sigs, True)
        else:
            right = [k for k, r in enumerate(rows) if r["block"] == r["hi"]]
            i, j = surviving_pairs(sigs[left], sigs[right], False)
            i, j = np.array(left, np.int64)[i], np.array(right, np.int64)[j]
        i, j = exact_links(sets, i, j)
        copies = np.array([r["copies"] for r in rows])
        links = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
        out = [(rows[a]["node"], rows[b]["node"], 0) for a, b in _forest(i, j, len(rows))]
        return out + [(r["node"], None, int(n)) for r, n in zip(rows, links.tolist(), strict=True) if n]

    def batch(found):
        return pa.RecordBatch.from_pydict({"u": pa.array([x[0] for x in found], pa.binary()), "v": pa.array([x[1] for x in found], pa.binary()), "links": pa.array([x[2] for x in found], pa.int64())})

    now, rows = None, []
    for b in batches:
        for r in b.to_pylist():
            group = (r["root"], r["lo"], r["hi"])
            if group != now and rows:
                yield batch(judged(rows))
                rows = []
            now = group
            rows.append(r)
    if rows:
        yield batch(judged(rows))


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, node, class_id, n_links, keeper`` for every row: the least id of
    its class, the number of other documents that it is linked to, and the node
    that stands for its class (the least by id, then node)."""
    texts = docs.select("doc_id", "text")
    sketches = materialize(map_columns(texts, ["text"], _SKETCH, _sketch).select("doc_id", "node", "n", "sig", "bands"), "near-sketches")
    # one row for each set, the least id's
    nodes = sketches.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "sig", "bands")).alias("x"), F.count(F.lit(1)).alias("copies"))
    nodes = materialize(nodes.select("node", "x.doc_id", "x.sig", "x.bands", "copies"), "near-nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    ties = keys.join(shared, "key").filter("node <> least").select(F.col("node").alias("u"), F.col("least").alias("v"))
    parts = materialize(components(ties), "near-parts")
    sizes = parts.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = parts.join(sizes, "root").join(nodes.select("node", "doc_id", "sig", "copies"), "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    own = texts.withColumnRenamed("doc_id", "id")
    # the members' shingles from their documents; rows of one id are told apart by the set's key
    found = own.join(members, own["id"].eqNullSafe(members["doc_id"])).drop("id", "doc_id")
    with_sets = map_columns(found, ["text"], [T.StructField("shingles", T.BinaryType()), T.StructField("key", T.BinaryType())], _set_and_key)
    with_sets = with_sets.filter("key = node").drop("text", "key").dropDuplicates(["node"])
    dealt = with_sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "block", "sig", "copies", "shingles")
    dealt = dealt.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "node")
    judged = materialize(dealt.mapInArrow(_verified, "u binary, v binary, links long"), "near-links")
    links = judged.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(judged.filter("v is not null").select("u", "v"))
    of_node = nodes.select("node", "doc_id", "copies").join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of_node.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "node")).alias("x")).select("root", F.col("x.doc_id").alias("class_id"), F.col("x.node").alias("keeper"))
    judged_nodes = of_node.join(least, "root").select("node", "class_id", "keeper", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return sketches.select("doc_id", "node").join(judged_nodes, "node", "left").select("doc_id", "node", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "keeper")


def _set_and_key(texts: list):
    sets = [shingle_set(t) for t in texts]
    return [s.tobytes() for s in sets], [set_key(s) for s in sets]


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that have a class mate of a smaller id (null
    ids are the greatest), or of the same id and a smaller node; of rows that
    are alike in id and shingles, one stays.  Rows without words all stay."""
    judged = materialize(classes(docs), "near-classes")
    gone = judged.filter("node is not null and not (doc_id <=> class_id and node = keeper)").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    if judged.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
    keyed = map_columns(docs, ["text"], [T.StructField("_key", T.BinaryType())], lambda texts: [_set_and_key(texts)[1]])
    kept = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["_id"]) & (keyed["_key"] == gone["_node"]), "left_anti")
    # rows without words share the empty set's key, but aren't alike
    bare = F.col("_key") == F.lit(bytearray(set_key(shingle_set(""))))
    kept = kept.withColumn("_own", F.when(bare, F.monotonically_increasing_id()).otherwise(-1))
    return kept.dropDuplicates(["doc_id", "_key", "_own"]).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
