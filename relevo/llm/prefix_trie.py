"""Prefix trie of conversations, rolled up by centroid decomposition
(operator 12).

Turns are numbered by a range-partitioned sort with carried offsets.  A prefix
of turns is known by sums of hashes of (place, role, text), which add up block
by block, so neither a long conversation nor a long common prefix is one task's
work.  A node is the prefix's key; its row counts its members and is named by
their least id.  (conv_id, depth) is unique, as nodes of one depth share no
member.

The sums over subtrees come by centroid decomposition of the forest of parent
edges.  Every node weighs as many as it has members; the weight below a node is
then a plain sum over its members' lengths, which the node's own aggregate
gives.  The centroid of a component is its deepest node with half of the weight
or more below it; cut out there, no piece holds more than half.  The total of
what lies at and below the centroid belongs to it, and is added to every node
on the path from it to the component's top; the pieces are taken on likewise.
Components above ``PIECE`` in weight are cut by joins over the whole cluster,
the others by arrays in tasks that hold several whole ones.

The ids that end at a node are sorted over the cluster, packed to runs of text,
and fed to the hash run by run, so a node where a third of all conversations
end needs no more memory than others.

Defined results: turns without a conv_id belong to no conversation; a null turn
comes first; rows of the same turn come in the order of role and text, repeated
rows follow each other; null role or text is empty; an empty table has no
nodes, any other one root; columns but ``conv_id``, ``turn``, ``role`` and
``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relevo.llm.common import table
from relevo.llm.sharding import _crc_table
from relevo.session import materialize

NAME = "op12_prefix_trie"
#: Conversations of a group share the beginning of its first one.
GROUP, MOST_SHARED = 5, 9
#: Turns whose hashes are summed in one task, member rows of a component that
#: one task rolls up, and ids of one run of text.
BLOCK, PIECE, RUN_IDS = 4096, 131_072, 8192

_LANES = ("s1", "s2", "s3", "s4")


def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, no`` (from 1), ``a, b`` (hash of role and text) and
    ``n_bytes`` of every turn; written once."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    half = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("long")
    # rows of a partition are numbered in order; the upper bits are the partition
    placed = ordered.select("conv_id", F.monotonically_increasing_id().alias("at"), half(1).alias("a"), half(17).alias("b"), F.octet_length("text").cast("long").alias("n_bytes"))
    placed = materialize(placed.withColumn("part", F.shiftright("at", 33)), "turns")
    starts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("conv_id", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first") + 1).alias("shift"))
    numbered = placed.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("no"), "a", "b", "n_bytes")
    return materialize(numbered, "numbered")


def lengths_of(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.max("no").alias("length"))


def share_beginnings(turns: DataFrame, group: int = GROUP, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of the conversations rebuilt: the first h turns of the
    group's first conversation, then the own ones after the first h."""
    convs = lengths_of(turns).select("conv_id", F.col("length").alias("n"), (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    firsts = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("of_base"))
    shared = F.least("h", F.coalesce("of_base", F.lit(0)))
    convs = convs.join(firsts, "base", "left").select("conv_id", "base", "h", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = materialize(convs, "conversations")
    own = turns.join(convs.select("conv_id", "h", "shared"), "conv_id").filter("no > h").select("conv_id", (F.col("no") - F.col("h") + F.col("shared")).alias("no"), "a", "b", "n_bytes")
    heads = turns.filter(F.col("no") < most).withColumnRenamed("conv_id", "base")
    taken = convs.filter("shared > 0").join(heads, "base").filter("no <= shared").select("conv_id", "no", "a", "b", "n_bytes")
    return own.unionByName(taken), convs.select("conv_id", "length")


def _key(place: F.Column, sums) -> list[F.Column]:
    """128 bits that stand for a prefix."""
    return [F.xxhash64(F.lit(lane), place, *sums) for lane in (1, 2)]


def prefix_members(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for every conversation and each of its prefixes, the empty one
    included: ``conv_id, length, depth``, the prefix's key ``k1, k2``, that of
    the one before ``p1, p2``, and ``n_bytes`` of the last text."""
    lane = [F.xxhash64(F.lit(i), "no", "a", "b") for i in (1, 2)]
    parts = [p for x in lane for p in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF)))]
    rows = turns.select("conv_id", "no", "n_bytes", F.floor((F.col("no") - 1) / BLOCK).alias("block"), *[p.alias(f"h{i}") for i, p in enumerate(parts, 1)])
    inside = Window.partitionBy("conv_id", "block").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = lengths.filter(F.col("length") > BLOCK).select("conv_id")
    totals = rows.join(later, "conv_id", "left_semi").groupBy("conv_id", "block").agg(*[F.sum(f"h{i}").alias(f"h{i}") for i in range(1, 5)])
    totals = totals.select("conv_id", "block", *[F.sum(f"h{i}").over(before).alias(f"o{i}") for i in range(1, 5)])
    summed = rows.select("*", *[F.sum(f"h{i}").over(inside).alias(f"i{i}") for i in range(1, 5)]).join(totals, ["conv_id", "block"], "left").join(lengths, "conv_id")
    full = [F.col(f"i{i}") + F.coalesce(f"o{i}", F.lit(0)) for i in range(1, 5)]
    short = [s - F.col(f"h{i}") for i, s in enumerate(full, 1)]
    own, parent = _key(F.col("no"), full), _key(F.col("no") - 1, short)
    zero = [F.lit(0).cast("long")] * 4
    top = _key(F.lit(0).cast("long"), zero)
    none = F.lit(None).cast("long")
    below = summed.select("conv_id", "length", F.col("no").alias("depth"), own[0].alias("k1"), own[1].alias("k2"), parent[0].alias("p1"), parent[1].alias("p2"), "n_bytes")
    roots = lengths.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), top[0].alias("k1"), top[1].alias("k2"), none.alias("p1"), none.alias("p2"), F.lit(0).cast("long").alias("n_bytes"))
    return materialize(below.unionByName(roots), "members")


def trie_nodes(members: DataFrame) -> DataFrame:
    """``k1, k2, conv_id, depth, parent_conv_id, n_convs, n_children``, the
    weight ``below`` and the node's own ``leaves`` and ``saved``."""
    nodes = members.groupBy("k1", "k2", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("below"),
    )
    nodes = materialize(nodes, "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(children, ["k1", "k2"], "left").join(parents, ["p1", "p2"], "left")
    return out.select(
        "k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "below",
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )


def _tops(parent: np.ndarray) -> np.ndarray:
    """The top of every node's component, by doubling steps."""
    up = np.where(parent < 0, np.arange(len(parent)), parent)
    while True:
        further = up[up]
        if np.array_equal(further, up):
            return up
        up = further


def centroid_rollup(parent: np.ndarray, below: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` over every node's subtree.  ``parent``:
    the parent's number or -1; ``below``: the weight of a node's subtree, more
    than that of each child.  Many components are cut at the same time."""
    n, parent, below = len(parent), parent.copy(), below.copy()
    sums, left = np.zeros_like(values), np.ones(n, bool)
    child_of = parent.copy()  # edges of the forest, to free the children
    while left.any():
        top = _tops(parent)
        heavy = np.flatnonzero(left & (2 * below >= below[top]))
        heavy = heavy[np.lexsort((below[heavy], top[heavy]))]
        first = np.ones(len(heavy), bool)
        first[1:] = top[heavy[1:]] != top[heavy[:-1]]
        centre = heavy[first]  # the deepest, one a component
        at = parent[centre]
        parent[centre] = -1
        where = np.full(n, -1)
        where[centre] = np.arange(len(centre))
        piece = where[_tops(parent)]
        inside = np.flatnonzero(left & (piece >= 0))
        total = np.zeros((len(centre), values.shape[1]), values.dtype)
        np.add.at(total, piece[inside], values[inside])
        sums[centre] += total
        which = np.flatnonzero(at >= 0)
        at = at[which]
        while len(at):  # a step up each path; paths of components don't meet
            sums[at] += total[which]
            below[at] -= below[centre[which]]
            at = parent[at]
            which, at = which[at >= 0], at[at >= 0]
        left[centre] = False
        freed = left & (child_of >= 0)
        freed[freed] = where[child_of[freed]] >= 0
        parent[freed] = -1
    return sums


_FOREST = ["conv_id", "depth", "parent_conv_id", "below", "leaves", "saved", "top_conv", "top_depth"]
_SUMS = "conv_id long, depth long, leaves long, saved long"


def _roll_up(key, group):
    """Whole components, held as arrays."""
    import pyarrow as pa

    conv, depth, parent, below, leaves, saved, top_conv, top_depth = (group.column(c).fill_null(0).to_numpy().astype(np.int64) for c in _FOREST)
    ids = np.unique(conv)
    code = depth * len(ids) + np.searchsorted(ids, conv)
    order = np.argsort(code, kind="stable")
    is_top = (conv == top_conv) & (depth == top_depth)
    place = np.minimum(np.searchsorted(ids, parent), len(ids) - 1)
    at = np.searchsorted(code[order], (depth - 1) * len(ids) + place)
    up = np.where(is_top, -1, order[np.minimum(at, len(order) - 1)])
    sums = centroid_rollup(up, below, np.stack([leaves, saved], 1))
    return pa.table({"conv_id": conv, "depth": depth, "leaves": sums[:, 0].copy(), "saved": sums[:, 1].copy()})


def _steps(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``conv_id, depth, node, next``: the node a conversation passes at a
    depth, and the one after it."""
    passed = members.select("conv_id", "depth", "k1", "k2").join(nodes.select("k1", "k2", F.col("conv_id").alias("node")), ["k1", "k2"]).select("conv_id", "depth", "node")
    after = passed.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("node").alias("next"))
    return materialize(passed.join(after, ["conv_id", "depth"], "left"), "steps")


def subtree_sums(members: DataFrame, nodes: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv_id, depth`` and the sums of ``leaves`` and ``saved`` over every
    node's subtree."""
    root = nodes.filter("depth = 0").select("conv_id", "below").first()
    if root is None:
        return nodes.select("conv_id", "depth", "leaves", "saved")
    top = [F.lit(root[0]).cast("long").alias("top_conv"), F.lit(0).cast("long").alias("top_depth")]
    pool = nodes.select("conv_id", "depth", "parent_conv_id", "below", "leaves", "saved", *top, F.lit(root[1]).cast("long").alias("total"))
    largest, steps, ready, added = root[1], None, [], []
    component = ["top_conv", "top_depth"]
    while largest > piece:
        steps = steps if steps is not None else _steps(members, nodes)
        ready.append(pool.filter(F.col("total") <= piece))
        big = pool.filter(F.col("total") > piece)
        deepest = F.max(F.struct("depth", "conv_id", "below")).alias("c")
        centres = big.filter("2 * below >= total").groupBy(*component).agg(deepest).select(*component, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.below").alias("c_below"))
        centres = materialize(centres, "centres")
        # conversations that pass a centroid, and the piece below it that each goes on in
        through = centres.join(steps, (F.col("c_conv") == F.col("node")) & (F.col("c_depth") == F.col("depth"))).select("conv_id", *component, "c_depth", "next")
        marked = big.join(through, ["conv_id", *component], "left").withColumn("inside", F.coalesce(F.col("depth") >= F.col("c_depth"), F.lit(False)))
        marked = materialize(marked, "marked")
        inside = marked.filter("inside")
        totals = inside.groupBy(*component).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        totals = materialize(centres.join(totals, component), "totals")
        path = steps.select(F.col("conv_id").alias("c_conv"), F.col("depth").alias("at"), "node").join(totals, "c_conv").filter("at >= top_depth AND at < c_depth")
        path = materialize(path.select(F.col("node").alias("conv_id"), F.col("at").alias("depth"), "leaves", "saved", "c_below"), "paths")
        added += [path.drop("c_below"), totals.select(F.col("c_conv").alias("conv_id"), F.col("c_depth").alias("depth"), "leaves", "saved")]
        keep = ["conv_id", "depth", "parent_conv_id", "leaves", "saved"]
        upper = marked.filter("NOT inside").drop("c_depth", "next").join(centres.select(*component, F.col("c_below").alias("cut")), component).join(path.select("conv_id", "depth", "c_below"), ["conv_id", "depth"], "left")
        upper = upper.select(*keep, *component, (F.col("below") - F.coalesce("c_below", F.lit(0))).alias("below"), (F.col("total") - F.col("cut")).alias("total"))
        lower = inside.filter("depth > c_depth").select(*keep, "below", F.col("next").alias("top_conv"), (F.col("c_depth") + 1).alias("top_depth"))
        tops = lower.filter("conv_id = top_conv AND depth = top_depth").select(*component, F.col("below").alias("total"))
        pool = materialize(upper.unionByName(lower.join(tops, component)), "pool")
        largest = pool.agg(F.max("total")).first()[0] or 0
    ready.append(pool)
    buckets = -(-root[1] // piece)
    for part in ready:
        spread = part.select(*_FOREST).withColumn("bucket", F.pmod(F.xxhash64(*component), F.lit(buckets)))
        added.append(spread.groupBy("bucket").applyInArrow(_roll_up, _SUMS))
    out = added[0]
    for more in added[1:]:
        out = out.unionByName(more)
    return out.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _runs(batches):
    """Sorted (k1, k2, conv_id) rows as runs of text of one node each."""
    import pyarrow as pa

    for batch in batches:
        k1, k2, ids = (batch.column(i).to_numpy() for i in range(3))
        if not len(ids):
            continue
        cut = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
        bounds = np.unique(np.concatenate([[0], cut, np.arange(0, len(ids), RUN_IDS), [len(ids)]]))
        first = bounds[:-1]
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(first, bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(k1[first]), pa.array(k2[first]), pa.array(ids[first]), pa.array(texts)], names=["k1", "k2", "first", "ids"])


def _digests(batches):
    """Runs in order of (node, first id) as one hash a node."""
    import pyarrow as pa

    now, sha, out = None, None, []
    for batch in batches:
        for k1, k2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (k1, k2) == now:
                sha.update(b",")
            else:
                if sha is not None:
                    out.append((*now, sha.hexdigest()))
                now, sha = (k1, k2), hashlib.sha256()
            sha.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["k1", "k2", "ends_sha256"])
            out = []
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, sha.hexdigest())], names=["k1", "k2", "ends_sha256"])


def end_digests(members: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` of the nodes where conversations end."""
    order = ["k1", "k2", "conv_id"]
    ends = members.filter("depth = length").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = ends.mapInArrow(_runs, "k1 long, k2 long, first long, ids string")
    runs = runs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return runs.mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row for each node of the trie of numbered turns."""
    members = prefix_members(turns, lengths)
    nodes = materialize(trie_nodes(members), "trie")
    sums = subtree_sums(members, nodes, piece).select("conv_id", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    out = nodes.drop("below", "leaves", "saved").join(sums, ["conv_id", "depth"]).join(end_digests(members), ["k1", "k2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = number_turns(conversations)
    return prefix_trie(turns, lengths_of(turns), piece)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*share_beginnings(number_turns(table(spark, sf_dir, "conversations"))))


ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS v,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS no
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(v ORDER BY no) AS own, list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::UBIGINT) AS bytes FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, (xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
    lambda a, b: xor(a >> 8, ({_crc_table()}::UBIGINT[])[(xor(a, b) & 255)::INTEGER + 1])), 4294967295::UBIGINT) % {MOST_SHARED})::BIGINT AS h FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(b.own[1 : h.h], []), h.own[h.h + 1 :]) AS path FROM h LEFT JOIN h b ON b.conv_id = h.conv_id - h.conv_id % {GROUP}),
m AS (SELECT conv_id, d, path[1 : d] AS path, len(path) AS n FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM r)),
n AS (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE strlen(any_value(path[d].text)) END AS bytes,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n), '') AS ends FROM m GROUP BY d, path),
k AS (SELECT d - 1 AS d, path[1 : d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
s AS (SELECT e AS d, n.path[1 : e] AS path, sum(CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM n) n LEFT JOIN k ON k.d = n.d AND k.path = n.path GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.d = n.d AND s.path = n.path LEFT JOIN k ON k.d = n.d AND k.path = n.path LEFT JOIN n p ON p.d = n.d - 1 AND p.path = n.path[1 : n.d - 1]
"""
