"""Exact top-k inner-product search by columnar branch and bound (operator 3).

Vectors become integers floor(64 * x).  Candidates are packed in blocks in
vertical layout (one row of the block for each dimension), queries in blocks
beside them; Spark joins every query block with every candidate block on the
query block's number and brings all pairs of a query block, a slice of the
candidate blocks each, to the same task.  There the score of a tile grows
dimension block by dimension block; after each, a candidate whose partial
score plus the largest product that the remaining dimensions allow
(Cauchy-Schwarz over the remaining mass) is below the query's k-th best score
so far is dropped, and the surviving candidates are compacted.  The k best of
each slice are merged by a window over the query.

Scores are sums of integers.  Tiles whose scores are below 2**53 are computed
in doubles, which is exact; larger ones in Python's integers, and a score
beyond 64 bits is returned as the nearest one, ordered by its true value.

Defined results: vectors that are null, or hold null or non-finite
components, take no part; shorter vectors count as padded with zeros (an empty
one scores 0 with all); null ids take no part; every row of a repeated id is a
candidate or a query of its own, but never of a query with its id; fewer than
k candidates give fewer rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relevo.llm.common import table
from relevo.session import materialize

NAME = "op3_topk_search"
K, SCALE, EVERY = 20, 64, 20
#: Vectors of a candidate block and of a query block, dimensions of a step.
CANDIDATES, QUERIES, STEP = 2048, 2048, 16
#: Candidate blocks that one task takes for a query block.
SLICE = 64
_EXACT = float(1 << 53)


def _packed(size: int):
    """Rows (ids, dims, data): up to ``size`` vectors, dimension by dimension,
    as doubles of whole numbers."""

    def run(it):
        for pdf in it:
            for i in range(0, len(pdf), size):
                vecs = pdf["vec"].iloc[i : i + size].tolist()
                dims = max(len(v) for v in vecs)
                m = np.zeros((dims, len(vecs)))
                for j, v in enumerate(vecs):
                    m[: len(v), j] = np.floor(np.asarray(v, np.float64) * SCALE)
                yield pd.DataFrame({"ids": [pdf["vec_id"].iloc[i : i + size].to_numpy(np.int64).tobytes()], "dims": [dims], "data": [m.tobytes()]})

    return run


def _blocks(vectors: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Packed blocks with consecutive numbers, and how many there are."""
    packed = vectors.mapInPandas(_packed(size), "ids binary, dims int, data binary")
    stored = materialize(packed.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    # number the blocks: the parts' sizes are one row each, the blocks are not moved
    sizes = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    ahead = sizes.withColumn("ahead", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = stored.join(F.broadcast(ahead), "part").select((F.col("ahead") + F.col("at") - F.col("first")).alias("block"), "ids", "dims", "data")
    return out, stored.count()


def _unpack(ids: bytes, dims: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(data, np.float64).reshape(dims, len(ids))


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, k: int):
        self.ids, self.m, self.k = ids, m, k
        self.scores: list = [np.zeros(0)] * len(ids)
        self.found: list = [np.zeros(0, np.int64)] * len(ids)
        self.floor = np.full(len(ids), -np.inf)
        self.mass = _remaining(m)

    def add(self, q: int, scores, ids) -> None:
        keep = ids != self.ids[q]
        scores, ids = np.concatenate([self.scores[q], scores[keep]]), np.concatenate([self.found[q], ids[keep]])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.found[q] = scores[best], ids[best]
        if len(best) == self.k:
            self.floor[q] = scores[best[-1]]

    def search(self, ids: np.ndarray, c: np.ndarray, step: int = STEP) -> None:
        """Take in one block of candidates."""
        dims = min(len(self.m), len(c))
        q, c = self.m[:dims], c[:dims]
        if not _exact(q, c):
            for i in range(len(self.ids)):
                column = [int(x) for x in q[:, i]]
                self.add(i, np.array([sum(a * int(b) for a, b in zip(column, v, strict=True)) for v in c.T], object), ids)
            return
        near = _remaining(c)
        # alive pairs as (query, candidate) tiles: candidates no query needs go
        partial, alive = np.zeros((len(self.ids), len(ids))), np.arange(len(ids))
        for start in range(0, dims, step):
            end = min(start + step, dims)
            partial += q[start:end].T @ c[start:end, alive]
            if end == dims:
                break
            bound = partial + np.outer(self.mass[end], near[end, alive]) * (1 + 1e-9) + 1e-6
            stay = (bound >= self.floor[:, None]).any(axis=0)
            if not stay.all():
                alive, partial = alive[stay], partial[:, stay]
        left = ids[alive]
        for i in range(len(self.ids)):
            # rows of the query's own id go before the cut, however many there are
            over = np.flatnonzero((partial[i] >= self.floor[i]) & (left != self.ids[i]))
            if len(over) > 4 * self.k:
                cut = np.partition(partial[i, over], -self.k)[-self.k]
                over = over[partial[i, over] >= cut]
            if len(over):
                self.add(i, partial[i, over], left[over])


def _remaining(m: np.ndarray) -> np.ndarray:
    """Norms of each vector's part from a dimension on."""
    out = np.zeros((len(m) + 1, m.shape[1]))
    out[:-1] = np.sqrt(np.cumsum((m**2)[::-1], axis=0)[::-1])
    return out


def _exact(q: np.ndarray, c: np.ndarray) -> bool:
    """Whether all scores (and sums on the way) are exact in doubles."""
    return not q.size or not c.size or float(np.abs(q).max()) * float(np.abs(c).max()) * len(q) < _EXACT


def _long(x) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(x)))


def _searched(k: int):
    def run(it):
        import pyarrow as pa

        now, best = None, None

        def results():
            rows = [(now[0] * QUERIES + q, int(best.ids[q]), int(v), _long(s)) for q in range(len(best.ids)) for s, v in zip(best.scores[q], best.found[q], strict=True)]
            cols = list(zip(*rows, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(("row", "query_id", "vec_id", "score"), cols, strict=True)})

        for batch in it:
            for r in batch.to_pylist():
                if (r["q"], r["slice"]) != now:
                    if best is not None:
                        yield results()
                    now, best = (r["q"], r["slice"]), Best(*_unpack(r["q_ids"], r["q_dims"], r["q_data"]), k)
                best.search(*_unpack(r["ids"], r["dims"], r["data"]))
        if best is not None:
            yield results()

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest scores.  Both
    tables: ``vec_id, embedding``; a query isn't its own candidate."""
    spark = vectors.sparkSession

    def valid(df):
        v = F.transform("embedding", lambda x: x.cast("double"))
        finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != math.inf), F.lit(False)))
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec")).filter(F.col("vec_id").isNotNull() & finite)

    cands, _ = _blocks(valid(vectors), CANDIDATES, "search-candidates")
    asked, n_q = _blocks(valid(queries), QUERIES, "search-queries")
    if not n_q:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = asked.select(F.col("block").alias("q"), F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"), F.col("data").alias("q_data"))
    pairs = cands.select("block", "ids", "dims", "data", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))).alias("q"))
    pairs = pairs.withColumn("slice", F.floor(F.col("block") / SLICE)).join(asked, "q")
    pairs = pairs.repartition("q", "slice").sortWithinPartitions("q", "slice", "block")
    found = pairs.select("q", "slice", "ids", "dims", "data", "q_ids", "q_dims", "q_data").mapInArrow(_searched(k), "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT r, vec_id, unnest(range(len(e))) AS i, unnest(e) AS c FROM v),
s AS (SELECT q.r AS qr, q.vec_id AS query_id, c.r, c.vec_id, sum(q.c * c.c)::BIGINT AS score
  FROM x q JOIN x c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0 GROUP BY ALL)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= {K}
"""
