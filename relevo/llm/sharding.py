"""Sharding by sampled splitters (operator 1), DataFrame functions only.

Law ``bytes``: the shards' sizes are near equal.  Documents are ordered by a
key (digest of the text, then digest of the id), so equal texts lie together
and are only parted where a shard ends.  The steps:

1. size-weighted sample of keys, decided by a hash of the key, so that a task
   that runs again draws the same sample;
2. quantiles of the sample are the boundaries of many ranges, several for each
   shard; ranges that turn out overfull are sampled again and subdivided;
3. each range is sorted by itself, and a running byte count inside the range
   plus the sizes of the ranges before it gives every document its exact place
   in the order, hence its shard and its slot.

What reaches the driver are the sample's keys and one row for each range, both
bounded by ``rows_per_range`` (ranges = rows / rows_per_range).

Defined results: a null text has no bytes (size 1) and no checksum; an empty
text has size 1; rows repeated exactly are all placed, in any order among
themselves; null ids are ordered as the empty string; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relevo.llm.common import table
from relevo.session import materialize

NAME = "op1_sharding"
SHARDS = 8
#: Ranges for each shard at least, and rows that one range should hold.
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 500_000
#: Sampled keys for each range.
SAMPLES_PER_RANGE = 24
#: A range with so many times the mean bytes is subdivided.
OVERFULL = 2.0
_U = float(1 << 60)


def _keyed(docs: DataFrame) -> DataFrame:
    text, doc_id = F.col("text"), F.col("doc_id")
    return docs.select(
        doc_id,
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.concat(
            F.when(text.isNull(), "-").otherwise(F.md5(text)),
            F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))),
        ).alias("key"),
    )


def _drawn(rows: DataFrame, per_byte: F.Column) -> list[str]:
    """Keys of a sample in which a row's chance is its size times ``per_byte``
    (larger rows may count several times)."""
    want = F.col("size") * per_byte
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 60)) / F.lit(_U)
    times = F.floor(want) + F.when(chance < want - F.floor(want), 1).otherwise(0)
    return [r[0] for r in rows.select("key", times.alias("n")).filter("n > 0").select(F.explode(F.array_repeat("key", F.col("n").cast("int")))).collect()]


def _quantiles(keys: list[str], pieces: int) -> set[str]:
    keys = sorted(keys)
    return {keys[len(keys) * i // pieces] for i in range(1, pieces)} if keys else set()


def _range_of(bounds: list[str]) -> F.Column:
    """Number of boundaries at or below the key; two levels, so that a row is
    compared with about 2 * sqrt(boundaries) of them."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda a: F.size(F.filter(a, lambda b: b <= F.col("key")))
    coarse = below(F.array(*[F.lit(g[0]) for g in groups]))
    fine = below(F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in groups]), F.greatest(coarse, F.lit(1))))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + fine)


def split_ranges(keyed: DataFrame, ranges: int) -> tuple[list[str], list]:
    """Boundaries of the key ranges, and a row (r, bytes, n) for each range."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [], []
    bounds = sorted(_quantiles(_drawn(keyed, F.lit(ranges * SAMPLES_PER_RANGE / total)), ranges))
    target = total / ranges
    while True:
        sizes = keyed.groupBy(_range_of(bounds).alias("r")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        ).orderBy("r").collect()
        full = [s for s in sizes if s["bytes"] > OVERFULL * target and s["low"] < s["high"]]
        if not full:
            return bounds, sizes
        inside = keyed.filter(_range_of(bounds).isin([s["r"] for s in full]))
        more = _drawn(inside, F.lit(SAMPLES_PER_RANGE / target))
        new = set(bounds)
        for s in full:
            own = [k for k in more if s["low"] <= k <= s["high"]]
            # the highest key always makes a cut, so every round parts the range
            new |= _quantiles(own, math.ceil(s["bytes"] / target)) | {s["high"]}
        bounds = sorted(new)


def shard_documents(docs: DataFrame, shards: int = SHARDS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    spark = docs.sparkSession
    keyed = materialize(_keyed(docs), "sharding-keys")
    n = keyed.count()
    bounds, sizes = split_ranges(keyed, max(shards * RANGES_PER_SHARD, n // rows_per_range))
    ahead, rows, b = [], 0, 0
    for s in sizes:
        ahead.append((s["r"], b, rows))
        b, rows = b + s["bytes"], rows + s["n"]
    offsets = spark.createDataFrame(ahead, "r int, bytes_ahead long, rows_ahead long")
    inside = Window.partitionBy("r").orderBy("key")
    placed = (
        keyed.withColumn("r", _range_of(bounds).cast("int"))
        .join(F.broadcast(offsets), "r")
        .withColumn("before", F.col("bytes_ahead") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("place", F.col("rows_ahead") + F.row_number().over(inside) - 1)
        .select("doc_id", "size", "text_crc32", "place", F.expr(f"before * {shards} div {max(b, 1)}").cast("int").alias("shard"))
    )
    placed = materialize(placed, "sharding-places")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        out.append(i)
    return out


ORACLE_SQL = f"""
WITH k AS (SELECT doc_id, text, (coalesce(octet_length(encode(text)), 0) + 1)::BIGINT AS size,
        CASE WHEN text IS NULL THEN '-' ELSE md5(text) END || md5(coalesce(doc_id::VARCHAR, '')) AS key,
        list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::UBIGINT) AS bytes
      FROM documents),
p AS (SELECT *, sum(size) OVER (ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM k),
s AS (SELECT *, (before * {SHARDS} // total)::INTEGER AS shard FROM p)
SELECT doc_id, size,
  CASE WHEN text IS NULL THEN NULL ELSE xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
    lambda a, b: xor(a >> 8, ({_crc_table()}::UBIGINT[])[(xor(a, b) & 255)::INTEGER + 1])), 4294967295::UBIGINT)::BIGINT END AS text_crc32,
  'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY key) - 1)::BIGINT AS slot,
  NULL::INTEGER AS grown_shard
FROM s
"""
