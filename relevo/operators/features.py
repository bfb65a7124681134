"""Term statistics and sparse feature tables.

A text's features are rows: one for each distinct hashed term, with its
frequency.  Hashing is the library's ``HashingTF`` (collisions add up), so the
rows equal its vectors; frequencies and inverse document frequencies over all
collections, hash sizes and folds are aggregates over these rows, combined
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from relevo.operators.joins import attach_small
from relevo.session import materialize


def term_idf(prepared: DataFrame, tokens_col: str = "words", id_col: str = "id") -> DataFrame:
    """``term, df, idf`` with ``idf = ln((n + 1) / (df + 1))`` over all rows.

    Tokens are de-duplicated inside each row, then counted with a partial
    (map-side) aggregate; ``n`` is a scalar subquery, not a join.
    """
    n = prepared.select(F.count(F.lit(1))).scalar()
    terms = prepared.select(F.explode(F.array_distinct(tokens_col)).alias("term"))
    return (
        terms.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .select("term", "df", F.ln((n + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    )


def idf_of(n: Column | str, df: Column | str) -> Column:
    """Inverse document frequency as the library computes it; a term that no
    training row has (``df`` null) counts as frequency 0."""
    n, df = (F.col(c) if isinstance(c, str) else c for c in (n, df))
    return F.ln((n + 1.0) / (F.coalesce(df, F.lit(0)) + 1.0))


def hash_tokens(rows: DataFrame, sizes: Sequence[int], tokens_col: str = "filtered") -> DataFrame:
    """Add the term-frequency vector ``tf_<size>`` for each hash size; null
    tokens are none."""
    known = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
    rows = rows.withColumn("_tokens", known)
    for n in sizes:
        rows = HashingTF(inputCol="_tokens", outputCol=f"tf_{n}", numFeatures=n).transform(rows)
    return rows.drop("_tokens")


def hashed_vectors(rows: DataFrame, sizes: Sequence[int], tokens_col: str, name: str, partition_by: list[str]) -> DataFrame:
    """``hash_tokens`` without the tokens, written once.

    Tokens are only hashed to sizes that divide no other one.  The index at a
    size that does is the remainder of the other's, so its vector is the
    other's with entries added up, which takes a part of the hashing's time."""
    wider = {n: max(m for m in sizes if m % n == 0) for n in sizes}
    hashed = hash_tokens(rows, [n for n in sizes if wider[n] == n], tokens_col).drop(tokens_col)
    keep = rows.drop(tokens_col).schema.fields
    plain = hashed.select(*[f.name for f in keep], *[F.unwrap_udt(f"tf_{n}").alias(f"tf_{n}") for n in sizes if wider[n] == n])
    names = [*[f.name for f in keep], *[f"tf_{n}" for n in sizes]]

    def run(batches):
        for batch in batches:
            made = {n: batch.column(f"tf_{n}") if wider[n] == n else _folded(batch.column(f"tf_{wider[n]}"), n) for n in sizes}
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], *made.values()], names=names)

    written = StructType([*keep, *[StructField(f"tf_{n}", VectorUDT.sqlType()) for n in sizes]])
    read = StructType([*keep, *[StructField(f"tf_{n}", VectorUDT()) for n in sizes]])
    return materialize(plain.mapInArrow(run, written), name, partition_by, schema=read)


def _folded(vectors: pa.StructArray, size: int) -> pa.StructArray:
    """Sparse vectors with the indices' remainders by ``size``."""
    found = vectors.field("indices")
    starts = found.offsets.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(found)), np.diff(starts))
    at = row * size + found.flatten().to_numpy() % size
    order = np.argsort(at, kind="stable")
    at = at[order]
    head = np.flatnonzero(np.diff(at, prepend=-1))
    tf = np.add.reduceat(vectors.field("values").flatten().to_numpy()[order], head) if len(head) else np.zeros(0)
    offsets = pa.array(np.searchsorted(at[head], np.arange(len(found) + 1) * size).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((at[head] % size).astype(np.int32), tf)]
    return pa.StructArray.from_arrays([pa.array(np.zeros(len(found), np.int8)), pa.array(np.full(len(found), size, np.int32)), *lists], names=["type", "size", "indices", "values"])


def entries(vector: Column | str, **tags: int) -> Column:
    """A sparse vector as ``array<struct<*tags, idx, tf>>``."""
    v = F.unwrap_udt(vector)
    front = [F.lit(value).alias(name) for name, value in tags.items()]
    return F.transform(F.arrays_zip(v["indices"], v["values"]), lambda x: F.struct(*front, x["indices"].alias("idx"), x["values"].alias("tf")))


def exploded_entries(hashed: DataFrame, sizes: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """``*keep, num_features, idx, tf``: a row for every entry of the vectors
    ``tf_<size>``, all sizes from one pass over the rows.

    The vectors are unrolled as they are (no lambda runs over the entries):
    a row is doubled for its sizes, and holds each of its vectors once."""
    sized = [F.struct(F.lit(n).alias("num_features"), F.unwrap_udt(f"tf_{n}").alias("v")) for n in sizes]
    each = hashed.select(*keep, F.inline(F.array(*sized)))
    return each.select(*keep, "num_features", F.inline(F.arrays_zip("v.indices", "v.values"))).toDF(*keep, "num_features", "idx", "tf")


def term_frequencies(rows: DataFrame, num_features: int, tokens_col: str = "filtered", keep: Sequence[str] = ("id", "collection_id")) -> DataFrame:
    """``*keep, idx, tf``: a row for every distinct hashed term of a text.  A
    text without tokens has no row."""
    hashed = hash_tokens(rows.select(*keep, F.col(tokens_col).alias("_terms")), [num_features], "_terms")
    return exploded_entries(hashed, [num_features], keep).drop("num_features")


def hashed_idf(training: DataFrame, num_features: int, tokens_col: str = "filtered", by: str = "collection_id") -> DataFrame:
    """``by, idx, df, idf`` over each collection's training rows."""
    n = training.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    df = term_frequencies(training, num_features, tokens_col, keep=(by,)).groupBy(by, "idx").agg(F.count(F.lit(1)).alias("df"))
    return attach_small(df, n, by).select(by, "idx", "df", idf_of("n_rows", "df").alias("idf"))


def tf_idf(rows: DataFrame, training: DataFrame, num_features: int | Sequence[int], tokens_col: str = "filtered", by: str = "collection_id") -> DataFrame:
    """``id, by, idx, tf, idf, tf_idf`` of every text by its collection's
    training rows; texts of a collection without any have null weights.  For
    several hash sizes also ``num_features``, with rows for each.

    Texts and training rows are read and hashed once for all sizes.  What a
    term that no training row has weighs is attached to the texts, so a term
    meets one join, with the weights."""
    sizes = [num_features] if isinstance(num_features, int) else list(num_features)
    out = ["id", by, *([] if isinstance(num_features, int) else ["num_features"]), "idx", "tf"]
    n = training.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    n = materialize(n.select(by, "n_rows", idf_of("n_rows", F.lit(0)).alias("_rare")), "rows")
    learned = exploded_entries(hash_tokens(training.select(by, F.col(tokens_col).alias("_terms")), sizes, "_terms"), sizes, (by,))
    frequencies = learned.groupBy(by, "num_features", "idx").agg(F.count(F.lit(1)).alias("df"))
    weights = frequencies.join(n, by).select(by, "num_features", "idx", idf_of("n_rows", "df").alias("_idf"))
    texts = rows.select("id", by, F.col(tokens_col).alias("_terms")).join(n.select(by, "_rare"), by, "left")
    terms = exploded_entries(hash_tokens(texts, sizes, "_terms"), sizes, ("id", by, "_rare"))
    weighed = attach_small(terms, weights, [by, "num_features", "idx"], "left")
    idf = F.coalesce("_idf", "_rare")
    return weighed.select(*out, idf.alias("idf"), (F.col("tf") * idf).alias("tf_idf"))


def fold_frequencies(hashed: DataFrame, sizes: Sequence[int], by: str = "collection_id", fold: str = "fold", label: str = "label") -> DataFrame:
    """``by, num_features, fold, label, idx, df, tf``: rows that hold a hashed
    term and its summed frequency, for every hash size, from one aggregate.
    ``hashed`` has the vectors of ``hash_tokens``."""
    terms = exploded_entries(hashed, sizes, (by, fold, label))
    return terms.groupBy(by, "num_features", fold, label, "idx").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))


def fold_idf(frequencies: DataFrame, rows: DataFrame, by: str = "collection_id", fold: str = "fold") -> DataFrame:
    """``by, num_features, fold, idx, df, idf`` of every training part, the
    part that leaves out a fold: the collection's total less the fold's own.

    ``frequencies`` from ``fold_frequencies``, ``rows`` (``by, fold,
    n_rows``) the training rows of each fold.  Terms of the left-out fold
    alone are there with a frequency of 0."""
    own = frequencies.groupBy(by, "num_features", "idx", fold).agg(F.sum("df").alias("df"))
    total = own.groupBy(by, "num_features", "idx").agg(F.sum("df").alias("all_df"))
    all_rows = rows.groupBy(by).agg(F.sum("n_rows").alias("all_rows"))
    parts = rows.join(all_rows, by).select(by, fold, (F.col("all_rows") - F.col("n_rows")).alias("n_part"))
    left = attach_small(total, parts, by).join(own, [by, "num_features", "idx", fold], "left")
    df = F.col("all_df") - F.coalesce("df", F.lit(0))
    return left.select(by, "num_features", fold, "idx", df.alias("df"), idf_of("n_part", df).alias("idf"))
