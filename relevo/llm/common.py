"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.llm.word_cache import slices

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from whatever store holds it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text (null: empty).  Lone surrogates, which Spark's
    strings cannot hold, are replaced."""
    return b"" if text is None else text.encode("utf-8", "replace")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, element by element (wraps modulo 2**64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def crc_fold(column: F.Column, folds: int) -> F.Column:
    """crc32 of an id's decimal text modulo ``folds`` (null id: null)."""
    return F.crc32(column.cast("string")) % F.lit(folds)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + length)`` of every pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    heads = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=heads[1:])
    out[heads] = starts
    out[heads[1:]] -= starts[:-1] + lengths[:-1] - 1
    return np.cumsum(out)


def map_columns(df: DataFrame, needed: list[str], fields, compute) -> DataFrame:
    """Add columns that ``compute`` makes from the ``needed`` ones.

    ``compute`` gets the needed columns of one Arrow batch as lists and gives
    one list for each of ``fields`` (Spark struct fields); a batch of long
    texts comes in parts, so what a worker holds doesn't grow with it.  The
    input's other columns pass through untouched; a column of the same name as
    a new one is replaced.  Rows stay in their partitions; nothing is
    shuffled."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    new = {f.name for f in fields}
    keep = [f for f in df.schema.fields if f.name not in new]
    schema = StructType([*keep, *fields])
    names, types = [f.name for f in keep], [to_arrow_type(f.dataType) for f in fields]

    def parts(batch):
        sizes = np.zeros(batch.num_rows, np.int64)
        for c in needed:
            column = batch.column(batch.schema.get_field_index(c))
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        for lo, hi in slices(sizes.tolist()):
            yield batch.slice(lo, hi - lo)

    def run(batches):
        for whole in batches:
            for batch in parts(whole):
                made = compute(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in needed))
                cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
                cols += [pa.array(v, t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *(f.name for f in fields)])

    return df.mapInArrow(run, schema)


def packed(docs: DataFrame) -> DataFrame:
    """``text`` and all other columns as the struct ``rest``, so that working
    columns can't clash with them."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"))


def unpacked(columns: list[str], **changed: F.Column) -> list[F.Column]:
    """The columns of a packed table in their order; ``changed`` replaces."""
    return [changed.get(c, F.col("text") if c == "text" else F.col("rest")[c]).alias(c) for c in columns]
