"""The cell store: ranges, runs, failed and repeated writes."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from relevo.sources.cell_store import CELLS, after_prefix, as_rows, key_range, prefix_range, read_cells, write_cells
from relevo.sources.cells import cells_to_texts


def _cells(spark, rows):
    return spark.createDataFrame(rows, CELLS)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_newest_run_counts_and_writes_repeat(spark, tmp_path):
    path = str(tmp_path / "store")
    old = [("a-1", "f", "q", "1"), ("a-2", "f", "q", "2"), ("b-1", "f", "q", "3"), ("a-1", "g", None, "x")]
    for _ in range(2):
        write_cells(_cells(spark, old * 2), path, "20240101-000000")
        assert _rows(read_cells(spark, path)) == sorted(old)
    write_cells(_cells(spark, [("a-1", "f", "q", "new"), ("c-1", "f", "q", "4")]), path, "20240202-000000")
    assert _rows(read_cells(spark, path)) == sorted([("a-1", "f", "q", "new"), ("c-1", "f", "q", "4"), *old[1:]])
    broken = _cells(spark, old).withColumn("value", F.when(F.col("row_key") == "b-1", F.raise_error(F.lit("lost"))).otherwise("bad"))
    with pytest.raises(Exception, match="lost"):
        write_cells(broken, path, "20240303-000000")
    assert ("a-1", "f", "q", "new") in _rows(read_cells(spark, path)) and len(_rows(read_cells(spark, path))) == 5
    write_cells(_cells(spark, [("a-1", "f", "q", "newest")]), path, "20240303-000000")
    assert ("a-1", "f", "q", "newest") in _rows(read_cells(spark, path))


def test_ranges_and_prefixes(spark, tmp_path):
    keys = ["60-1", "60-2", "602-1", "61-1", "6", "é-1", "\U0010ffff-1", "zz"]
    path = str(tmp_path / "store")
    write_cells(_cells(spark, [(k, "f", "q", k) for k in keys]), path, "r")
    got = lambda **k: {r.row_key for r in read_cells(spark, path, **k).collect()}
    assert got(collections=["60"]) == {"60-1", "60-2"}
    assert got(collections=["60"], delimited=False) == {"60-1", "60-2", "602-1"}
    assert got(collections=["60", "é", "none"]) == {"60-1", "60-2", "é-1"} and got(collections=[]) == set()
    assert got(where=key_range("60-2", "61")) == {"60-2", "602-1"} and got(where=key_range()) == set(keys)
    for p in ("6", "60", "\U0010ffff", "퟿"[:1], ""):
        assert {k for k in keys if k.startswith(p)} == got(where=prefix_range(p))
    assert after_prefix("a\U0010ffff") == "b" and after_prefix("퟿") == "" and after_prefix("\U0010ffff") is None


def test_a_range_reads_its_own_row_groups(spark, tmp_path):
    """Of many files and row groups only those of the range are read."""
    path = str(tmp_path / "store")
    rows = spark.range(200_000).select(F.format_string("c%02d-%07d", F.col("id") % 50, "id").alias("row_key"), F.lit("f").alias("column_family"), F.lit("q").alias("qualifier"), F.sha2(F.col("id").cast("string"), 512).alias("value"))
    write_cells(rows, path, "r", row_group_bytes=64 << 10)
    df = read_cells(spark, path, collections=["c07"])
    assert df.count() == 4000
    assert "PushedFilters: [GreaterThanOrEqual(row_key,c07-), LessThan(row_key,c07.)]" in df._jdf.queryExecution().executedPlan().toString() or "GreaterThanOrEqual(row_key,c07-)" in df._jdf.queryExecution().toString()
    import pyarrow.parquet as pq

    groups = near = 0
    for f in glob.glob(os.path.join(path, "run_ts=r", "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(0).statistics
            groups += 1
            near += s.max >= "c07-" and s.min < "c07."
    assert near <= groups / 10


def test_rows_of_cells_go_through_the_cell_source(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("s-1", "collection-management", "text", "Some text\nover lines"), ("s-1", "metadata", "lang", "en"), ("s-2", "metadata", "lang", "de")]
    write_cells(_cells(spark, rows), path, "r")
    texts = cells_to_texts(as_rows(read_cells(spark, path)))
    assert [(r.id, r.collection_id, r.text) for r in texts.collect()] == [("s-1", "s", "Some text over lines")]
