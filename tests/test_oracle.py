"""Every SQL-checked registered query equals its DuckDB oracle on the
smallest test tables (the driver runs the same check at sf0.01)."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as E  # noqa: E402
from relevo.plans.queries import SQL_CHECKED  # noqa: E402

TABLES = ["documents", "conversations", "pages", "events", "labels", "benchmark"]

def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


def _con(folder):
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(folder, f"{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.fixture(scope="module")
def cons(sf_small):
    return {sf_small: _con(sf_small)}


def test_every_sql_query_has_an_oracle():
    assert set(SQL_CHECKED) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL_CHECKED))
def test_query_equals_oracle(spark, cons, sf_small, name):
    folder = sf_small
    df = SQL_CHECKED[name](spark, folder)
    types = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "DoubleType()": "DOUBLE", "IntegerType()": "INTEGER"}
    ours_t = {f.name: types.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    want_t = {r[0]: r[1] for r in cons[folder].execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert ours_t == want_t
    ours = _rows(df.toPandas())
    want = _rows(cons[folder].execute(E.oracle_sql()[name]).df())
    assert ours[0] == want[0]
    assert len(ours[1]) == len(want[1])
    assert ours[1] == want[1]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["collection_id", "n_texts", "n_positive", "n_candidates", "positive_fraction"]
