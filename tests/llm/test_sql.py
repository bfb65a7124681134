"""Queries of the training-data operators against their DuckDB SQL."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from relevo.llm.registry import ORACLES, QUERIES  # noqa: E402

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _rows(table):
    names = sorted(table.column_names)
    return names, sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in (r[n] for n in names)) for r in table.to_pylist()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_small, t)}.parquet')")
    got = QUERIES[name](spark, sf_small).toArrow()
    want = con.execute(ORACLES[name]).to_arrow_table()
    assert _rows(got) == _rows(want)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
