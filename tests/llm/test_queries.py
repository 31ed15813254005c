"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from loamsift.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    result = c.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in result.fetchall())


def test_all_ten_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")] and {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 11))
