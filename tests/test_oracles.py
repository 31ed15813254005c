"""Every registered query of the reference's operators against DuckDB, over the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from loamsift.plans import catalog, catalog_corpus  # noqa: F401  (both register queries)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    if name not in catalog.ORACLES:
        assert got
        return
    result = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in result.fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 106
    assert set(e.oracle_sql()) <= set(e.queries())
