from __future__ import annotations

import pytest

#: Columns whose names clash with those that operators use inside.
CLASH = "spans string, n long, core string, text_key string, candidates string, bits string, component string, kind string"


@pytest.fixture
def docs_of(spark):
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            from pyspark.sql import functions as F

            for part in CLASH.split(", "):
                name, kind = part.split()
                df = df.withColumn(name, F.lit(None).cast(kind))
        return df

    return make


@pytest.fixture
def sf_tables(spark, sf):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
