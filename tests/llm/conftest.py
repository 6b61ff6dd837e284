from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """A documents table of (id, text) or (id, text, lang, source) rows, with a column whose name some operator uses itself."""

    def make(rows, schema=SCHEMA):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", None) for r in rows]
        return spark.createDataFrame(full, schema).selectExpr("*", "'x' AS size", "'y' AS key", "0 AS rate")

    return make


@pytest.fixture
def sample(spark):
    """Documents of the smallest benchmark tables as (id, text, lang, source) rows."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    return [tuple(r) for r in sorted(rows)]
