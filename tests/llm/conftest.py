from __future__ import annotations

import pytest


@pytest.fixture
def docs_of(spark):
    """A small documents table from (doc_id, text) or longer tuples."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make
