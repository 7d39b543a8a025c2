"""The corpus queries that SQL can express, against their SQL; the others have brute-force tests of their own."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from impactflow.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert "pipeline" in entry.queries()
