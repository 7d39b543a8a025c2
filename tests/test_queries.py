"""Every registered query against its SQL, and the plans that matter."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from impactflow.plans.inspect import plan_text
from impactflow.plans.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_text(df)


def plan(spark, name) -> str:
    return plan_text(entry.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["dedup_keep_last", "dedup_keep_first", "latest_per_group", "top_terms"])
def test_rows_are_limited_per_key_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


def test_no_query_uses_a_cartesian_product(spark):
    for name in ("impact_top", "minmax_normalize", "tfidf", "match_cascade", "quality_gate", "run_suite"):
        assert not re.search(r"CartesianProduct|NestedLoop", plan(spark, name)), name


def test_velocity_from_array_adds_no_shuffle(spark):
    base = plan(spark, "explode_struct_array").count("Exchange ")
    assert plan(spark, "velocity_from_array").count("Exchange ") == base


def test_only_needed_columns_are_read(spark):
    text = plan_text(entry.queries()["scan_parquet"](spark, SF), "formatted")
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_size:int>" in text
    assert "GreaterThanOrEqual(p_size,25)" in text


@pytest.mark.parametrize("name", ["impact_top", "tfidf"])
def test_statistics_reuse_the_shuffles_of_the_main_plan(spark, name):
    assert "ReusedExchange" in final_plan(entry.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["clean_papers", "schema_conformance"])
def test_lines_of_a_small_file_are_dealt_over_tasks(spark, name):
    assert "REPARTITION_BY_COL" in plan(spark, name)
