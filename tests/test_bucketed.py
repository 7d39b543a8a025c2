"""Key tables in buckets are joined as they lie."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from impactflow.operators.matching import match_by_key, match_stored
from impactflow.plans.inspect import plan_text
from impactflow.sinks.bucketed import read_key_table, write_key_table


def tables(spark, folder, buckets=8):
    left = spark.createDataFrame([(i, f"P{i % 90}") for i in range(100)] + [(500, None)], "paper_id long, doi string")
    right = spark.createDataFrame(
        [(i, f" p{i % 70} ") for i in range(150)] + [(i, "p3") for i in range(200, 400)] + [(900, None)] * 3,
        "work_id long, doi string",
    )
    lk, rk = F.lower("doi"), F.trim("doi")
    write_key_table(left, f"{folder}/left", lk, buckets)
    write_key_table(right, f"{folder}/right", rk, buckets)
    return match_by_key(left, right, (lk, rk), "paper_id", "work_id")


def test_same_pairs_without_exchange(spark, tmp_path):
    want = tables(spark, str(tmp_path))
    left, right = (read_key_table(spark, f"{tmp_path}/{n}") for n in ("left", "right"))
    got = match_stored(left, right, "paper_id", "work_id")
    plan = plan_text(got, "formatted")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert sorted(got.collect()) == sorted(want.collect())
    assert left.count() == 100  # the row without a key stays out
    assert len(list((tmp_path / "right" / "rows").glob("*.parquet"))) <= 8
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_key_has_all_its_rows(spark, tmp_path):
    tables(spark, str(tmp_path))
    one = read_key_table(spark, f"{tmp_path}/right").where("_k = 'p3'")
    assert one.count() == 203


def test_empty_torn_and_existing_tables(spark, tmp_path):
    none = spark.createDataFrame([], "a long, b string")
    write_key_table(none, f"{tmp_path}/none", F.col("a"), 4)
    stored = read_key_table(spark, f"{tmp_path}/none")
    assert stored.count() == 0 and match_stored(stored, stored.withColumnRenamed("a", "c"), "a", "c").count() == 0
    with pytest.raises(Exception, match="(?i)exist"):
        write_key_table(none, f"{tmp_path}/none", F.col("a"), 4)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_key_table(spark, f"{tmp_path}/absent")
