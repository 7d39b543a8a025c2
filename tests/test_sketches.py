"""Sketches against exact figures."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from impactflow.operators import sketches as s


@pytest.fixture(scope="module")
def values(spark):
    return spark.range(0, 40_000, 1, 4).select(
        "id", (F.col("id") % 7).alias("day"), F.pow(F.rand(3), 3).alias("x"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("tied")
    )


def test_merged_edges_keep_their_rank(spark, values, tmp_path):
    s.quantile_sketches(values, ["day"], "x").write.parquet(f"{tmp_path}/q")
    stored = spark.read.parquet(f"{tmp_path}/q")
    assert stored.count() == 7
    edges = s.united_edges(stored, 10)
    rows = s.rank_check(values, "x", edges).collect()
    assert sorted(r["part"] for r in rows) == list(range(9)) and all(r["within"] for r in rows)
    x = np.sort([r["x"] for r in values.collect()])
    for r in rows:
        assert r["rank"] == pytest.approx(np.searchsorted(x, r["edge"], "right") / len(x))
    wrong = s.rank_check(values, "x", edges.select(F.transform("edges", lambda e: e + 0.2).alias("edges"))).collect()
    assert not any(r["within"] for r in wrong if r["part"] < 5)
    by_day = s.united_edges(stored, 4, ["day"]).collect()
    assert len(by_day) == 7 and all(len(r["edges"]) == 3 for r in by_day)


def test_ties_nulls_and_exact_edges(spark, values):
    tied = values.withColumn("tied", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("tied")))
    rows = s.rank_check(tied, "tied", s.united_edges(s.quantile_sketches(tied, [], "tied"), 10)).collect()
    assert all(r["within"] for r in rows)  # the value 5 holds a third of all rows
    exact = s.exact_edges(tied, "tied", 4).first()["edges"]
    held = [r["tied"] for r in tied.where("tied IS NOT NULL").collect()]
    assert exact == pytest.approx(np.quantile(held, [0.25, 0.5, 0.75]).tolist())
    assert spark.range(1).select(s.part_of(F.lit(5), F.array(F.lit(1), F.lit(5), F.lit(9)))).first()[0] == 1


def test_distinct_keys_over_batches(values):
    keyed = values.withColumn("key", F.col("id") % 9_000)
    batches = s.distinct_sketches(keyed, [(F.col("id") % 5).alias("batch"), "day"], "key")
    for r in s.united_distinct(batches, ["day"]).collect():
        exact = keyed.where(F.col("day") == r["day"]).select("key").distinct().count()
        assert abs(r["estimate"] - exact) <= exact * s.DISTINCT_ERROR
    other = s.distinct_sketches(keyed.where("key >= 6000"), ["day"], "key")
    got = s.set_estimates(batches, other).first()
    assert [abs(a - b) <= 9_000 * s.DISTINCT_ERROR for a, b in zip(got, (3_000, 9_000, 6_000), strict=True)] == [True] * 3
    assert values.select(s.close(F.lit(3), F.lit(2)), s.close(F.lit(3), F.lit(1))).first()[:] == (True, False)
