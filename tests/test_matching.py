"""Joins and matching against brute force, with hot and missing keys."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from impactflow.operators import joins as j
from impactflow.operators import matching as m
from impactflow.plans.inspect import join_operators, join_strategy_report, plan_text

# 600 rows: a third under one key, some without a key, the rest spread.
MANY = [(i, 0 if i % 3 == 0 else None if i % 7 == 0 else i % 50) for i in range(600)]
ONE = [(k, f"one-{k}") for k in range(0, 60, 2)]


def frames(spark):
    many = spark.createDataFrame(MANY, "row int, k int").repartition(6)
    return many, spark.createDataFrame(ONE, "k int, name string")


def expected(how):
    names = dict(ONE)
    return Counter(
        (k, row, names.get(k)) for row, k in MANY if how == "left" or k in names
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("row_id", [["row"], []])
def test_salted_join_loses_nothing(spark, how, row_id):
    many, one = frames(spark)
    joined = j.salted_join(many, one, ["k"], how, row_id=row_id, salts=7)
    assert Counter(map(tuple, joined.select("k", "row", "name").collect())) == expected(how)


def test_salting_both_sides_loses_nothing(spark):
    left = [(i, 0 if i % 2 else i % 9) for i in range(90)]
    right = [(100 + i, 0 if i % 3 else i % 9) for i in range(60)]
    joined = j.salted_join(
        spark.createDataFrame(left, "l int, k int").repartition(5),
        spark.createDataFrame(right, "r int, k int").repartition(4),
        ["k"], salts=5, one_salts=3,
    )
    brute = Counter((lk, a, b) for a, lk in left for b, rk in right if lk == rk)
    assert Counter(map(tuple, joined.select("k", "l", "r").collect())) == brute


def test_salted_join_spreads_the_hot_key(spark):
    many, one = frames(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = j.salted_join(many, one, ["k"], row_id=["row"], salts=8)
        tasks = joined.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks > 3


def test_no_join_counts_its_keys_first(spark):
    """One plan at every size: a match is one join, without a pass over the keys."""
    left = spark.range(600).withColumn("k", F.col("id") % 50).toDF("l", "k")
    right = spark.range(60).withColumn("k", F.col("id") % 50).toDF("r", "k")
    plan = plan_text(m.match_by_key(left, right, (F.col("k"), F.col("k")), "l", "r"))
    assert plan.count("Join ") == 1 and "Aggregate" not in plan


def test_matching_survives_a_hot_key(spark):
    left = spark.range(40).withColumn("k", F.col("id") % 4).toDF("l", "k")
    right = spark.range(900).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 9)).toDF("r", "k")
    brute = sum(10 for r in range(900) if (0 if r % 3 == 0 else r % 9) < 4)
    assert m.match_by_key(left, right, (F.col("k"), F.col("k")), "l", "r").count() == brute
    rest = m.without_key(right, F.col("k"), left, F.col("k"))
    assert rest.count() == sum((0 if r % 3 == 0 else r % 9) >= 4 for r in range(900))


def papers(spark):
    return spark.createDataFrame(
        [("p1", "10.1/a"), ("p2", "10.1/b"), ("p3", ""), ("p4", "10.1/d")], "pid string, doi string"
    )


def works(spark, rows):
    return spark.createDataFrame(rows, "wid string, key string, doi string")


def pairs(spark, rows, **options):
    keys = [
        (F.col("pid"), F.col("key")),
        (F.nullif("doi", F.lit("")), F.nullif("doi", F.lit(""))),
    ]
    out = m.match_cascade(papers(spark), works(spark, rows), keys, "pid", "wid", **options)
    return sorted(map(tuple, out.collect()))


ROWS = [
    ("w1", "p1", "10.1/b"),  # by id; its DOI must not match p2
    ("w2", None, "10.1/a"),  # by DOI, although p1 is matched already
    ("w3", "px", "10.1/d"),  # unknown id, so by DOI
    ("w4", None, ""),  # blanks do not join
    ("w5", None, None),
]


def test_cascade_keeps_the_left_side_in(spark):
    assert pairs(spark, ROWS) == [("p1", "w1"), ("p1", "w2"), ("p4", "w3")]


def test_cascade_one_to_one(spark):
    assert pairs(spark, ROWS, one_to_one=True) == [("p1", "w1"), ("p4", "w3")]


def test_cascade_with_repeated_right_ids(spark):
    rows = [("w1", "p1", None), ("w1", None, "10.1/b")]
    assert pairs(spark, rows) == [("p1", "w1"), ("p2", "w1")]
    assert pairs(spark, rows, unique_right=False) == [("p1", "w1")]


def test_both_cascades_agree_on_unique_ids(spark):
    assert pairs(spark, ROWS) == pairs(spark, ROWS, unique_right=False)


def test_three_way_match_is_distinct(spark):
    citation = spark.createDataFrame([("p1", "w1"), ("p1", "w1"), ("p1", "w2")], "pid string, wid string")
    posts = spark.createDataFrame([("p1", 1), ("p1", 1), ("p2", 2)], "pid string, post int")
    out = m.three_way_match(citation, posts, "pid", "post")
    assert sorted(map(tuple, out.select("pid", "wid", "post").collect())) == [
        ("p1", "w1", 1), ("p1", "w2", 1),
    ]


def test_three_way_match_does_not_move_the_joined_rows(spark):
    """Rows of a paper multiply in the join; what comes after it must not sort, group or shuffle them."""
    citation = spark.createDataFrame([("p1", "w1")], "pid string, wid string")
    posts = spark.createDataFrame([("p1", 1, "t")], "pid string, post int, title string")
    plan = plan_text(m.three_way_match(citation, posts, "pid", "post"))
    assert plan.index("Join ") < plan.index("Aggregate")


def test_coverage_of_empty_sides(spark):
    left = spark.createDataFrame([], "l int")
    right = spark.createDataFrame([(1,)], "r int")
    row = m.match_coverage(left, right, spark.createDataFrame([], "l int, r int"), "l", "r").first()
    assert (row["left_rows"], row["left_pct"], row["right_pct"]) == (0, None, 0.0)


def test_join_strategies_are_used_and_agree(spark):
    left = spark.range(100).withColumn("k", F.col("id") % 7)
    right = spark.createDataFrame([(i, str(i)) for i in range(5)], "k bigint, v string")
    broadcast = j.broadcast_join(left, right, ["k"])
    merged = j.sort_merge_join(left, right, ["k"])
    assert join_operators(broadcast) == ["BroadcastHashJoin"]
    assert join_operators(merged) == ["SortMergeJoin"]
    report = join_strategy_report({"broadcast": broadcast, "merge": merged}).collect()
    assert len({(r["rows"], r["content_hash"]) for r in report}) == 1


def test_broadcast_is_left_to_spark(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(10).withColumnRenamed("id", "k")
    assert "ResolvedHint" not in plan_text(j.broadcast_join(left, right, ["k"]), "extended")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = join_operators(j.broadcast_join(left, right, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == ["SortMergeJoin"]


def test_left_join_fill(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5.0)], "k int, s double")
    assert sorted(map(tuple, j.left_join_fill(left, right, ["k"], {"s": 0.0}).collect())) == [
        (1, 5.0), (2, 0.0),
    ]
