"""Signals, scores, growth and velocity on small fixtures."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from impactflow.operators import marts, scoring, temporal

def as_of():
    return F.lit("2026-01-01").cast("date")


DAY = datetime.date(2026, 1, 1)


def ago(days):
    return DAY - datetime.timedelta(days=days)


def test_recency(spark):
    dates = [DAY, ago(365), ago(1460), ago(-30), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, d date")
    got = [r[0] for r in df.orderBy("i").select(scoring.recency_signal(F.col("d"), as_of())).collect()]
    assert got == [1.0, 0.5, 0.2, 1.0, 0.0]


def score(spark, papers, citations, posts, **options):
    dataset = scoring.impact_dataset(
        spark.createDataFrame(
            papers, "paper_id string, title string, categories array<string>, published_date date"
        ),
        spark.createDataFrame(citations, "citation_id string, paper_id string, cited_by_count bigint"),
        spark.createDataFrame(posts, "paper_id string, score double, replies double"),
        as_of(),
        **options,
    )
    return {r["paper_id"]: r for r in scoring.impact_scores(dataset).collect()}


def paper(pid, published=DAY):
    return (pid, pid, ["x"], published)


def test_top_and_bottom(spark):
    got = score(
        spark,
        [paper("a"), paper("b", ago(3650)), paper("uncited")],
        [("c1", "a", 9), ("c2", "a", 3), ("c3", "b", 0), ("c4", "unknown", 5), ("c5", None, 5)],
        [("a", 10.0, 5.0), (None, 99.0, 99.0)],
    )
    assert set(got) == {"a", "b"}
    assert got["a"]["cited_by_count"] == 9
    assert got["a"]["impact_score"] == pytest.approx(100.0)
    assert got["b"]["impact_score"] == 0.0
    assert (got["b"]["score_total"], got["b"]["community_norm"]) == (0.0, 0.0)


def test_single_paper_scores_zero(spark):
    got = score(spark, [paper("a")], [("c", "a", 9)], [("a", 1.0, 1.0)])
    assert got["a"]["impact_score"] == 0.0


def test_matches_add_papers_found_by_a_fallback_key(spark):
    matches = spark.createDataFrame([("a", "c1"), ("b", "c2")], "paper_id string, citation_id string")
    citations = [("c1", "a", 1), ("c2", None, 4)]
    got = score(spark, [paper("a"), paper("b")], citations, [], matches=matches)
    assert {k: r["cited_by_count"] for k, r in got.items()} == {"a": 1, "b": 4}


def test_external_bounds(spark):
    df = spark.createDataFrame([(5.0,)], "x double")
    assert scoring.minmax_normalize(df, ["x"], {"x": (0, 10)}).first()["x_norm"] == 0.5


def test_score_validation(spark):
    df = spark.createDataFrame([(50.0,), (None,), (101.0,)], "impact_score double")
    assert tuple(scoring.score_validation(df).first()) == (3, 1, 1, False)
    assert not scoring.score_validation(df.limit(0)).first()["success"]
    assert scoring.score_validation(df.where("impact_score = 50")).first()["success"]


def test_gold_contract(spark):
    dataset = scoring.impact_dataset(
        spark.createDataFrame(
            [paper("a")], "paper_id string, title string, categories array<string>, published_date date"
        ),
        spark.createDataFrame([("a", 1)], "paper_id string, cited_by_count bigint"),
        spark.createDataFrame([], "paper_id string, score double, replies double"),
        as_of(),
    )
    gold = scoring.gold_projection(scoring.impact_scores(dataset))
    assert [f"{n}:{t}" for n, t in gold.dtypes] == [
        "paper_id:string", "title:string", "categories:array<string>", "published_date:string",
        "cited_by_count:bigint", "score_total:double", "replies_total:double",
        "citation_signal_norm:double", "community_signal_norm:double",
        "recency_signal_norm:double", "impact_score:double",
    ]
    assert gold.first()["published_date"] == "2026-01-01"


YEARS = "id string, counts_by_year array<struct<year:bigint,cited_by_count:bigint>>"


def test_velocity_uses_the_previous_available_year(spark):
    works = spark.createDataFrame(
        [("w", [(2022, 8), (2020, 3), (None, 4)]), ("e", []), ("n", None), ("z", [(2020, 0), (2021, 2)])],
        YEARS,
    )
    expected = {
        ("w", 2020): (None, 3, None),
        ("w", 2022): (3, 5, pytest.approx(166.6667, abs=1e-4)),
        ("z", 2020): (None, 0, None),
        ("z", 2021): (0, 2, None),
    }
    flat = temporal.explode_counts(works)
    for out in (
        temporal.velocity_from_array(works),
        temporal.velocity_by_key(flat, ["id"], "citation_year", "citations_in_year"),
    ):
        got = {
            (r["id"], r["citation_year"]): (
                r["previous_year_citations"], r["citation_velocity"], r["citation_growth_pct"],
            )
            for r in out.collect()
        }
        assert got == expected


def test_growth_available_and_calendar_year(spark):
    rows = [("a", 2019), ("b", 2019), ("c", 2021), ("c", 2021), ("d", 2022)]
    df = spark.createDataFrame(
        [(i, datetime.date(y, 5, 1), ["x"]) for i, y in rows] + [("n", None, ["x"]), ("m", DAY, [])],
        "id string, d date, categories array<string>",
    )

    def growth(calendar):
        out = temporal.growth_by_group(df, id="id", date="d", calendar=calendar)
        return [tuple(r)[1:] for r in out.orderBy("year").collect()]

    assert growth(False) == [(2019, 2, None, None), (2021, 1, 2, -50.0), (2022, 1, 1, 0.0)]
    assert growth(True) == [(2019, 2, None, None), (2021, 1, None, None), (2022, 1, 1, 0.0)]


def test_latest_per_group_puts_missing_dates_last(spark):
    df = spark.createDataFrame(
        [("g", 1, None), ("g", 2, DAY), ("g", 3, DAY), ("h", 4, None)], "g string, id int, d date"
    )
    got = temporal.latest_per_group(df, ["g"], "d", "id", 2).orderBy("g", "rank").collect()
    assert [(r["g"], r["id"]) for r in got] == [("g", 2), ("g", 3), ("h", 4)]


def test_marts(spark):
    scored = spark.createDataFrame(
        [
            ("a", "A", ["x", "y"], datetime.date(2020, 1, 1), 4, 1.0, 0.0, 0.5, 60.0),
            ("b", "B", ["x"], datetime.date(2021, 1, 1), 2, 0.5, 1.0, 0.0, 55.0),
        ],
        "paper_id string, title string, categories array<string>, published_date date, "
        "cited_by_count bigint, citation_norm double, community_norm double, "
        "recency_norm double, impact_score double",
    )
    summary = {r["category"]: tuple(r)[1:] for r in marts.category_summary(scored).collect()}
    assert summary == {"x": (2, 3.0, 57.5), "y": (1, 4.0, 60.0)}
    evolution = sorted(map(tuple, marts.category_evolution(scored, 1).collect()))
    assert evolution == [("x", 2020, 1, 60.0), ("x", 2021, 1, 55.0)]
    top = marts.impact_ranking(scored, 1).first()
    assert (top["paper_id"], top["citation_points"], top["recency_points"]) == ("a", 50.0, 10.0)
    tenths = sorted(r["tenth"] for r in marts.signal_profile(scored).collect())
    assert tenths == [5, 9]
