"""Aggregates per key, signals, normalisation, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import columns as c
from ...operators import scoring as s
from .registry import (
    AS_OF,
    CITATIONS_SQL,
    DATASET_SQL,
    PAPERS_SQL,
    POSTS_SQL,
    SCORED_SQL,
    citations,
    papers,
    posts,
    query,
)


def dataset(spark: SparkSession, sf: str) -> DataFrame:
    return s.impact_dataset(
        papers(spark, sf), citations(spark, sf), posts(spark, sf), F.lit(AS_OF).cast("date")
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return s.impact_scores(dataset(spark, sf))


def rounded(*names: str, digits: int = 4) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


@query(
    "agg_max_per_key",
    f"WITH {CITATIONS_SQL} SELECT paper_id, max(cited_by_count) AS cited_by_count "
    "FROM citations GROUP BY paper_id",
)
def agg_max_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return s.max_per_key(citations(spark, sf), "paper_id", "cited_by_count")


@query(
    "agg_sum_per_key",
    f"""WITH {POSTS_SQL} SELECT paper_id, CAST(sum(score) AS DOUBLE) AS score_total,
    CAST(sum(replies) AS BIGINT) AS replies_total FROM posts GROUP BY paper_id""",
)
def agg_sum_per_key(spark: SparkSession, sf: str) -> DataFrame:
    sums = {"score_total": "score", "replies_total": "replies"}
    return s.sum_per_key(posts(spark, sf), "paper_id", sums).withColumn(
        "score_total", F.col("score_total").cast("double")
    )


@query(
    "global_min_max",
    f"""WITH {DATASET_SQL} SELECT
    round(min(citation), 6) AS min_citation, round(max(citation), 6) AS max_citation,
    round(min(community), 6) AS min_community, round(max(community), 6) AS max_community,
    round(min(recency), 6) AS min_recency, round(max(recency), 6) AS max_recency
    FROM dataset""",
)
def global_min_max(spark: SparkSession, sf: str) -> DataFrame:
    bounds = s.global_min_max(dataset(spark, sf), s.SIGNALS)
    return bounds.select(*rounded(*bounds.columns, digits=6))


@query(
    "log_signal",
    f"""WITH {DATASET_SQL} SELECT paper_id, round(citation, 6) AS citation,
    round(community, 6) AS community FROM dataset""",
)
def log_signal(spark: SparkSession, sf: str) -> DataFrame:
    return dataset(spark, sf).select("paper_id", *rounded("citation", "community", digits=6))


@query(
    "recency_signal",
    f"""WITH {PAPERS_SQL} SELECT paper_id,
    round(CASE WHEN published_date IS NULL THEN 0.0
               ELSE 1.0 / (1.0 + greatest(0, date_diff('day', published_date, DATE '{AS_OF}'))
                                 / CAST(365 AS DOUBLE)) END, 6) AS recency
    FROM papers""",
)
def recency_signal(spark: SparkSession, sf: str) -> DataFrame:
    recency = s.recency_signal(F.col("published_date"), F.lit(AS_OF).cast("date"))
    return papers(spark, sf).select("paper_id", F.round(recency, 6).alias("recency"))


NORMS = ("citation_norm", "community_norm", "recency_norm")


@query(
    "minmax_normalize",
    f"""WITH {SCORED_SQL} SELECT paper_id, round(citation_norm, 6) AS citation_norm,
    round(community_norm, 6) AS community_norm, round(recency_norm, 6) AS recency_norm
    FROM scored""",
)
def minmax_normalize(spark: SparkSession, sf: str) -> DataFrame:
    normalised = s.minmax_normalize(dataset(spark, sf), s.SIGNALS)
    return normalised.select("paper_id", *rounded(*NORMS, digits=6))


@query(
    "composite_score",
    f"WITH {SCORED_SQL} SELECT paper_id, round(impact_score, 4) AS impact_score FROM scored",
)
def composite_score(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("paper_id", *rounded("impact_score"))


@query(
    "impact_dataset",
    f"""WITH {DATASET_SQL} SELECT paper_id, title, strftime(published_date, '%Y-%m-%d')
    AS published_date, cited_by_count, score_total, replies_total,
    round(citation, 6) AS citation, round(community, 6) AS community,
    round(recency, 6) AS recency FROM dataset""",
)
def impact_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return dataset(spark, sf).select(
        "paper_id",
        "title",
        c.iso_date("published_date").alias("published_date"),
        "cited_by_count",
        F.col("score_total").cast("double").alias("score_total"),
        "replies_total",
        *rounded(*s.SIGNALS, digits=6),
    )


@query(
    "impact_top",
    f"""WITH {SCORED_SQL} SELECT paper_id, title, round(impact_score, 4) AS impact_score
    FROM scored ORDER BY scored.impact_score DESC, paper_id LIMIT 20""",
)
def impact_top(spark: SparkSession, sf: str) -> DataFrame:
    top = s.impact_top(scored(spark, sf), 20)
    return top.select("paper_id", "title", *rounded("impact_score"))


@query(
    "score_validation",
    f"""WITH {SCORED_SQL} SELECT count(*) AS rows,
    count(*) FILTER (WHERE impact_score IS NULL) AS null_scores,
    count(*) FILTER (WHERE NOT impact_score BETWEEN 0 AND 100) AS out_of_range,
    count(*) > 0 AND bool_and(impact_score BETWEEN 0 AND 100) AS success FROM scored""",
)
def score_validation(spark: SparkSession, sf: str) -> DataFrame:
    return s.score_validation(scored(spark, sf))


GOLD_SQL = f"""WITH {SCORED_SQL} SELECT paper_id, title, p_type || ' ' || p_brand AS categories,
    strftime(published_date, '%Y-%m-%d') AS published_date, cited_by_count, score_total,
    CAST(replies_total AS DOUBLE) AS replies_total,
    round(citation_norm, 4) AS citation_signal_norm,
    round(community_norm, 4) AS community_signal_norm,
    round(recency_norm, 4) AS recency_signal_norm,
    round(impact_score, 2) AS impact_score FROM scored"""


def shown_gold(gold: DataFrame) -> DataFrame:
    """Gold rows rounded for display, the category list as text."""
    norms = [f"{signal}_signal_norm" for signal in s.SIGNALS]
    return s.round_display(gold, {**{n: 4 for n in norms}, "impact_score": 2}).withColumn(
        "categories", F.concat_ws(" ", "categories")
    )


@query("gold_projection", GOLD_SQL)
def gold_projection(spark: SparkSession, sf: str) -> DataFrame:
    return shown_gold(s.gold_projection(scored(spark, sf)))


@query(
    "round_display",
    f"""WITH {SCORED_SQL} SELECT paper_id, round(citation_norm, 4) AS citation_norm,
    round(community_norm, 4) AS community_norm, round(recency_norm, 4) AS recency_norm,
    round(impact_score, 2) AS impact_score FROM scored""",
)
def round_display(spark: SparkSession, sf: str) -> DataFrame:
    digits = {**{n: 4 for n in NORMS}, "impact_score": 2}
    return s.round_display(scored(spark, sf).select("paper_id", *digits), digits)
