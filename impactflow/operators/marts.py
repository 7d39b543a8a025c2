"""Summary tables over gold and cleaned data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import WEIGHTS, impact_top
from .temporal import explode_categories, explode_counts


def impact_ranking(
    scored: DataFrame, n: int, weights: Mapping[str, float] = WEIGHTS
) -> DataFrame:
    """The ``n`` best papers with the points each signal contributes."""
    points = {
        f"{s}_points": F.lit(100.0 * w) * F.col(f"{s}_norm") for s, w in weights.items()
    }
    return impact_top(scored, n).withColumns(points)


def category_summary(scored: DataFrame) -> DataFrame:
    """Per category: papers, mean citations, mean score."""
    return (
        explode_categories(scored.select("categories", "cited_by_count", "impact_score"))
        .groupBy("category")
        .agg(
            F.count("*").alias("papers"),
            F.avg("cited_by_count").alias("mean_citations"),
            F.avg("impact_score").alias("mean_score"),
        )
    )


def category_evolution(scored: DataFrame, main: int) -> DataFrame:
    """Mean score per year of the ``main`` biggest categories (ties by name).

    The per-year sums are made first; choosing the main categories then works
    on a few rows per category.
    """
    yearly = (
        explode_categories(
            scored.select(
                "categories", "impact_score", F.year("published_date").alias("year")
            )
        )
        .groupBy("category", "year")
        .agg(F.count("*").alias("papers"), F.sum("impact_score").alias("_total"))
    )
    biggest = (
        yearly.groupBy("category")
        .agg(F.sum("papers").alias("_n"))
        .orderBy(F.desc("_n"), "category")
        .limit(main)
    )
    return (
        yearly.where("year IS NOT NULL")
        .join(biggest.select("category"), "category", "left_semi")
        .select("category", "year", "papers", (F.col("_total") / F.col("papers")).alias("mean_score"))
    )


def publications_over_time(papers: DataFrame, date: str) -> DataFrame:
    return (
        papers.select(F.year(date).alias("year"))
        .where("year IS NOT NULL")
        .groupBy("year")
        .agg(F.count("*").alias("publications"))
    )


def citation_volume(works: DataFrame, counts: str = "counts_by_year") -> DataFrame:
    """Citations received per year over all works."""
    return (
        explode_counts(works.select(counts), counts)
        .groupBy("citation_year")
        .agg(F.sum("citations_in_year").alias("citations"))
    )


def signal_correlations(scored: DataFrame) -> DataFrame:
    """One row: pairwise correlations of the normalised signals."""
    c, h, r = "citation_norm", "community_norm", "recency_norm"
    return scored.agg(
        F.corr(c, h).alias("citation_community"),
        F.corr(c, r).alias("citation_recency"),
        F.corr(h, r).alias("community_recency"),
    )


def signal_profile(scored: DataFrame, by: str = "citation_norm") -> DataFrame:
    """Mean signals and score per tenth of the range of one normalised signal."""
    tenth = F.least(F.floor(F.col(by) * 10), F.lit(9)).alias("tenth")
    return scored.groupBy(tenth).agg(
        F.count("*").alias("papers"),
        *[F.avg(f"{s}_norm").alias(f"mean_{s}") for s in WEIGHTS],
        F.avg("impact_score").alias("mean_score"),
    )


def monitoring_row(
    inventory: DataFrame, summary: DataFrame, *, source: str, layer: str, at: Column
) -> DataFrame:
    """One monitoring document: volumes from an inventory, rates from a rule run."""
    rules = summary.select(F.struct("*").alias("s")).scalar()
    size = F.col("size_bytes")
    return inventory.withColumn("_s", rules).select(
        at.alias("timestamp"),
        F.lit(source).alias("source"),
        F.lit(layer).alias("layer"),
        F.col("files").cast("int").alias("object_count"),
        size.cast("bigint").alias("size_bytes"),
        (size / F.lit(2**20)).alias("size_mb"),
        (size / F.lit(2**30)).alias("size_gb"),
        F.col("_s.evaluated").cast("int").alias("ge_evaluated"),
        F.col("_s.successful").cast("int").alias("ge_successful"),
        F.col("_s.unsuccessful").cast("int").alias("ge_failed"),
        F.col("_s.success_pct").alias("ge_success_rate"),
        (F.lit(100.0) - F.col("_s.success_pct")).alias("ge_error_rate"),
        F.col("newest").alias("freshness_timestamp"),
    )
