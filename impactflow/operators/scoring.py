"""Signals, normalisation and the composite impact score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import left_join_fill

# Weights of the three normalised signals.
WEIGHTS = {"citation": 0.5, "community": 0.3, "recency": 0.2}
SIGNALS = tuple(WEIGHTS)


def max_per_key(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(out or value))


def sum_per_key(df: DataFrame, key: str, sums: Mapping[str, str]) -> DataFrame:
    """Sums per key; ``sums`` maps output name to summed column."""
    return df.groupBy(key).agg(*[F.sum(c).alias(o) for o, c in sums.items()])


def log_signal(*counts: Column) -> Column:
    """ln(1 + sum of counts)."""
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return F.log1p(total)


def recency_signal(published: Column, as_of: Column) -> Column:
    """1 / (1 + age in years), age not below 0; 0 without a date."""
    age = F.greatest(F.datediff(as_of, published), F.lit(0))
    return F.when(published.isNull(), 0.0).otherwise(1.0 / (1.0 + age / F.lit(365.0)))


def global_min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with min_<c> and max_<c> of every column, from a single aggregate."""
    return df.agg(
        *[F.min(c).alias(f"min_{c}") for c in cols],
        *[F.max(c).alias(f"max_{c}") for c in cols],
    )


def minmax_normalize(
    df: DataFrame,
    cols: Sequence[str],
    bounds: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Add <c>_norm = (x - min) / (max - min), 0 where max <= min.

    The bounds come from a scalar subquery (one row, one aggregate over the same
    exchange as the table itself) or, for scores that stay comparable between
    runs, from ``bounds``.
    """
    if bounds is None:
        one = global_min_max(df, cols).select(F.struct("*").alias("b"))
        df = df.withColumn("_b", one.scalar())
        low = {c: F.col(f"_b.min_{c}") for c in cols}
        high = {c: F.col(f"_b.max_{c}") for c in cols}
    else:
        low = {c: F.lit(float(bounds[c][0])) for c in cols}
        high = {c: F.lit(float(bounds[c][1])) for c in cols}
    norm = {
        f"{c}_norm": F.when(
            high[c] > low[c], (F.col(c) - low[c]) / (high[c] - low[c])
        ).otherwise(0.0)
        for c in cols
    }
    return df.withColumns(norm).drop("_b")


def composite_score(
    df: DataFrame, weights: Mapping[str, float] = WEIGHTS, out: str = "impact_score"
) -> DataFrame:
    """100 x the weighted sum of the normalised signals."""
    total = None
    for signal, weight in weights.items():
        part = F.lit(float(weight)) * F.col(f"{signal}_norm")
        total = part if total is None else total + part
    return df.withColumn(out, F.lit(100.0) * total)


def impact_dataset(
    papers: DataFrame,
    citations: DataFrame,
    posts: DataFrame,
    as_of: Column,
    matches: DataFrame | None = None,
) -> DataFrame:
    """Cited papers with their three raw signals.

    ``papers(paper_id, ...)`` has one row per paper, ``citations(paper_id,
    cited_by_count)`` and ``posts(paper_id, score, replies)`` any number. Papers
    without a citation record are left out; papers without posts get 0.
    ``matches(paper_id, citation_id)`` replaces the paper id of the citations
    when given, to include matches found by a fallback key.

    Both fact sides are aggregated to the paper id before they meet, so the
    joins are one row to one row and reuse the partitioning of the aggregates.
    """
    if matches is not None:
        citations = matches.select("paper_id", "citation_id").join(
            citations.select("citation_id", "cited_by_count"), "citation_id"
        )
    cited = max_per_key(
        citations.where("paper_id IS NOT NULL"), "paper_id", "cited_by_count"
    )
    talked = sum_per_key(
        posts.where("paper_id IS NOT NULL"),
        "paper_id",
        {"score_total": "score", "replies_total": "replies"},
    ).withColumn("community", log_signal(F.col("score_total"), F.col("replies_total")))
    joined = left_join_fill(
        cited.join(papers, "paper_id"),
        talked,
        ["paper_id"],
        {"score_total": 0, "replies_total": 0, "community": 0.0},
    )
    return joined.withColumn(
        "citation", log_signal(F.col("cited_by_count"))
    ).withColumn("recency", recency_signal(F.col("published_date"), as_of))


def impact_scores(
    dataset: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    bounds: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    return composite_score(minmax_normalize(dataset, list(weights), bounds), weights)


def impact_top(
    scored: DataFrame, n: int, *, score: str = "impact_score", tie: str = "paper_id"
) -> DataFrame:
    """The ``n`` best rows; every task keeps only n rows."""
    return scored.orderBy(F.desc(score), F.asc(tie)).limit(n)


def score_validation(scored: DataFrame, score: str = "impact_score") -> DataFrame:
    """One row: rows, NULL scores, scores outside [0, 100], success."""
    return scored.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(score).isNull()).alias("null_scores"),
        F.count_if(~F.col(score).between(0, 100)).alias("out_of_range"),
    ).withColumn(
        "success",
        (F.col("rows") > 0) & (F.col("null_scores") == 0) & (F.col("out_of_range") == 0),
    )


def gold_projection(scored: DataFrame) -> DataFrame:
    """The published columns, the date as ISO string."""
    return scored.select(
        "paper_id",
        "title",
        "categories",
        F.date_format("published_date", "yyyy-MM-dd").alias("published_date"),
        "cited_by_count",
        F.col("score_total").cast("double").alias("score_total"),
        F.col("replies_total").cast("double").alias("replies_total"),
        F.col("citation_norm").alias("citation_signal_norm"),
        F.col("community_norm").alias("community_signal_norm"),
        F.col("recency_norm").alias("recency_signal_norm"),
        "impact_score",
    )


def round_display(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round the named columns, keep the rest."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})
