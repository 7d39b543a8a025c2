"""Year-over-year growth, citation velocity, exploding and latest-n per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import growth_pct


def explode_categories(
    df: DataFrame, categories: str = "categories", out: str = "category"
) -> DataFrame:
    """One row per category; an empty or NULL list gives no row."""
    rest = [x for x in df.columns if x != categories]
    return df.select(*rest, F.explode(categories).alias(out)).where(F.col(out).isNotNull())


def explode_counts(df: DataFrame, counts: str = "counts_by_year") -> DataFrame:
    """One row per (year, count) entry; entries without a year are left out."""
    rest = [x for x in df.columns if x != counts]
    return (
        df.select(*rest, F.explode(counts).alias("_e"))
        .select(
            *rest,
            F.col("_e.year").alias("citation_year"),
            F.col("_e.cited_by_count").alias("citations_in_year"),
        )
        .where("citation_year IS NOT NULL")
    )


def growth_by_group(
    df: DataFrame,
    *,
    id: str,
    date: str,
    categories: str = "categories",
    calendar: bool = False,
    approximate: float | None = None,
) -> DataFrame:
    """Distinct papers per category and year, with growth against an earlier year.

    The earlier year is the previous one with data, or with ``calendar`` the
    previous calendar year (NULL where it has no data). The window runs over
    the counts, so a partition holds one row per year however big a category is.
    ``approximate`` counts papers with that relative error instead of exactly.
    """
    papers = F.approx_count_distinct(id, approximate) if approximate else F.count_distinct(id)
    counts = (
        explode_categories(
            df.select(id, F.year(date).alias("year"), categories).where("year IS NOT NULL"),
            categories,
        )
        .groupBy("category", "year")
        .agg(papers.alias("publication_count"))
    )
    w = Window.partitionBy("category").orderBy("year")
    previous = F.lag("publication_count").over(w)
    if calendar:
        previous = F.when(F.lag("year").over(w) == F.col("year") - 1, previous)
    return counts.withColumn("previous_year_count", previous).withColumn(
        "publication_growth_pct",
        growth_pct(F.col("publication_count"), F.col("previous_year_count")),
    )


def _velocity_columns(current: Column, previous: Column) -> list[Column]:
    return [
        (current - F.coalesce(previous, F.lit(0))).alias("citation_velocity"),
        growth_pct(current, previous).alias("citation_growth_pct"),
    ]


def velocity_by_key(
    df: DataFrame, keys: Sequence[str], year: str, count: str
) -> DataFrame:
    """Change against the previous available year, for one row per key and year.

    Pre-aggregate to (key, year) first; then a window partition is a few years.
    """
    w = Window.partitionBy(*keys).orderBy(year)
    flat = df.select(
        *keys,
        F.col(year).alias("citation_year"),
        F.col(count).alias("citations_in_year"),
        F.lag(count).over(w).alias("previous_year_citations"),
    )
    return flat.select(
        "*", *_velocity_columns(F.col("citations_in_year"), F.col("previous_year_citations"))
    )


def velocity_from_array(df: DataFrame, counts: str = "counts_by_year") -> DataFrame:
    """Velocity of works that carry their yearly counts as an array.

    Each work is one row, so the previous year is looked up inside the sorted
    array and nothing is shuffled.
    """
    rest = [x for x in df.columns if x != counts]
    years = F.array_sort(F.filter(counts, lambda e: e["year"].isNotNull()))
    steps = df.select(*rest, years.alias("_y")).select(
        *rest,
        F.inline(
            F.transform(
                "_y",
                lambda e, i: F.struct(
                    e["year"].alias("citation_year"),
                    e["cited_by_count"].alias("citations_in_year"),
                    F.when(i > 0, F.get("_y", i - 1)["cited_by_count"]).alias(
                        "previous_year_citations"
                    ),
                ),
            )
        ),
    )
    return steps.select(
        "*", *_velocity_columns(F.col("citations_in_year"), F.col("previous_year_citations"))
    )


def latest_per_group(
    df: DataFrame, group: Sequence[str], date: str, tie: str, n: int
) -> DataFrame:
    """The ``n`` most recent rows per group, NULL dates last, ``tie`` ascending.

    Each map task keeps n rows per group before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy(*group).orderBy(F.desc_nulls_last(date), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
