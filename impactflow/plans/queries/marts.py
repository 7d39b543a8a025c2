"""Summary tables over the scored papers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import expect as e
from ...operators import marts as m
from ...session import scratch_dir
from ...sinks.tables import write_parquet
from ...sources.files import input_inventory
from .registry import SCORED_SQL, query, table
from .scoring import rounded, scored
from .temporal import YEARLY_SQL, cited_works

POINTS = ("citation_points", "community_points", "recency_points", "impact_score")


@query(
    "mart_impact_ranking",
    f"""WITH {SCORED_SQL} SELECT paper_id, title, round(50 * citation_norm, 4) AS citation_points,
    round(30 * community_norm, 4) AS community_points,
    round(20 * recency_norm, 4) AS recency_points, round(scored.impact_score, 4) AS impact_score
    FROM scored ORDER BY scored.impact_score DESC, paper_id LIMIT 50""",
)
def mart_impact_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return m.impact_ranking(scored(spark, sf), 50).select("paper_id", "title", *rounded(*POINTS))


CATEGORY_SQL = f"""{SCORED_SQL},
by_category AS (SELECT unnest([p_type, p_brand]) AS category, * FROM scored)"""


@query(
    "mart_category_summary",
    f"""WITH {CATEGORY_SQL} SELECT category, count(*) AS papers,
    round(avg(cited_by_count), 4) AS mean_citations, round(avg(impact_score), 4) AS mean_score
    FROM by_category GROUP BY category""",
)
def mart_category_summary(spark: SparkSession, sf: str) -> DataFrame:
    return m.category_summary(scored(spark, sf)).select(
        "category", "papers", *rounded("mean_citations", "mean_score")
    )


@query(
    "mart_category_evolution",
    f"""WITH {CATEGORY_SQL},
    main AS (SELECT category FROM by_category GROUP BY 1 ORDER BY count(*) DESC, category LIMIT 5)
    SELECT category, CAST(year(published_date) AS INT) AS year, count(*) AS papers,
    round(avg(impact_score), 4) AS mean_score FROM by_category SEMI JOIN main USING (category)
    WHERE published_date IS NOT NULL GROUP BY 1, 2""",
)
def mart_category_evolution(spark: SparkSession, sf: str) -> DataFrame:
    return m.category_evolution(scored(spark, sf), 5).select(
        "category", "year", "papers", *rounded("mean_score")
    )


@query(
    "mart_publications_over_time",
    """SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS publications
    FROM orders GROUP BY 1""",
)
def mart_publications_over_time(spark: SparkSession, sf: str) -> DataFrame:
    return m.publications_over_time(table(spark, sf, "orders"), "o_orderdate")


@query(
    "mart_citation_volume",
    f"""WITH {YEARLY_SQL} SELECT CAST(citation_year AS BIGINT) AS citation_year,
    CAST(sum(citations_in_year) AS BIGINT) AS citations FROM y GROUP BY 1""",
)
def mart_citation_volume(spark: SparkSession, sf: str) -> DataFrame:
    return m.citation_volume(cited_works(spark, sf))


@query(
    "mart_signal_relation",
    f"""WITH {SCORED_SQL} SELECT round(corr(citation_norm, community_norm), 6) AS citation_community,
    round(corr(citation_norm, recency_norm), 6) AS citation_recency,
    round(corr(community_norm, recency_norm), 6) AS community_recency FROM scored""",
)
def mart_signal_relation(spark: SparkSession, sf: str) -> DataFrame:
    relation = m.signal_correlations(scored(spark, sf))
    return relation.select(*rounded(*relation.columns, digits=6))


@query(
    "mart_signal_profile",
    f"""WITH {SCORED_SQL} SELECT CAST(least(floor(recency_norm * 10), 9) AS BIGINT) AS tenth,
    count(*) AS papers, round(avg(citation_norm), 4) AS mean_citation,
    round(avg(community_norm), 4) AS mean_community, round(avg(recency_norm), 4) AS mean_recency,
    round(avg(impact_score), 4) AS mean_score FROM scored GROUP BY 1""",
)
def mart_signal_profile(spark: SparkSession, sf: str) -> DataFrame:
    return m.signal_profile(scored(spark, sf), "recency_norm").select(
        "tenth",
        "papers",
        *rounded("mean_citation", "mean_community", "mean_recency", "mean_score"),
    )


@query(
    "mart_monitoring",
    """SELECT source, 'bronze' AS layer, true AS has_bytes, ge_evaluated, ge_successful, ge_failed,
      round(100.0 * ge_successful / ge_evaluated, 2) AS ge_success_rate FROM (
      SELECT 'events' AS source, 2 AS ge_evaluated, CAST(max(value) <= 300 AS INT) + 1
        AS ge_successful, CAST(max(value) > 300 AS INT) AS ge_failed FROM events
      UNION ALL SELECT 'orders', 2, 1 + CAST(count(*) = count(DISTINCT o_custkey) AS INT),
        CAST(count(*) > count(DISTINCT o_custkey) AS INT) FROM orders)""",
)
def mart_monitoring(spark: SparkSession, sf: str) -> DataFrame:
    """Volumes of a landed source next to the outcome of its rules."""
    suites = {
        "events": [e.not_null("event_id"), e.between("value", None, 300)],
        "orders": [e.not_null("o_orderkey"), e.unique("o_custkey")],
    }
    rows = []
    for source, rules in suites.items():
        folder = scratch_dir(spark, source)
        write_parquet(table(spark, sf, source), folder)
        landed = spark.read.parquet(folder)
        rows.append(
            m.monitoring_row(
                input_inventory(spark, f"{folder}/*.parquet"),
                e.suite_summary(e.run_suite(landed, rules)),
                source=source,
                layer="bronze",
                at=F.current_timestamp(),
            )
        )
    return reduce(DataFrame.unionByName, rows).select(
        "source",
        "layer",
        ((F.col("size_bytes") > 0) & (F.col("object_count") > 0)).alias("has_bytes"),
        "ge_evaluated",
        "ge_successful",
        "ge_failed",
        "ge_success_rate",
    )
