"""Growth, velocity, exploding and latest rows per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import columns as c
from ...operators import temporal as t
from .registry import papers, query, table


def dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.array("o_orderpriority", "o_orderstatus").alias("categories"),
    )


GROWTH_SQL = """WITH x AS (
      SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year,
             unnest([o_orderpriority, o_orderstatus]) AS category FROM orders),
    n AS (SELECT category, year, count(DISTINCT o_orderkey) AS publication_count
          FROM x GROUP BY 1, 2),
    l AS (SELECT *, lag(publication_count) OVER (PARTITION BY category ORDER BY year)
            AS previous_year_count FROM n)
    SELECT *, round(CASE WHEN previous_year_count > 0
      THEN 100.0 * (publication_count - previous_year_count) / previous_year_count END, 4)
      AS publication_growth_pct FROM l"""


@query("growth_by_group", GROWTH_SQL)
def growth_by_group(spark: SparkSession, sf: str) -> DataFrame:
    growth = t.growth_by_group(dated_orders(spark, sf), id="o_orderkey", date="o_orderdate")
    return growth.withColumn(
        "publication_growth_pct", F.round("publication_growth_pct", 4)
    )


def yearly_citations(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per part and year, as citations received in that year."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey", F.year("l_shipdate").alias("year"))
        .agg(F.count("*").alias("n"))
    )


def cited_works(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as works with one array entry per year."""
    return (
        yearly_citations(spark, sf)
        .groupBy("l_partkey")
        .agg(
            F.collect_list(
                F.struct(F.col("year").cast("bigint").alias("year"), F.col("n").alias("cited_by_count"))
            ).alias("counts_by_year")
        )
    )


YEARLY_SQL = """y AS (
  SELECT l_partkey, year(l_shipdate) AS citation_year, count(*) AS citations_in_year
  FROM lineitem GROUP BY 1, 2)"""
VELOCITY_SQL = f"""WITH {YEARLY_SQL},
    l AS (SELECT *, lag(citations_in_year) OVER (PARTITION BY l_partkey ORDER BY citation_year)
            AS previous_year_citations FROM y)
    SELECT l_partkey, CAST(citation_year AS BIGINT) AS citation_year, citations_in_year,
           previous_year_citations,
           citations_in_year - coalesce(previous_year_citations, 0) AS citation_velocity,
           round(CASE WHEN previous_year_citations > 0 THEN 100.0 *
             (citations_in_year - previous_year_citations) / previous_year_citations END, 4)
             AS citation_growth_pct FROM l"""


def _shown(velocity: DataFrame) -> DataFrame:
    return velocity.withColumns(
        {
            "citation_year": F.col("citation_year").cast("bigint"),
            "citation_growth_pct": F.round("citation_growth_pct", 4),
        }
    )


@query("velocity_by_key", VELOCITY_SQL)
def velocity_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(t.velocity_by_key(yearly_citations(spark, sf), ["l_partkey"], "year", "n"))


@query("velocity_from_array", VELOCITY_SQL)
def velocity_from_array(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(t.velocity_from_array(cited_works(spark, sf)))


@query(
    "explode_categories",
    "SELECT o_orderkey, unnest([o_orderpriority, o_orderstatus]) AS category FROM orders",
)
def explode_categories(spark: SparkSession, sf: str) -> DataFrame:
    return t.explode_categories(dated_orders(spark, sf)).drop("o_orderdate")


@query(
    "explode_struct_array",
    f"""WITH {YEARLY_SQL} SELECT l_partkey, CAST(citation_year AS BIGINT) AS citation_year,
    citations_in_year FROM y""",
)
def explode_struct_array(spark: SparkSession, sf: str) -> DataFrame:
    return t.explode_counts(cited_works(spark, sf))


@query(
    "latest_per_group",
    """SELECT category, paper_id, strftime(published_date, '%Y-%m-%d') AS published_date, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY category
                                   ORDER BY published_date DESC NULLS LAST, paper_id) AS rank
      FROM (SELECT p_partkey AS paper_id, unnest([p_type, p_brand]) AS category, published_date
            FROM part LEFT JOIN (SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS published_date
                                 FROM lineitem GROUP BY 1) ON l_partkey = p_partkey))
    WHERE rank <= 5""",
)
def latest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.explode_categories(papers(spark, sf).drop("title"))
    latest = t.latest_per_group(rows, ["category"], "published_date", "paper_id", 5)
    return latest.select(
        "category",
        "paper_id",
        c.iso_date("published_date").alias("published_date"),
        F.col("rank").cast("bigint").alias("rank"),
    )
