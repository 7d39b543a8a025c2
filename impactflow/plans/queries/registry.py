"""Registration of queries and the tables that stand in for the domain data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Scores are taken as of a fixed day, so that they can be compared.
AS_OF = "2002-01-01"
# Pages link to documents the way posts link to papers.
PAGE_URL = r"example\.(?:com|net|org)/[a-z]{2}/([^?#]+)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with equivalent SQL if there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The texts."""
    return table(spark, sf, "documents")


def event_key() -> Column:
    """The id inside the JSON properties of an event."""
    return F.get_json_object("props", "$.k").cast("bigint")


def papers(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as papers: two categories, published when first shipped."""
    first = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.min("l_shipdate").cast("date").alias("published_date"))
    )
    return (
        table(spark, sf, "part")
        .join(first, "p_partkey", "left")
        .select(
            F.col("p_partkey").alias("paper_id"),
            F.col("p_name").alias("title"),
            F.array("p_type", "p_brand").alias("categories"),
            "published_date",
        )
    )


def citations(spark: SparkSession, sf: str) -> DataFrame:
    """Several citation records per paper: line items of a part by supplier."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("paper_id"), "l_suppkey")
        .agg(F.count("*").alias("cited_by_count"))
        .drop("l_suppkey")
    )


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Events as posts about a paper."""
    return table(spark, sf, "events").select(
        event_key().alias("paper_id"),
        F.col("value").cast("decimal(18,2)").alias("score"),
        (F.col("event_type") != "error").cast("int").alias("replies"),
    )


# The same tables in SQL.
PAPERS_SQL = """
papers AS (
  SELECT p_partkey AS paper_id, p_name AS title, p_type, p_brand, published_date
  FROM part LEFT JOIN (
    SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS published_date
    FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey)"""
CITATIONS_SQL = """
citations AS (
  SELECT l_partkey AS paper_id, count(*) AS cited_by_count
  FROM lineitem GROUP BY l_partkey, l_suppkey)"""
POSTS_SQL = """
posts AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS paper_id,
         CAST(value AS DECIMAL(18,2)) AS score,
         CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS replies
  FROM events)"""
DATASET_SQL = f"""{PAPERS_SQL}, {CITATIONS_SQL}, {POSTS_SQL},
cited AS (SELECT paper_id, max(cited_by_count) AS cited_by_count FROM citations GROUP BY 1),
talked AS (SELECT paper_id, sum(score) AS score_total, sum(replies) AS replies_total
           FROM posts GROUP BY 1),
dataset AS (
  SELECT paper_id, title, p_type, p_brand, published_date, cited_by_count,
         CAST(coalesce(score_total, 0) AS DOUBLE) AS score_total,
         CAST(coalesce(replies_total, 0) AS BIGINT) AS replies_total,
         ln(1.0 + cited_by_count) AS citation,
         coalesce(ln(1.0 + CAST(score_total AS DOUBLE) + CAST(replies_total AS DOUBLE)), 0.0)
           AS community,
         CASE WHEN published_date IS NULL THEN 0.0
              ELSE 1.0 / (1.0 + greatest(0, date_diff('day', published_date, DATE '{AS_OF}'))
                                / CAST(365 AS DOUBLE)) END AS recency
  FROM cited JOIN papers USING (paper_id) LEFT JOIN talked USING (paper_id))"""
SCORED_SQL = f"""{DATASET_SQL},
b AS (SELECT min(citation) AS c0, max(citation) AS c1, min(community) AS h0,
             max(community) AS h1, min(recency) AS r0, max(recency) AS r1 FROM dataset),
norms AS (
  SELECT dataset.*,
         CASE WHEN c1 > c0 THEN (citation - c0) / (c1 - c0) ELSE 0 END AS citation_norm,
         CASE WHEN h1 > h0 THEN (community - h0) / (h1 - h0) ELSE 0 END AS community_norm,
         CASE WHEN r1 > r0 THEN (recency - r0) / (r1 - r0) ELSE 0 END AS recency_norm
  FROM dataset CROSS JOIN b),
scored AS (
  SELECT *, 100 * (0.5 * citation_norm + 0.3 * community_norm + 0.2 * recency_norm)
              AS impact_score
  FROM norms)"""
