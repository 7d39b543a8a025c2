"""Joins and matching: pages link to documents, events to documents and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import columns as c
from ...operators import joins as j
from ...operators import matching as m
from ...session import scratch_dir
from ...sinks.bucketed import read_key_table, write_key_table
from ..inspect import join_strategy_report
from .registry import PAGE_URL, event_key, papers, posts, query, table


def page_key() -> Column:
    key = c.id_from_url("url", PAGE_URL, extension=".html", strip_slash=True)
    return key.try_cast("bigint")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url", page_key().alias("url_doc"))


PAGES_SQL = r"""p AS (
  SELECT page_id, url, TRY_CAST(regexp_extract(url, '/[a-z]{2}/([0-9]+)', 1) AS BIGINT) AS url_doc
  FROM pages)"""
BY_ID_SQL = f"""{PAGES_SQL},
by_id AS (SELECT doc_id, page_id FROM p JOIN labels ON doc_id = url_doc)"""
CASCADE_SQL = f"""{BY_ID_SQL},
rest AS (SELECT * FROM p WHERE page_id NOT IN (SELECT page_id FROM by_id)),
pairs AS (
  SELECT doc_id, page_id FROM by_id
  UNION SELECT doc_id, page_id FROM rest JOIN documents ON doc_id = page_id)"""


def pairs_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return m.match_by_key(
        table(spark, sf, "labels"),
        pages(spark, sf),
        (F.col("doc_id"), F.col("url_doc")),
        "doc_id",
        "page_id",
    )


def cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents by the id in the URL, then documents by the page id."""
    labelled = table(spark, sf, "labels").select("doc_id", F.col("doc_id").alias("label_key"))
    documents = table(spark, sf, "documents").select("doc_id").join(labelled, "doc_id", "left")
    return m.match_cascade(
        documents,
        pages(spark, sf),
        [
            (F.col("label_key"), F.col("url_doc")),
            (F.col("doc_id"), F.col("page_id")),
        ],
        "doc_id",
        "page_id",
    )


@query("match_by_id", f"WITH {BY_ID_SQL} SELECT doc_id, page_id FROM by_id")
def match_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return pairs_by_id(spark, sf)


STORED_BUCKETS = 16


def key_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Labels and pages, each stored by its key and read back."""
    folder = scratch_dir(spark, "keys")
    write_key_table(table(spark, sf, "labels").select("doc_id"), f"{folder}/labels", F.col("doc_id"), STORED_BUCKETS)
    write_key_table(pages(spark, sf), f"{folder}/pages", F.col("url_doc"), STORED_BUCKETS)
    return read_key_table(spark, f"{folder}/labels"), read_key_table(spark, f"{folder}/pages")


@query("match_stored", f"WITH {BY_ID_SQL} SELECT doc_id, page_id FROM by_id")
def match_stored(spark: SparkSession, sf: str) -> DataFrame:
    """``match_by_id`` over stored key tables, without an exchange."""
    labels, linked = key_tables(spark, sf)
    return m.match_stored(labels, linked, "doc_id", "page_id")


@query(
    "unmatched_anti",
    f"""WITH {BY_ID_SQL} SELECT page_id, url FROM p
    WHERE page_id NOT IN (SELECT page_id FROM by_id)""",
)
def unmatched_anti(spark: SparkSession, sf: str) -> DataFrame:
    rest = m.unmatched(pages(spark, sf), pairs_by_id(spark, sf), "page_id")
    return rest.select("page_id", "url")


@query(
    "match_by_fallback",
    f"""WITH {CASCADE_SQL}
    SELECT doc_id, page_id FROM rest JOIN documents ON doc_id = page_id""",
)
def match_by_fallback(spark: SparkSession, sf: str) -> DataFrame:
    rest = m.unmatched(pages(spark, sf), pairs_by_id(spark, sf), "page_id")
    documents = table(spark, sf, "documents").select("doc_id")
    return m.match_by_key(
        documents, rest, (F.col("doc_id"), F.col("page_id")), "doc_id", "page_id"
    )


@query("match_cascade", f"WITH {CASCADE_SQL} SELECT doc_id, page_id FROM pairs")
def match_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return cascade(spark, sf)


@query(
    "match_url_join",
    f"""WITH {PAGES_SQL} SELECT page_id, doc_id, url FROM p JOIN labels ON doc_id = url_doc""",
)
def match_url_join(spark: SparkSession, sf: str) -> DataFrame:
    return m.match_url_join(
        table(spark, sf, "pages"),
        table(spark, sf, "labels"),
        page_key(),
        F.col("doc_id"),
        post_id="page_id",
        paper_id="doc_id",
        post_columns=["url"],
    )


@query(
    "three_way_match",
    f"""WITH {CASCADE_SQL}
    SELECT doc_id, page_id, event_id, value AS score FROM pairs
    JOIN events ON CAST(json_extract_string(props, '$.k') AS BIGINT) = doc_id""",
)
def three_way_match(spark: SparkSession, sf: str) -> DataFrame:
    events = m.match_url_join(
        table(spark, sf, "events").withColumnRenamed("value", "score"),
        table(spark, sf, "documents"),
        event_key(),
        F.col("doc_id"),
        post_id="event_id",
        paper_id="doc_id",
        post_columns=["score"],
    )
    return m.three_way_match(cascade(spark, sf), events, "doc_id", "event_id")


@query(
    "match_coverage",
    f"""WITH {CASCADE_SQL},
    n AS (SELECT count(*) AS pairs, (SELECT count(*) FROM documents) AS left_rows,
                 (SELECT count(*) FROM pages) AS right_rows,
                 count(DISTINCT doc_id) AS left_matched, count(DISTINCT page_id) AS right_matched
          FROM by_id)
    SELECT *, round(100.0 * left_matched / left_rows, 4) AS left_pct,
           round(100.0 * right_matched / right_rows, 4) AS right_pct FROM n""",
)
def match_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return m.match_coverage(
        table(spark, sf, "documents"),
        table(spark, sf, "pages"),
        pairs_by_id(spark, sf),
        "doc_id",
        "page_id",
    )


def order_customers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return orders, customers


ORDER_CUSTOMERS_SQL = """SELECT o_orderkey, c_custkey, c_mktsegment
    FROM orders JOIN customer ON c_custkey = o_custkey"""


@query("join_broadcast", ORDER_CUSTOMERS_SQL)
def join_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    return j.broadcast_join(*order_customers(spark, sf), ["c_custkey"])


@query("join_sort_merge", ORDER_CUSTOMERS_SQL)
def join_sort_merge(spark: SparkSession, sf: str) -> DataFrame:
    return j.sort_merge_join(*order_customers(spark, sf), ["c_custkey"])


@query(
    "join_strategy_report",
    """SELECT strategy, true AS one_operator, rows, 1 AS contents FROM (VALUES
      ('broadcast'), ('sort_merge')) v(strategy),
    (SELECT count(*) AS rows FROM orders JOIN customer ON c_custkey = o_custkey)""",
)
def join_strategies(spark: SparkSession, sf: str) -> DataFrame:
    """Same rows under both strategies. The operators are reported as found, so they depend on the sizes."""
    report = join_strategy_report(
        {
            "broadcast": join_broadcast(spark, sf),
            "sort_merge": join_sort_merge(spark, sf),
        }
    )
    contents = report.agg(F.count_distinct("content_hash").cast("int")).scalar()
    one = F.col("operator").rlike(r"^[A-Za-z]+Join$").alias("one_operator")
    return report.select("strategy", one, "rows", contents.alias("contents"))


@query(
    "left_join_fill",
    """SELECT p_partkey AS paper_id, p_name AS title,
    CAST(coalesce(s, 0) AS DOUBLE) AS score_total FROM part LEFT JOIN (
      SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
             sum(CAST(value AS DECIMAL(18,2))) AS s FROM events GROUP BY 1) ON k = p_partkey""",
)
def left_join_fill(spark: SparkSession, sf: str) -> DataFrame:
    totals = posts(spark, sf).groupBy("paper_id").agg(
        F.sum("score").cast("double").alias("score_total")
    )
    titles = papers(spark, sf).select("paper_id", "title")
    return j.left_join_fill(titles, totals, ["paper_id"], {"score_total": 0.0})
