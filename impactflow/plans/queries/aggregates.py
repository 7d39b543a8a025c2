"""Counts, frequencies, profiles, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import profile as p
from .registry import documents, query, table


@query(
    "count_distinct_by_group",
    """SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS year,
    count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1, 2""",
)
def count_distinct_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", F.year("o_orderdate").alias("year"))
        .agg(F.count_distinct("o_custkey").alias("customers"))
    )


@query(
    "distinct_key_count",
    "SELECT count(DISTINCT l_orderkey) AS distinct_keys FROM lineitem",
)
def distinct_key_count(spark: SparkSession, sf: str) -> DataFrame:
    return p.distinct_key_count(table(spark, sf, "lineitem"), "l_orderkey")


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return p.row_count(table(spark, sf, "lineitem"))


@query(
    "value_frequencies",
    """SELECT token AS value, count(*) AS n FROM (
      SELECT unnest(string_split_regex(text, '\\s+')) AS token FROM documents)
    WHERE token <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT 15""",
)
def value_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return p.token_frequencies(documents(spark, sf), F.col("text"), top=15)


@query(
    "value_frequencies_missing",
    """SELECT coalesce(nullif(event_type, 'error'), 'missing') AS value, count(*) AS n
    FROM events GROUP BY 1""",
)
def value_frequencies_missing(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return p.value_frequencies(table(spark, sf, "events"), kind, missing="missing")


def sparse_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels: gaps of every kind."""
    return (
        documents(spark, sf)
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .select(
            "doc_id",
            F.when(F.col("lang") != "fr", F.col("text"))
            .otherwise(F.lit(" \n"))
            .alias("text"),
            F.when(F.col("lang") != "de", F.col("source")).otherwise("").alias("source"),
            "quality",
            F.when(F.col("toxic") == 0, F.array("toxic"))
            .when(F.col("toxic") == 1, F.array().cast("array<int>"))
            .alias("flags"),
        )
    )


SPARSE_SQL = """sparse AS (
  SELECT doc_id, CASE WHEN lang <> 'fr' THEN text ELSE ' ' || chr(10) END AS text,
         CASE WHEN lang <> 'de' THEN source ELSE '' END AS source, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id))"""


def _missing_sql(conditions: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{field}' AS field, count(*) AS rows, count(*) FILTER (WHERE {cond}) AS missing,
        round(100.0 * count(*) FILTER (WHERE {cond}) / count(*), 2) AS missing_pct FROM sparse"""
        for field, cond in conditions.items()
    ]
    return f"WITH {SPARSE_SQL} " + " UNION ALL ".join(parts)


@query(
    "null_profile",
    _missing_sql(
        {
            "doc_id": "doc_id IS NULL",
            "text": "coalesce(text, '') = ''",
            "source": "coalesce(source, '') = ''",
            "quality": "quality IS NULL",
            "flags": "coalesce(toxic, 1) = 1",
        }
    ),
)
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return p.null_profile(sparse_documents(spark, sf), policy=p.EMPTY)


@query(
    "null_profile_blank",
    _missing_sql(
        {
            "doc_id": "doc_id IS NULL",
            "text": "text IS NULL OR NOT regexp_matches(text, '\\S')",
            "source": "coalesce(source, '') = ''",
            "quality": "quality IS NULL",
            "flags": "toxic IS NULL",
        }
    ),
)
def null_profile_blank(spark: SparkSession, sf: str) -> DataFrame:
    return p.null_profile(sparse_documents(spark, sf), policy=p.BLANK)


@query(
    "coverage_pct",
    f"""WITH {SPARSE_SQL},
    u AS (SELECT 'source' AS field, count(*) AS rows, count(nullif(source, '')) AS present
          FROM sparse
          UNION ALL SELECT 'quality', count(*), count(quality) FROM sparse)
    SELECT field, rows, present, round(100.0 * present / rows, 2) AS coverage_pct FROM u""",
)
def coverage_pct(spark: SparkSession, sf: str) -> DataFrame:
    return p.coverage_pct(sparse_documents(spark, sf), ["source", "quality"])


@query(
    "field_presence_types",
    """WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
    f AS (
      SELECT 'event_id' AS field, 'BIGINT' AS kind, false AS empty, false AS blank FROM e
      UNION ALL
      SELECT 'user', CASE WHEN event_type = 'view' THEN 'STRING' ELSE 'BIGINT' END, false, false
      FROM e WHERE event_type <> 'error'
      UNION ALL
      SELECT 'tags', 'ARRAY', event_type = 'click', false FROM e
      UNION ALL
      SELECT 'kind', 'STRING', event_type = 'click', event_type = 'click' FROM e
      UNION ALL
      SELECT 'nested', 'OBJECT', false, false FROM e WHERE k < 50)
    SELECT field, count(*) AS present, count(*) FILTER (WHERE empty) AS empty,
           count(*) FILTER (WHERE blank) AS null_or_empty_string,
           string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds,
           (SELECT count(*) FROM events) - count(*) AS absent
    FROM f GROUP BY field""",
)
def field_presence_types(spark: SparkSession, sf: str) -> DataFrame:
    kind, key = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    quoted = F.when(kind == "view", F.concat(F.lit('"u'), "user_id", F.lit('"'))).otherwise(
        F.col("user_id").cast("string")
    )
    lines = table(spark, sf, "events").select(
        F.concat(
            F.when(key % 5 == 0, F.lit('{"event_id":"x","event_id":')).otherwise(F.lit('{"event_id":')),
            "event_id",
            F.when(kind != "error", F.concat(F.lit(',"user":'), quoted)).otherwise(""),
            F.when(kind == "click", F.lit(',"tags":[],"kind":""')).otherwise(
                F.concat(F.lit(',"tags":[1],"kind":"'), kind, F.lit('"'))
            ),
            F.when(key < 50, F.concat(F.lit(',"nested":'), "props")).otherwise(""),
            F.lit("}"),
        ).alias("value")
    )
    return p.json_field_profile(lines).withColumn("kinds", F.concat_ws(",", "kinds"))


@query(
    "duplicate_rows",
    """SELECT count(text) AS keyed_rows, count(DISTINCT text) AS distinct_keys,
    count(text) - count(DISTINCT text) AS excess_rows FROM documents""",
)
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    # A digest stands for the text, so the shuffle does not carry whole texts.
    return p.duplicate_rows(documents(spark, sf), F.sha2("text", 256))


@query(
    "duplicate_keys",
    """SELECT count(*) AS repeated_keys FROM (
    SELECT text FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""",
)
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return p.duplicate_keys(documents(spark, sf), F.sha2("text", 256))


@query(
    "domain_profile",
    """WITH r AS (
      SELECT CASE WHEN event_type = 'error' THEN '  ' ELSE event_type END AS title,
             CASE WHEN event_type = 'view' THEN -value ELSE value END AS n,
             CASE event_type WHEN 'click' THEN 'n/a' WHEN 'signup' THEN NULL
               ELSE CAST(year(ts) + user_id AS VARCHAR) END AS year FROM events)
    SELECT count(*) AS rows, count(*) FILTER (WHERE trim(title) = '') AS missing_title,
           count(*) FILTER (WHERE year IS NULL) AS missing_year,
           count(*) FILTER (WHERE n < 0) AS negative_n,
           count(*) FILTER (WHERE year = 'n/a') AS non_integer_year,
           min(TRY_CAST(year AS BIGINT)) AS min_year, max(TRY_CAST(year AS BIGINT)) AS max_year
    FROM r""",
)
def domain_profile(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    records = table(spark, sf, "events").select(
        F.when(kind == "error", "  ").otherwise(kind).alias("title"),
        F.when(kind == "view", -F.col("value")).otherwise(F.col("value")).alias("n"),
        F.when(kind == "click", "n/a")
        .when(kind != "signup", (F.year("ts") + F.col("user_id")).cast("string"))
        .alias("year"),
    )
    return p.domain_profile(
        records, required=["title", "year"], non_negative=["n"], integer=["year"]
    )
