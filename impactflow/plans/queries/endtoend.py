"""Raw lines made of the tables, through the batch jobs to gold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...session import scratch_dir
from ...sinks.versions import read_table
from ...sources import ledger
from ...sources.files import land_raw
from .. import jobs
from .registry import AS_OF, SCORED_SQL, citations, event_key, papers, query, table

RUN_AT = "2024-01-01 00:00:00"


def number(key: str | Column) -> Column:
    return F.concat(F.lit("2001."), F.lpad(F.col(key) if isinstance(key, str) else key, 9, "0"))


def doi(paper: Column) -> Column:
    return F.concat(F.lit("10.1/p"), paper.cast("string"))


def raw_sources(spark: SparkSession, sf: str, broken: bool = False) -> dict[str, DataFrame]:
    """Parts as papers, (part, supplier) counts as citation records, events as posts.

    Citation records with an even count know their paper by its DOI only. With ``broken`` some lines are cut off.
    """
    known = F.col("cited_by_count") % 2 == 1
    created = F.concat(
        F.date_format("published_date", "EEE, d MMM yyyy"), F.lit(" 12:00:00 GMT")
    )
    paper = F.struct(
        number(F.col("paper_id").cast("string")).alias("id"),
        F.concat(F.lit(" "), "title").alias("title"),
        F.lit("text").alias("abstract"),
        F.concat_ws("  ", "categories").alias("categories"),
        F.lit("2001-02-03").alias("update_date"),
        doi(F.col("paper_id")).alias("doi"),
        F.when(
            F.col("published_date").isNotNull(), F.array(F.struct(created.alias("created")))
        ).alias("versions"),
    )
    work = F.struct(
        F.concat(F.lit("W"), F.monotonically_increasing_id()).alias("id"),
        "cited_by_count",
        F.lit(2000).alias("publication_year"),
        F.when(~known, F.concat(F.lit("https://doi.org/"), F.upper(doi(F.col("paper_id"))))).alias("doi"),
        F.when(
            known,
            F.struct(
                F.concat(
                    F.lit("pmh:oai:arXiv.org:"), number(F.col("paper_id").cast("string")), F.lit("v1")
                ).alias("id")
            ),
        ).alias("primary_location"),
    )
    post = F.struct(
        F.col("event_id").alias("id"),
        F.concat(F.lit("u"), "user_id").alias("by"),
        F.lit(1720000000).alias("time"),
        F.col("event_type").alias("type"),
        F.lit("a post").alias("title"),
        F.concat(
            F.lit("https://arxiv.org/abs/"), number(event_key().cast("string"))
        ).alias("url"),
        F.col("value").alias("score"),
        F.when(F.col("event_type") != "error", 1).alias("descendants"),
    )

    def line(record: Column, cut: Column) -> Column:
        text = F.to_json(record)
        whole = ~cut if broken else F.lit(True)
        return F.when(whole, text).otherwise(F.substring(text, F.lit(1), F.length(text) - 9)).alias("value")

    return {
        "papers": papers(spark, sf).select(line(paper, F.col("paper_id") % 10 == 0)),
        "citations": citations(spark, sf).select(line(work, F.col("paper_id") % 7 == 0)),
        "posts": table(spark, sf, "events").select(line(post, F.col("event_type") == "error")),
    }


def refreshed(
    spark: SparkSession, sf: str, broken: bool = False
) -> tuple[str, dict[str, jobs.Refreshed]]:
    """Land and refresh every source; (base folder, what each refresh found)."""
    base = scratch_dir(spark, "batch")
    found = {}
    for source, lines in raw_sources(spark, sf, broken).items():
        land_raw(lines, f"{base}/raw/{source}", "20240101")
        found[source] = jobs.refresh(
            spark,
            source,
            f"{base}/raw/{source}/batch=*",
            f"{base}/silver/{source}",
            reports=f"{base}/reports",
            run_id="run-1",
            run_at=RUN_AT,
            newest="folder" if source == "citations" else None,
        )
    return base, found


@query(
    "bronze_to_gold",
    f"""WITH {SCORED_SQL} SELECT '2001.' || lpad(CAST(paper_id AS VARCHAR), 9, '0') AS paper_id,
    title, p_type || ' ' || p_brand AS categories,
    strftime(published_date, '%Y-%m-%d') AS published_date, cited_by_count,
    round(score_total, 2) AS score_total, CAST(replies_total AS DOUBLE) AS replies_total,
    round(impact_score, 2) AS impact_score FROM scored""",
)
def bronze_to_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Citations reach their papers by id and, for the rest, by DOI."""
    base, _ = refreshed(spark, sf)
    jobs.write_matches(spark, f"{base}/silver", f"{base}/matches")
    pairs = read_table(spark, f"{base}/matches/pairs")
    jobs.write_gold(spark, f"{base}/silver", f"{base}/gold", AS_OF, pairs)
    gold = read_table(spark, f"{base}/gold")
    return gold.select(
        "paper_id",
        "title",
        F.concat_ws(" ", "categories").alias("categories"),
        "published_date",
        "cited_by_count",
        F.round("score_total", 2).alias("score_total"),
        "replies_total",
        F.round("impact_score", 2).alias("impact_score"),
    )


WORKS_SQL = "SELECT l_partkey FROM lineitem GROUP BY l_partkey, l_suppkey"
VOLUMES_SQL = f"""volumes AS (
      SELECT 'papers' AS source, count(*) AS lines,
             count(*) FILTER (WHERE p_partkey % 10 = 0) AS cut FROM part
      UNION ALL SELECT 'citations', count(*), count(*) FILTER (WHERE l_partkey % 7 = 0) FROM ({WORKS_SQL})
      UNION ALL SELECT 'posts', count(*), count(*) FILTER (WHERE event_type = 'error') FROM events)"""


@query(
    "source_monitoring",
    f"""WITH {VOLUMES_SQL}, rules AS (
      SELECT 'papers' AS source, 8 AS n, (count(*) FILTER (WHERE p_name IS NULL) > 0)::INT AS bad FROM part
      UNION ALL SELECT 'citations', 7, 0
      UNION ALL SELECT 'posts', 10,
        (count(*) FILTER (WHERE event_type <> 'story') > 0)::INT
        + (count(*) FILTER (WHERE value IS NULL) > 0)::INT FROM events),
    layers AS (SELECT 'bronze' AS layer UNION ALL SELECT 'silver')
    SELECT source, layer, CAST(CASE layer WHEN 'bronze' THEN n ELSE 2 END AS INT) AS ge_evaluated,
           CAST(CASE layer WHEN 'bronze' THEN n - bad ELSE 2 END AS INT) AS ge_successful,
           lines AS rows, true AS has_files
    FROM rules JOIN volumes USING (source), layers""",
)
def source_monitoring(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of the three sources over all raw records and cleaned rows; posts have other types than
    'story'. The rows are those that the rules and the cleaned tables have."""
    base, found = refreshed(spark, sf)
    rows = []
    for source, f in found.items():
        bronze = f.results.where("rule = 'expect_lines_to_be_records'").select(F.col("rows").alias("b"))
        silver = read_table(spark, f"{base}/silver/{source}").agg(F.count("*").alias("s"))
        volume = F.when(F.col("layer") == "bronze", bronze.scalar()).otherwise(silver.scalar())
        rows.append(
            f.monitoring.select(
                "source",
                "layer",
                "ge_evaluated",
                "ge_successful",
                volume.alias("rows"),
                ((F.col("object_count") > 0) & (F.col("size_bytes") > 0)).alias("has_files"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


@query(
    "refresh_report",
    f"""WITH {VOLUMES_SQL}
    SELECT source, lines, lines - cut AS records, cut AS invalid_lines, lines - cut AS rows_in,
           lines - cut AS rows_out, 0 AS duplicates_removed, cut AS rejects, cut = 0 AS lines_pass
    FROM volumes""",
)
def refresh_report(spark: SparkSession, sf: str) -> DataFrame:
    """Sources with cut off lines: counted, set aside, and a failed rule of their own."""
    base, found = refreshed(spark, sf, broken=True)
    rows = []
    for source, f in found.items():
        rejects = spark.read.text(f"{base}/reports/rejects/suite={source}/run_id=run-1")
        on_lines = f.results.where("rule = 'expect_lines_to_be_records'")
        rows.append(
            f.report.select(
                F.lit(source).alias("source"),
                "lines",
                "records",
                "invalid_lines",
                "rows_in",
                "rows_out",
                F.col("duplicates_removed").cast("int").alias("duplicates_removed"),
                rejects.agg(F.count("*")).scalar().alias("rejects"),
                on_lines.select("success").scalar().alias("lines_pass"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


@query(
    "paper_documents",
    """SELECT '2001.' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS id, p_name AS title,
    'text' AS abstract, p_type || ' ' || p_brand AS categories, '2001-02-03' AS update_date,
    '10.1/p' || p_partkey AS doi FROM part""",
)
def paper_documents(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{scratch_dir(spark, 'documents')}"
    land_raw(raw_sources(spark, sf)["papers"], folder, "20240101")
    documents = jobs.paper_documents(jobs.papers_table(spark, f"{folder}/*"))
    return documents.withColumn("categories", F.concat_ws(" ", "categories")).select(
        "id", "title", "abstract", "categories", "update_date", "doi"
    )


LANDED = "CASE WHEN event_id % 3 = 0 THEN 'run-1' WHEN event_id % 3 = 1 THEN 'run-2' ELSE 'run-3' END"


def landings(spark: SparkSession, sf: str) -> tuple[str, list[jobs.Refreshed]]:
    """Posts in three landings, refreshed after each one by the ledger, the last time twice; a later landing has newer versions of
    the users' posts, as the id is the user's."""
    base, found = scratch_dir(spark, "landings"), []
    events = table(spark, sf, "events")
    post = F.struct(
        F.col("user_id").alias("id"),
        F.lit("u").alias("by"),
        F.lit(1720000000).alias("time"),
        F.lit("story").alias("type"),
        F.col("event_type").alias("title"),
        F.col("event_id").alias("score"),
    )
    for n in (0, 1, 2, 2):
        if n == len(found):
            part = events.where(F.col("event_id") % 3 == n).repartitionByRange(4, "event_id")
            land_raw(part.sortWithinPartitions("event_id").select(F.to_json(post).alias("value")), f"{base}/raw", f"2024010{n + 1}")
        found.append(
            jobs.refresh(
                spark, "posts", f"{base}/raw/batch=*", f"{base}/silver/posts", reports=f"{base}/reports",
                run_id=f"run-{len(found) + 1}", run_at=RUN_AT, read_before=f"{base}/ledger", buckets=8,
            )
        )
    return base, found


@query(
    "incremental_refresh",
    """SELECT user_id AS id, max_by(event_type, (event_id % 3, event_id)) AS title,
    CAST(max_by(event_id, (event_id % 3, event_id)) AS DOUBLE) AS score FROM events GROUP BY user_id""",
)
def incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Only new files are read, and merged by buckets: the last landed version of each post."""
    base, _ = landings(spark, sf)
    posts = jobs.silver_table(spark, f"{base}/silver/posts")
    return posts.select("id", "title", F.col("score").cast("double").alias("score"))


@query(
    "refresh_ledger",
    f"""SELECT {LANDED} AS run_id, true AS has_files, count(*) AS lines FROM events GROUP BY 1
    UNION ALL SELECT 'run-4', false, 0""",
)
def refresh_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Every line is read by one run only; a run without new files reads nothing."""
    base, found = landings(spark, sf)
    rows = [f.report.select(F.lit(f"run-{i}").alias("run_id"), "lines") for i, f in enumerate(found, 1)]
    entered = ledger.summary(spark, f"{base}/ledger").select("run_id", (F.col("files") > 0).alias("has_files"))
    return reduce(DataFrame.unionByName, rows).join(entered, "run_id", "left").select(
        "run_id", F.coalesce("has_files", F.lit(False)).alias("has_files"), "lines"
    )
