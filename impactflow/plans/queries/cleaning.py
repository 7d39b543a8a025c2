"""Projection, cleaning and normalising expressions over raw values made of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import columns as c
from ...operators import clean as k
from ...session import scratch_dir
from ...sources import files, jsonl
from .registry import documents, query, table

# The stripped characters, usable inside a SQL string literal.
WS = c.WHITESPACE


@query(
    "project_existing",
    "SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_rating FROM customer",
)
def project_existing(spark: SparkSession, sf: str) -> DataFrame:
    fields = {"c_custkey": "bigint", "c_name": "string", "c_rating": "double"}
    return k.project_existing(table(spark, sf, "customer"), fields)


@query(
    "clean_text",
    r"""SELECT doc_id, length(t) AS chars, md5(t) AS digest FROM (
      SELECT doc_id, regexp_replace(CASE WHEN lang = 'de' THEN '' ELSE text END,
                                    '^[\s\x0b]+|[\s\x0b]+$', '', 'g') AS t
      FROM documents)""",
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts, padded with all kinds of white space; German ones are NULL."""
    raw = F.concat(F.lit(WS), "text", F.lit(" \t\n"))
    text = c.clean_text(F.when(F.col("lang") != "de", raw))
    return (
        documents(spark, sf)
        .select("doc_id", text.alias("t"))
        .select("doc_id", F.length("t").cast("bigint").alias("chars"), F.md5("t").alias("digest"))
    )


@query(
    "split_categories",
    """SELECT p_partkey, unnest([p_type, p_brand]) AS category FROM part WHERE p_size >= 5""",
)
def split_categories(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("  "), "p_type", F.lit(" \t\n"), "p_brand", F.lit(" "))
    parts = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") >= 5, raw).otherwise(" ").alias("raw")
    )
    return parts.select("p_partkey", F.explode(c.split_categories("raw")).alias("category"))


def versioned_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a version list (none for 'O', empty for 'P') of RFC dates."""
    created = F.concat(
        F.date_format("o_orderdate", "EEE, d MMM yyyy"),
        F.when(F.col("o_orderpriority") == "5-LOW", " 23:30:00 -0500").otherwise(
            " 19:18:42 GMT"
        ),
    )
    versions = F.array(
        F.struct(F.lit("v1").alias("version"), created.alias("created")),
        F.struct(F.lit("v2").alias("version"), F.lit("Tue, 1 Jan 2030 00:00:00 GMT").alias("created")),
    )
    empty = F.array().cast("array<struct<version:string,created:string>>")
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "F", versions).when(status == "P", empty).alias("versions"),
        created.alias("created"),
        "o_orderpriority",
    )


@query(
    "first_version_created",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN
      strftime(o_orderdate, '%a, %-d %b %Y') || CASE WHEN o_orderpriority = '5-LOW'
        THEN ' 23:30:00 -0500' ELSE ' 19:18:42 GMT' END END AS created FROM orders""",
)
def first_version_created(spark: SparkSession, sf: str) -> DataFrame:
    return versioned_orders(spark, sf).select(
        "o_orderkey", c.first_version_created("versions").alias("created")
    )


@query(
    "parse_rfc_date",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL
      WHEN '5-LOW' THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d')
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def parse_rfc_date(spark: SparkSession, sf: str) -> DataFrame:
    """An evening at -05:00 is the next day in UTC; urgent orders carry garbage."""
    raw = F.when(F.col("o_orderpriority") == "1-URGENT", "not a date").otherwise(F.col("created"))
    day = c.parse_rfc_date(raw)
    return versioned_orders(spark, sf).select("o_orderkey", c.iso_date(day).alias("day"))


@query(
    "parse_iso_date",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN NULL
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def parse_iso_date(spark: SparkSession, sf: str) -> DataFrame:
    good = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(good, F.lit("?"))).otherwise(good)
    return table(spark, sf, "orders").select(
        "o_orderkey", c.iso_date(c.parse_iso_date(raw)).alias("day")
    )


def event_seconds() -> Column:
    return F.unix_seconds(F.col("ts").cast("timestamp"))


@query(
    "epoch_to_iso",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
      ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') END AS time FROM events""",
)
def epoch_to_iso(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", "soon").otherwise(
        event_seconds().cast("string")
    )
    return table(spark, sf, "events").select("event_id", c.epoch_to_iso(raw).alias("time"))


@query(
    "require_key",
    """SELECT CAST(event_id AS VARCHAR) AS key FROM events
    WHERE event_type NOT IN ('error', 'view')""",
)
def require_key(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    keys = table(spark, sf, "events").select(
        F.when(kind == "error", " \t")
        .when(kind != "view", F.col("event_id").cast("string"))
        .alias("key")
    )
    return k.require_key(keys, "key")


def _dedup_sql(direction: str) -> str:
    return f"""SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts {direction}, event_id {direction}) = 1"""


@query("dedup_keep_last", _dedup_sql("DESC"))
def dedup_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").drop("props")
    return k.dedup_keep_last(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("dedup_keep_first", _dedup_sql("ASC"))
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").drop("props")
    return k.dedup_keep_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "coerce_numeric",
    """SELECT event_id, coalesce(number, 0) AS number, CAST(coalesce(trunc(number), 0) AS BIGINT)
      AS whole FROM (SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL
        WHEN 'click' THEN user_id ELSE value END AS number FROM events)""",
)
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    raw = (
        F.when(kind == "error", "x")
        .when(kind == "click", F.col("user_id").cast("string"))
        .when(kind != "view", F.col("value").cast("string"))
    )
    return table(spark, sf, "events").select(
        "event_id", c.to_number(raw).alias("number"), c.to_count(raw).alias("whole")
    )


@query(
    "default_empty_array",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 0 ELSE 2 END AS kids,
    CASE WHEN event_type = 'view' THEN 0 ELSE event_id + user_id END AS total FROM events""",
)
def default_empty_array(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") != "view", F.array("event_id", "user_id"))
    events = table(spark, sf, "events").select("event_id", c.default_empty_array(raw).alias("k"))
    total = F.aggregate("k", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return events.select("event_id", F.size("k").alias("kids"), total.alias("total"))


@query(
    "fill_default",
    """SELECT event_id, coalesce(nullif(event_type, 'error'), 'unknown') AS type FROM events""",
)
def fill_default(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return table(spark, sf, "events").select(
        "event_id", c.fill_default(kind, "unknown").alias("type")
    )


def raw_doi() -> Column:
    """A DOI per part in all the ways it is written; blank for size 1."""
    size = F.col("p_size")
    prefix = (
        F.when(size < 10, " https://doi.org/")
        .when(size < 20, "http://doi.org/")
        .when(size < 30, "HTTPS://DX.DOI.ORG/")
        .when(size < 40, "doi:")
        .otherwise("http://dx.doi.org/ ")
    )
    doi = F.concat(prefix, F.lit("10.1234/"), F.upper("p_type"), F.lit("."), "p_partkey")
    return F.when(size == 1, "  \t").otherwise(doi)


@query(
    "normalize_doi",
    """SELECT p_partkey, CASE WHEN p_size <> 1 THEN '10.1234/' || lower(p_type) || '.' || p_partkey
    END AS doi FROM part""",
)
def normalize_doi(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", c.normalize_doi(raw_doi()).alias("doi"))


def paper_number() -> Column:
    """An id of the form 2001.00042."""
    return F.concat(
        F.format_string("20%02d", F.col("p_size")), F.lit("."), F.format_string("%05d", "p_partkey")
    )


PAPER_NUMBER_SQL = "printf('20%02d', p_size) || '.' || printf('%05d', p_partkey)"


@query(
    "id_from_location",
    f"""SELECT p_partkey, CASE WHEN p_type <> 'SMALL' AND p_size > 1 THEN {PAPER_NUMBER_SQL}
    END AS paper_id FROM part""",
)
def id_from_location(spark: SparkSession, sf: str) -> DataFrame:
    """With version suffix, without, empty after the marker, and another archive."""
    size = F.col("p_size")
    tail = (
        F.when(size == 1, " ")
        .when(size < 20, F.concat(paper_number(), F.lit("V2 ")))
        .otherwise(paper_number())
    )
    raw = F.when(F.col("p_type") == "SMALL", F.concat(F.lit("pmh:other.org:"), tail)).otherwise(
        F.concat(F.lit("pmh:oai:arXiv.org:"), tail)
    )
    return table(spark, sf, "part").select("p_partkey", c.id_from_location(raw).alias("paper_id"))


def paper_url() -> Column:
    size = F.col("p_size")
    return (
        F.when(size < 10, F.concat(F.lit("https://arxiv.org/abs/"), paper_number()))
        .when(size < 20, F.concat(F.lit("https://arxiv.org/pdf/"), paper_number(), F.lit(".pdf")))
        .when(
            size < 30,
            F.concat(F.lit("http://arxiv.org/pdf/"), paper_number(), F.lit("v3.pdf?x=1#p")),
        )
        .when(size < 40, F.concat(F.lit("https://arxiv.org/abs/CS/"), "p_partkey", F.lit("/")))
        .otherwise(F.concat(F.lit("https://example.com/abs/"), "p_partkey"))
    )


@query(
    "id_from_url",
    f"""SELECT p_partkey, CASE WHEN p_size < 30 THEN {PAPER_NUMBER_SQL}
      WHEN p_size < 40 THEN 'cs/' || p_partkey || '/' END AS paper_id,
    CASE WHEN p_size < 30 THEN {PAPER_NUMBER_SQL}
      WHEN p_size < 40 THEN 'cs/' || p_partkey END AS paper_id_no_slash FROM part""",
)
def id_from_url(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        c.id_from_url(paper_url()).alias("paper_id"),
        c.id_from_url(paper_url(), strip_slash=True).alias("paper_id_no_slash"),
    )


@query("normalize_key", "SELECT c_custkey, lower(c_name) AS key FROM customer")
def normalize_key(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("  "), F.upper("c_name"), F.lit(" "))
    return table(spark, sf, "customer").select("c_custkey", c.normalize_key(raw).alias("key"))


@query(
    "null_normalize",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events",
)
def null_normalize(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", c.null_normalize(raw).alias("value"))


@query(
    "filter_nonblank",
    "SELECT doc_id, length(text) AS chars FROM documents WHERE lang NOT IN ('fr', 'de')",
)
def filter_nonblank(spark: SparkSession, sf: str) -> DataFrame:
    lang = F.col("lang")
    texts = documents(spark, sf).select(
        "doc_id", F.when(lang == "fr", "   ").when(lang != "de", F.col("text")).alias("text")
    )
    kept = k.filter_nonblank(texts, "text")
    return kept.select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query(
    "ignore_above",
    "SELECT doc_id, CASE WHEN length(text) <= 512 THEN md5(text) END AS digest FROM documents",
)
def ignore_above(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id", F.md5(c.ignore_above("text", 512)).alias("digest")
    )


# -- whole records through the cleaners ----------------------------------------


def raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw post lines: one id per user and type, so ids repeat by design."""
    kind = F.col("event_type")
    quoted = F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))
    return table(spark, sf, "events").select(
        "event_id",
        F.concat(
            F.lit('{"id":'),
            F.col("user_id") * 1000 + F.ascii(kind),
            F.lit(',"by":" u'),
            "user_id",
            F.lit('\\n","time":'),
            F.when(kind == "signup", F.lit("null")).otherwise(event_seconds().cast("string")),
            F.lit(',"type":"story","title":"'),
            kind,
            F.lit('","score":'),
            F.when(kind == "view", F.lit('"x"'))
            .when(kind == "click", quoted)
            .otherwise(F.col("value").cast("string")),
            F.when(kind == "purchase", F.lit(',"kids":[1,2,3]')).otherwise(""),
            F.when(kind == "error", "").otherwise("}"),
        ).alias("value"),
    )


def post_scan(spark: SparkSession, sf: str) -> jsonl.JsonlScan:
    """The raw posts with their event id as arrival order."""
    lines = raw_posts(spark, sf).withColumnRenamed("event_id", jsonl.ARRIVAL)
    return jsonl.parse_lines(lines, jsonl.POST_FIELDS)


POSTS_CLEAN_SQL = """last AS (
  SELECT * FROM events WHERE event_type <> 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)"""


@query(
    "clean_posts",
    f"""WITH {POSTS_CLEAN_SQL}
    SELECT user_id * 1000 + ascii(event_type) AS id, 'u' || user_id AS "by",
      CASE WHEN event_type <> 'signup'
        THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') END AS time,
      'story' AS type, event_type AS title, '' AS url, '' AS text,
      CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS score, CAST(0 AS DOUBLE) AS descendants,
      CASE WHEN event_type = 'purchase' THEN 3 ELSE 0 END AS kids FROM last""",
)
def clean_posts(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = k.clean_posts(post_scan(spark, sf).records)
    return (
        k.dedup_keep_last(cleaned, ["id"], [jsonl.ARRIVAL])
        .withColumn("kids", F.size("kids"))
        .drop(jsonl.ARRIVAL, "event_time")
    )


@query(
    "cleaning_report",
    f"""WITH {POSTS_CLEAN_SQL},
    n AS (SELECT count(*) AS rows_out, count(*) FILTER (WHERE event_type = 'signup') AS null_time
          FROM last)
    SELECT rows_out, null_time, round(100.0 * (rows_out - null_time) / rows_out, 2) AS time_pct,
      (SELECT count(*) FROM events WHERE event_type <> 'error') AS rows_in,
      (SELECT count(*) FROM events WHERE event_type <> 'error') - rows_out AS duplicates_removed,
      (SELECT count(*) FROM events WHERE event_type = 'error') AS invalid_lines FROM n""",
)
def cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    scan = post_scan(spark, sf)
    cleaned = k.clean_posts(scan.records)
    after = k.dedup_keep_last(cleaned, ["id"], [jsonl.ARRIVAL])
    report = k.cleaning_report(cleaned, after, dates=["time"], coverage=["time"])
    return report.withColumn("invalid_lines", scan.report.select("invalid_lines").scalar())


def raw_papers(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as raw paper lines, each twice: an old record and a newer one."""
    record = F.to_json(
        F.struct(
            F.concat(F.lit(" "), paper_number(), F.lit(" ")).alias("id"),
            F.concat(F.lit("\t "), "p_name", F.lit(" \n"), "revision").alias("title"),
            F.concat("p_type", F.lit("   "), "p_brand").alias("categories"),
            F.when(F.col("p_size") < 25, "2001-02-03").otherwise("soon").alias("update_date"),
            raw_doi().alias("doi"),
            F.lit(" J. 1 ").alias("journal-ref"),
            F.array(
                F.struct(
                    F.lit("v1").alias("version"),
                    F.lit("Mon, 2 Apr 2007 19:18:42 GMT").alias("created"),
                )
            ).alias("versions"),
        )
    )
    # Few bytes and much work a row: the file's own splits would leave it to a few tasks.
    parts = table(spark, sf, "part").repartition("p_partkey")
    both = parts.withColumn("revision", F.explode(F.array(F.lit(1), F.lit(2))))
    return both.select(record.alias("value"), F.col("revision").alias(jsonl.ARRIVAL))


@query(
    "clean_papers",
    f"""SELECT {PAPER_NUMBER_SQL} AS id, p_name || ' ' || chr(10) || '2' AS title, '' AS abstract,
      '' AS authors, p_type || ' ' || p_brand AS categories,
      CASE WHEN p_size < 25 THEN '2001-02-03' END AS update_date, '2007-04-02' AS published_date,
      'J. 1' AS "journal-ref", '' AS comments, '' AS license,
      CASE WHEN p_size <> 1 THEN '10.1234/' || lower(p_type) || '.' || p_partkey END AS doi
    FROM part""",
)
def clean_papers(spark: SparkSession, sf: str) -> DataFrame:
    records = jsonl.parse_lines(raw_papers(spark, sf), jsonl.PAPER_FIELDS).records
    last = k.dedup_keep_last(k.clean_papers(records), ["id"], [jsonl.ARRIVAL])
    return last.drop(jsonl.ARRIVAL).withColumns(
        {
            "categories": F.concat_ws(" ", "categories"),
            "update_date": c.iso_date("update_date"),
            "published_date": c.iso_date("published_date"),
            "doi": c.normalize_doi("doi"),
        }
    )


@query(
    "clean_citations",
    f"""WITH y AS (SELECT l_partkey, count(DISTINCT year(l_shipdate)) AS years, count(*) AS n
                  FROM lineitem GROUP BY 1)
    SELECT 'W' || p_partkey AS citation_id,
      CASE WHEN p_size <> 1 THEN '10.1234/' || lower(p_type) || '.' || p_partkey END AS doi,
      {PAPER_NUMBER_SQL} AS paper_id, p_name AS title, CAST(2000 AS BIGINT) AS publication_year,
      CASE WHEN p_size < 25 THEN '2000-05-06' END AS publication_date,
      CASE WHEN p_size < 25 THEN n ELSE 0 END AS cited_by_count, years,
      CAST(0 AS BIGINT) AS referenced_works_count,
      CASE WHEN p_type = 'SMALL' THEN 'unknown' ELSE 'article' END AS type
    FROM part JOIN y ON l_partkey = p_partkey""",
)
def clean_citations(spark: SparkSession, sf: str) -> DataFrame:
    """Raw citation lines landed, read back by snapshot, cleaned, first record kept."""
    yearly = (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey", F.year("l_shipdate").alias("year"))
        .agg(F.count("*").alias("n"))
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.sum("n").alias("n"),
            F.collect_list(F.struct("year", F.col("n").alias("cited_by_count"))).alias("counts"),
        )
    )
    early = F.col("p_size") < 25
    record = F.to_json(
        F.struct(
            F.concat(F.lit("W"), "p_partkey").alias("id"),
            raw_doi().alias("doi"),
            F.concat(F.lit(" "), "p_name").alias("title"),
            F.lit(2000).alias("publication_year"),
            F.when(early, "2000-05-06").otherwise("2000-13-01").alias("publication_date"),
            F.when(early, F.col("n").cast("string")).otherwise("abc").alias("cited_by_count"),
            F.col("counts").alias("counts_by_year"),
            F.when(F.col("p_type") != "SMALL", "article").alias("type"),
            F.struct(
                F.concat(F.lit("pmh:oai:arXiv.org:"), paper_number(), F.lit("v2")).alias("id")
            ).alias("primary_location"),
        )
    )
    folder = scratch_dir(spark, "citations")
    files.land_raw(
        table(spark, sf, "part").join(yearly, "p_partkey").select(record.alias("value")),
        folder,
        "20240101",
    )
    newest = files.latest_snapshot(spark, f"{folder}/batch=*", folders=True)
    records = jsonl.scan_jsonl(spark, newest, jsonl.CITATION_FIELDS).records
    first = k.dedup_keep_first(k.clean_citations(records), ["citation_id"], [jsonl.ARRIVAL])
    return first.withColumns(
        {
            "publication_date": c.iso_date("publication_date"),
            "years": F.size("counts_by_year").cast("bigint"),
        }
    ).drop(jsonl.ARRIVAL, "counts_by_year")
