"""Sketches by batch, united at read. What they give is compared with exact figures: the exact columns come back, and whether
the sketch keeps its stated error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import sketches as s
from ...session import scratch_dir
from ...sinks.tables import write_parquet
from ...sources.files import scan_parquet
from .registry import SCORED_SQL, event_key, query, table
from .scoring import scored


@query(
    "signal_deciles",
    f"""WITH {SCORED_SQL} SELECT CAST(part AS INT) AS part, true AS within, count(*) AS papers, round(min(impact_score), 4) AS least
    FROM scored, range(9) t(part) GROUP BY 1""",
)
def signal_deciles(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of deciles from sketches that are stored by year and merged; each is at its rank, up to the stated error."""
    rows = scored(spark, sf)
    folder = scratch_dir(spark, "quantiles")
    write_parquet(s.quantile_sketches(rows, [F.year("published_date").alias("year")], "impact_score"), folder)
    edges = s.united_edges(scan_parquet(spark, folder), 10)
    totals = rows.agg(F.count("*").alias("papers"), F.round(F.min("impact_score"), 4).alias("least"))
    return s.rank_check(rows, "impact_score", edges).select("part", "within").join(totals, F.lit(True))


@query(
    "signal_decile_profile",
    f"""WITH {SCORED_SQL}, e AS (SELECT quantile_cont(impact_score, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM scored)
    SELECT CAST(len(list_filter(edges, lambda x: x < impact_score)) AS INT) AS part, count(*) AS papers,
           round(avg(citation_norm), 4) AS mean_citation, round(avg(community_norm), 4) AS mean_community,
           round(avg(recency_norm), 4) AS mean_recency, round(avg(impact_score), 4) AS mean_score
    FROM scored, e GROUP BY 1""",
)
def signal_decile_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The exact way: signals by real deciles of the score."""
    rows = scored(spark, sf)
    profile = s.part_profile(rows, "impact_score", s.exact_edges(rows, "impact_score", 10))
    means = ("mean_citation", "mean_community", "mean_recency", "mean_score")
    return profile.select("part", "papers", *(F.round(m, 4).alias(m) for m in means))


@query(
    "distinct_over_batches",
    """SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, true AS within FROM orders GROUP BY 1""",
)
def distinct_over_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches by month and group, united by group, next to the exact count."""
    orders = table(spark, sf, "orders")
    folder = scratch_dir(spark, "distinct")
    write_parquet(s.distinct_sketches(orders, ["o_orderpriority", F.trunc("o_orderdate", "month").alias("month")], "o_custkey"), folder)
    united = s.united_distinct(scan_parquet(spark, folder), ["o_orderpriority"])
    exact = orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"))
    return exact.join(united, "o_orderpriority").select("o_orderpriority", "customers", s.close(F.col("estimate"), F.col("customers")).alias("within"))


@query(
    "shared_keys_of_sources",
    """WITH c AS (SELECT DISTINCT l_partkey AS k FROM lineitem),
    p AS (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT (SELECT count(*) FROM c JOIN p USING (k)) AS both_exact,
           (SELECT count(*) FROM (SELECT k FROM c UNION SELECT k FROM p WHERE k IS NOT NULL)) AS either_exact,
           (SELECT count(*) FROM c WHERE k NOT IN (SELECT k FROM p WHERE k IS NOT NULL)) AS only_first_exact, true AS within""",
)
def shared_keys_of_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Papers with citations, with posts, with both: set operations on sketches, next to exact ones."""
    cited = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), F.trunc("l_shipdate", "year").alias("batch"))
    talked = table(spark, sf, "events").select(event_key().alias("k"), F.trunc("ts", "month").alias("batch")).where("k IS NOT NULL")
    folders = []
    for name, df in (("cited", cited), ("talked", talked)):
        folders.append(scratch_dir(spark, name))
        write_parquet(s.distinct_sketches(df, ["batch"], "k"), folders[-1])
    estimates = s.set_estimates(*(scan_parquet(spark, f) for f in folders))
    sides = cited.select("k", F.lit(1).alias("c"), F.lit(0).alias("p")).union(talked.select("k", F.lit(0), F.lit(1)))
    by_key = sides.groupBy("k").agg(F.max("c").alias("c"), F.max("p").alias("p"))
    exact = by_key.agg(
        F.count_if((F.col("c") == 1) & (F.col("p") == 1)).alias("both_exact"),
        F.count("*").alias("either_exact"),
        F.count_if(F.col("p") == 0).alias("only_first_exact"),
    )
    within = F.lit(True)
    for n in ("both", "either", "only_first"):
        # The error of a set operation is relative to the union.
        within = within & (F.abs(F.col(n) - F.col(f"{n}_exact")) <= F.greatest(F.lit(1.0), F.col("either_exact") * s.DISTINCT_ERROR))
    return exact.join(estimates, F.lit(True)).select("both_exact", "either_exact", "only_first_exact", within.alias("within"))
