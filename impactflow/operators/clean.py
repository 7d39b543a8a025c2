"""Row filters, deduplication and the three record cleaners."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..sources.jsonl import ARRIVAL, CITATION_FIELDS, PAPER_FIELDS, POST_FIELDS


def project_existing(
    df: DataFrame, fields: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Exactly ``fields`` in order; absent ones become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f"`{n}`") if n in have else F.lit(None).cast(t).alias(n)
            for n, t in fields.items()
        ],
        *[k for k in keep if k in have],
    )


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is NULL or blank."""
    col = F.col(f"`{key}`")
    if dict(df.dtypes)[key] == "string":
        return df.where(col.isNotNull() & (c.strip(col) != ""))
    return df.where(col.isNotNull())


def filter_nonblank(df: DataFrame, text: str) -> DataFrame:
    col = F.col(text)
    return df.where(col.isNotNull() & (F.length(F.trim(col)) > 0))


def _first_row(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_keep_last(
    df: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key over the whole table; the highest ``order`` wins.

    ``order`` should be unique within a key, or the survivor is arbitrary.
    Every map task keeps one row per key before the shuffle (WindowGroupLimit).
    """
    return _first_row(df, key, [F.desc_nulls_last(o) for o in order])


def dedup_keep_first(
    df: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key over the whole table; the lowest ``order`` wins."""
    return _first_row(df, key, [F.asc_nulls_last(o) for o in order])


def clean_papers(df: DataFrame) -> DataFrame:
    """Paper records -> stripped text, category list, dates; rows without id dropped.

    Optional text becomes '' when missing. ``arrival`` is passed through for
    the deduplication that follows.
    """
    raw = require_key(project_existing(df, PAPER_FIELDS, [ARRIVAL]), "id")
    text = [n for n in PAPER_FIELDS if n not in ("id", "categories", "update_date", "versions")]
    return raw.select(
        c.strip(F.col("id")).alias("id"),
        *[c.clean_text(F.col(f"`{n}`")).alias(n) for n in text],
        c.split_categories("categories").alias("categories"),
        c.parse_iso_date("update_date").alias("update_date"),
        c.parse_rfc_date(c.first_version_created("versions")).alias("published_date"),
        *[k for k in (ARRIVAL,) if k in raw.columns],
    )


def clean_posts(df: DataFrame) -> DataFrame:
    """Post records -> typed columns; usable on batch and streaming frames alike.

    ``event_time`` is the timestamp behind the ISO ``time`` string.
    """
    raw = require_key(project_existing(df, POST_FIELDS, [ARRIVAL]), "id")
    return raw.select(
        "id",
        c.clean_text("by").alias("by"),
        c.epoch_to_iso("time").alias("time"),
        c.epoch_to_timestamp("time").alias("event_time"),
        *[c.clean_text(n).alias(n) for n in ("type", "title", "url", "text")],
        *[c.to_number(n).alias(n) for n in ("score", "descendants")],
        c.default_empty_array("kids").alias("kids"),
        *[k for k in (ARRIVAL,) if k in raw.columns],
    )


def clean_citations(df: DataFrame) -> DataFrame:
    """Citation records -> normalised DOI and paper id, counts as longs."""
    raw = project_existing(df, CITATION_FIELDS, [ARRIVAL])
    return raw.select(
        F.col("id").alias("citation_id"),
        c.normalize_doi("doi").alias("doi"),
        c.id_from_location(F.col("primary_location.id")).alias("paper_id"),
        c.clean_text("title").alias("title"),
        "publication_year",
        c.parse_iso_date("publication_date").alias("publication_date"),
        c.to_count("cited_by_count").alias("cited_by_count"),
        "counts_by_year",
        c.to_count("referenced_works_count").alias("referenced_works_count"),
        c.fill_default("type", "unknown").alias("type"),
        *[k for k in (ARRIVAL,) if k in raw.columns],
    )


def cleaning_report(
    before: DataFrame,
    after: DataFrame,
    *,
    dates: Sequence[str] = (),
    coverage: Sequence[str] = (),
) -> DataFrame:
    """One row: rows in and out, removed duplicates, unparsable dates, coverage %.

    ``before`` is the cleaned but not yet deduplicated table, so the dropped
    rows are the duplicates.
    """
    total = F.count("*")
    return (
        after.agg(
            total.alias("rows_out"),
            *[F.count_if(F.col(d).isNull()).alias(f"null_{d}") for d in dates],
            *[
                F.round(F.try_divide(F.count(k) * F.lit(100.0), total), 2).alias(f"{k}_pct")
                for k in coverage
            ],
        )
        .withColumn("rows_in", before.agg(F.count("*")).scalar())
        .withColumn("duplicates_removed", F.col("rows_in") - F.col("rows_out"))
    )


def observed_report(
    spark: SparkSession,
    seen: Mapping[str, int],
    rows_in: int,
    *,
    dates: Sequence[str] = (),
    coverage: Sequence[str] = (),
) -> DataFrame:
    """The row of ``cleaning_report``, from what ``observe_cleaning`` saw during the write."""
    counts = [rows_in, seen["rows"], *(seen[f"null_{d}"] for d in dates), *(seen[f"with_{k}"] for k in coverage)]
    names = ["rows_in", "rows_out", *(f"null_{d}" for d in dates), *(f"with_{k}" for k in coverage)]
    one = spark.createDataFrame([tuple(counts)], ", ".join(f"`{n}` bigint" for n in names))
    pct = [F.round(F.try_divide(F.col(f"with_{k}") * F.lit(100.0), "rows_out"), 2).alias(f"{k}_pct") for k in coverage]
    removed = (F.col("rows_in") - F.col("rows_out")).alias("duplicates_removed")
    return one.select("rows_out", *(f"null_{d}" for d in dates), *pct, "rows_in", removed)


def observe_cleaning(
    df: DataFrame, name: str, *, dates: Sequence[str] = (), coverage: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """Collect row counts while ``df`` is being written, without another pass.

    ``df`` must be what is written: below a shuffle a task that runs again would count twice.
    """
    seen = Observation(name)
    return (
        df.observe(
            seen,
            F.count("*").alias("rows"),
            *[F.count_if(F.col(d).isNull()).alias(f"null_{d}") for d in dates],
            *[F.count(k).alias(f"with_{k}") for k in coverage],
        ),
        seen,
    )
