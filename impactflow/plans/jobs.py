"""The batch and streaming jobs, as functions and as a spark-submit entry point.

    python -m impactflow.plans.jobs papers    <raw glob> <silver>/papers --reports <folder> --run-id 1 --run-at <time>
    python -m impactflow.plans.jobs posts     <raw glob> <silver>/posts --ledger <folder> --buckets 64 --reports ...
    python -m impactflow.plans.jobs retire    <table> <time>
    python -m impactflow.plans.jobs matches   <silver> <target>
    python -m impactflow.plans.jobs gold      <silver> <gold> --as-of 2026-01-01 [--pairs <target>/pairs]
    python -m impactflow.plans.jobs temporal  <silver> <target>
    python -m impactflow.plans.jobs terms     <silver> <target>
    python -m impactflow.plans.jobs documents <silver> <changes> --batch 1
    python -m impactflow.plans.jobs compact   <changes> <key>
    python -m impactflow.plans.jobs stream    <raw folder> <target> --checkpoint <folder> --state-partitions 64
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import columns as c
from ..operators import clean, expect, marts, matching, scoring, temporal, terms
from ..session import builder, remove_dir, scratch_dir
from ..sinks.contract import PAPER_DOCUMENT, PAPER_KEYWORD_LIMITS
from ..sinks.tables import append_changes, compact, keyed_overwrite, part_report, rebuild, write_parquet
from ..sinks.versions import create_bucketed, part_folders, read_bucketed, read_table, resolve, retire, upsert_buckets
from ..sources import jsonl, ledger
from ..sources.files import input_inventory, inventory_of, latest_snapshot, scan_parquet
from ..streaming import exact
from ..streaming import posts as stream


@dataclass(frozen=True)
class Source:
    """How records of a source become its table."""

    fields: Mapping[str, str]
    clean: Callable[[DataFrame], DataFrame]
    key: str
    dedup: Callable[..., DataFrame]
    dates: tuple[str, ...]
    coverage: tuple[str, ...]

    def cleaned(self, records: DataFrame) -> DataFrame:
        return self.clean(records)

    def arrived(self, records: DataFrame) -> DataFrame:
        """One row per key over the whole input, with its arrival."""
        return self.dedup(self.cleaned(records), [self.key], [jsonl.ARRIVAL])

    def table(self, records: DataFrame) -> DataFrame:
        """One row per key over the whole input."""
        return self.arrived(records).drop(jsonl.ARRIVAL)


SOURCES = {
    "papers": Source(
        jsonl.PAPER_FIELDS, clean.clean_papers, "id", clean.dedup_keep_last,
        ("published_date",), ("doi",),
    ),
    "posts": Source(
        jsonl.POST_FIELDS, clean.clean_posts, "id", clean.dedup_keep_last, ("time",), ("url",),
    ),
    "citations": Source(
        jsonl.CITATION_FIELDS, clean.clean_citations, "citation_id", clean.dedup_keep_first,
        ("publication_date",), ("doi", "paper_id"),
    ),
}


def papers_table(spark: SparkSession, raw: str) -> DataFrame:
    """Cleaned papers, one row per id over the whole input, last record wins."""
    return SOURCES["papers"].table(jsonl.scan_jsonl(spark, raw, jsonl.PAPER_FIELDS).records)


def posts_table(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned posts of all micro-batches, the last version of each id."""
    return SOURCES["posts"].table(jsonl.scan_microbatches(spark, folder, jsonl.POST_FIELDS).records)


def citations_table(spark: SparkSession, raw: str) -> DataFrame:
    """Cleaned citation records of one snapshot, first record per id wins.

    A line that is no JSON fails the job, as a truncated snapshot must not pass.
    """
    return SOURCES["citations"].table(jsonl.scan_jsonl_strict(spark, raw, jsonl.CITATION_FIELDS))


# Raw fields the rules of each source look at. Variants keep the JSON type.
RULES = {
    "papers": (
        {n: "string" for n in ("id", "title", "abstract", "categories", "update_date")},
        expect.paper_rules,
    ),
    "citations": (
        {"id": "string", "cited_by_count": "bigint", "publication_year": "bigint"},
        expect.citation_rules,
    ),
    "posts": (
        {"id": "variant", "time": "variant"}
        | {n: "string" for n in ("title", "type", "by", "score")},
        expect.post_rules,
    ),
}


@dataclass(frozen=True)
class Refreshed:
    """What a refresh found: its monitoring rows, rule results and cleaning report."""

    monitoring: DataFrame
    results: DataFrame
    report: DataFrame


def refresh(
    spark: SparkSession,
    source: str,
    raw: str,
    target: str,
    *,
    reports: str,
    run_id: str,
    run_at: str,
    newest: str | None = None,
    strict: bool = False,
    allowed_invalid: int = 0,
    read_before: str | None = None,
    buckets: int = 0,
) -> Refreshed:
    """Check, clean and rebuild one source.

    ``raw`` is a file, a folder or a glob of them, and must exist. With ``newest``
    ('file' or 'folder') only the last member of the glob is taken. The lines are parsed once, into a scratch
    table that is removed at the end, and counted as they are written; the cleaned rows likewise. Below ``reports`` the run leaves, each under its source and run id: ``validations`` (the rules'
    results, the last of them on lines that are no records, of which ``allowed_invalid`` may be there), ``rejects`` (those
    lines), ``cleaning`` (lines, records, rows in and out, ...) and ``monitoring`` (a row for each layer). With ``strict`` a
    failed rule stops the job before the table is replaced; the results and rejects are stored then, too.

    With ``read_before``, the folder of a ledger, only files that no earlier refresh has read are taken, and merged into
    a table of ``buckets`` parts, of which only those with new keys are rewritten; ``silver_table`` reads it. The table then holds what a refresh of
    all files at once would give, provided that landed files do not change; the reports are about the new files.
    """
    kind = SOURCES[source]
    rule_fields, rules = RULES[source]
    if newest:
        raw = latest_snapshot(spark, raw, folders=newest == "folder")
    paths: list[str] = [raw]
    if read_before:
        if newest or buckets < 1:
            raise ValueError("a ledger goes with all files and a number of buckets")
        files = ledger.new_files(spark, raw, read_before).collect()
        files = spark.createDataFrame(files, ", ".join(ledger.LAYOUT.split(", ")[:3]))
        paths = [r["path"] for r in files.select("path").collect()]
        inventory = inventory_of(files)
    else:
        inventory = input_inventory(spark, raw)
    at = F.lit(run_at).cast("timestamp")

    def stored(what: str) -> str:
        return f"{reports.rstrip('/')}/{what}/suite={source}/run_id={run_id}"

    staging = scratch_dir(spark, f"refresh-{source}")
    try:
        lines = jsonl.read_lines(spark, paths) if paths else jsonl.read_lines(spark, raw).where("false")
        read = Observation()
        parsed = jsonl.stage_lines(lines, record=kind.fields, rules=rule_fields)
        counting = [F.count("*").alias("lines"), F.count_if("is_record").alias("records")]
        write_parquet(parsed.observe(read, *counting), f"{staging}/lines")
        staged = scan_parquet(spark, f"{staging}/lines")
        counts = read.get
        invalid = counts["lines"] - counts["records"]
        staged.where("NOT is_record").select("reject").write.mode("overwrite").text(stored("rejects"))
        suite = rules()
        found = expect.run_suite(staged.where("is_record").select("rules.*"), suite)
        on_lines = expect.line_rule(len(suite) + 1, counts["lines"], invalid, allowed_invalid)
        expect.store_validation(
            found.unionByName(spark.createDataFrame([on_lines], found.schema)),
            f"{reports.rstrip('/')}/validations",
            suite=source,
            run_id=run_id,
            run_at=run_at,
        )
        results = scan_parquet(spark, stored("validations"))
        if strict:
            expect.require_success(results)
        records = staged.where("is_record").select("record.*", jsonl.ARRIVAL)
        rows_in = kind.cleaned(records).count()
        if read_before:
            once, seen = clean.observe_cleaning(
                kind.arrived(records), f"cleaned-{source}", dates=kind.dates, coverage=kind.coverage
            )
            write_parquet(once, f"{staging}/rows")
            batch = scan_parquet(spark, f"{staging}/rows")
            if resolve(spark, target) is None:
                create_bucketed(batch, target, [kind.key], buckets)
            elif rows_in:
                upsert_buckets(batch, target, [jsonl.ARRIVAL], kind.dedup)
            checked = batch
        else:
            once, seen = clean.observe_cleaning(
                kind.table(records), f"cleaned-{source}", dates=kind.dates, coverage=kind.coverage
            )
            rebuild(once, target)
            checked = read_table(spark, target)
        report = clean.observed_report(spark, seen.get, rows_in, dates=kind.dates, coverage=kind.coverage)
        report = report.select(
            F.lit(counts["lines"]).alias("lines"),
            F.lit(counts["records"]).alias("records"),
            F.lit(invalid).alias("invalid_lines"),
            "*",
        )
        write_parquet(report, stored("cleaning"), mode="overwrite")
        key_rules = expect.run_suite(checked, [expect.not_null(kind.key), expect.unique(kind.key)])
        rows = [
            marts.monitoring_row(inventory, expect.suite_summary(results), source=source, layer="bronze", at=at),
            marts.monitoring_row(
                input_inventory(spark, part_folders(spark, target)),
                expect.suite_summary(key_rules),
                source=source,
                layer="silver",
                at=at,
            ),
        ]
        write_parquet(rows[0].unionByName(rows[1]), stored("monitoring"), mode="overwrite")
    finally:
        remove_dir(spark, staging)
    if read_before and paths:
        ledger.enter(files, read_before, run_id)
    return Refreshed(
        scan_parquet(spark, stored("monitoring")), results, scan_parquet(spark, stored("cleaning"))
    )


def silver_table(spark: SparkSession, path: str) -> DataFrame:
    """A refreshed table, whole or in buckets, without the columns that only merging needs."""
    return read_bucketed(spark, path).drop(jsonl.ARRIVAL)


def citation_matches(papers: DataFrame, citations: DataFrame) -> DataFrame:
    """(paper_id, citation_id): by paper id, then by DOI for the rest."""
    left = papers.select("id", "doi").withColumnRenamed("id", "paper_id")
    right = citations.select("citation_id", F.col("paper_id").alias("_key"), "doi")
    return matching.match_cascade(
        left,
        right,
        [
            (c.normalize_key("paper_id"), c.normalize_key("_key")),
            (c.normalize_doi("doi"), c.normalize_doi("doi")),
        ],
        "paper_id",
        "citation_id",
    )


def paper_documents(papers: DataFrame) -> DataFrame:
    """Cleaned papers in the strict document layout of the index, long keywords
    left out. Columns the layout does not know are dropped here, not rejected there."""
    documents = papers.withColumn("update_date", c.iso_date("update_date"))
    return documents.select(
        *[
            c.ignore_above(f"`{n}`", PAPER_KEYWORD_LIMITS[n]).alias(n)
            if n in ("doi", "license")
            else F.col(f"`{n}`")
            for n in PAPER_DOCUMENT
        ]
    )


def post_matches(papers: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts that link to a known paper."""
    return matching.match_url_join(
        posts.withColumnRenamed("id", "post_id"),
        papers.select(F.col("id").alias("paper_id")),
        c.id_from_url("url"),
        c.normalize_key("paper_id"),
        post_id="post_id",
        paper_id="paper_id",
        post_columns=["score", "descendants", "title", "url"],
    )


def gold_table(
    papers: DataFrame,
    citations: DataFrame,
    posts: DataFrame,
    as_of: str,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Scored papers. ``pairs(paper_id, citation_id)`` takes citations by matches, DOI
    matches included, instead of by the paper id they state."""
    key = c.normalize_key("paper_id").alias("paper_id")
    dataset = scoring.impact_dataset(
        papers.select(
            c.normalize_key("id").alias("paper_id"), "title", "categories", "published_date"
        ),
        citations.select("citation_id", key, "cited_by_count"),
        posts.select(
            c.id_from_url("url").alias("paper_id"), "score", F.col("descendants").alias("replies")
        ),
        F.lit(as_of).cast("date"),
        None if pairs is None else pairs.select(key, "citation_id"),
    )
    return scoring.impact_scores(dataset)


def silver_tables(spark: SparkSession, silver: str) -> list[DataFrame]:
    return [silver_table(spark, f"{silver.rstrip('/')}/{t}") for t in ("papers", "citations", "posts")]


def require_scores(scored: DataFrame) -> None:
    """Stop the job if there are no scores, or some are NULL or outside 0 to 100."""
    found = scoring.score_validation(scored).first()
    if not found["success"]:
        raise ValueError(f"scores are not fit to publish: {found.asDict()}")


def write_gold(
    spark: SparkSession, silver: str, gold: str, as_of: str, pairs: DataFrame | None = None
) -> None:
    """Score the cleaned tables, check the scores, and replace the gold table.

    The scores are written once to scratch, so the checks before the
    replacement do not score again; scratch is removed.
    """
    staging = scratch_dir(spark, "gold")
    try:
        write_parquet(gold_table(*silver_tables(spark, silver), as_of, pairs), staging)
        scored = scan_parquet(spark, staging)
        require_scores(scored)
        keyed_overwrite(scoring.gold_projection(scored), gold, "paper_id")
    finally:
        remove_dir(spark, staging)


def write_matches(spark: SparkSession, silver: str, target: str) -> None:
    """``pairs`` of papers and citations, ``posts`` that link to a paper, ``three_way`` and ``coverage``."""
    papers, citations, posts = silver_tables(spark, silver)
    base = target.rstrip("/")
    rebuild(citation_matches(papers, citations), f"{base}/pairs")
    rebuild(post_matches(papers, posts), f"{base}/posts")
    pairs, linked = read_table(spark, f"{base}/pairs"), read_table(spark, f"{base}/posts")
    rebuild(matching.three_way_match(pairs, linked, "paper_id", "post_id"), f"{base}/three_way")
    coverage = matching.match_coverage(
        papers.select(F.col("id").alias("paper_id")), citations, pairs, "paper_id", "citation_id"
    )
    rebuild(coverage, f"{base}/coverage")


def write_temporal(spark: SparkSession, silver: str, target: str) -> None:
    """``growth`` of categories by year and ``velocity`` of citations by work."""
    papers, citations, _ = silver_tables(spark, silver)
    base = target.rstrip("/")
    rebuild(temporal.growth_by_group(papers, id="id", date="published_date"), f"{base}/growth")
    works = citations.select("citation_id", "counts_by_year")
    rebuild(temporal.velocity_from_array(works), f"{base}/velocity")


def write_terms(spark: SparkSession, silver: str, target: str, n: int = 20) -> None:
    """The ``n`` heaviest terms of each abstract."""
    papers = silver_table(spark, f"{silver.rstrip('/')}/papers")
    rebuild(terms.top_terms(terms.tfidf(papers, "id", "abstract"), "id", n), target)


def write_documents(spark: SparkSession, silver: str, changes: str, batch_id: int) -> DataFrame:
    """Append the papers as one batch of document changes; (part, rows, accepted, rejected) by first letter of the id.

    ``read_current`` gives the index, ``compact`` merges old batches.
    """
    documents = paper_documents(silver_table(spark, f"{silver.rstrip('/')}/papers"))
    keyed = documents.where(F.col("id").isNotNull())
    append_changes(keyed, batch_id, changes)
    parts = documents.withColumn("part", F.substring("id", 1, 1))
    return part_report(parts, "id", "part")


def stream_posts(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    *,
    state_partitions: int,
    bounded: bool = False,
    buckets: int = 0,
    **options,
) -> StreamingQuery:
    """The posts stream: clean, watermark, first arrival per id, append to Parquet.

    Exact over all time, with state that grows by the ids; ``bounded`` forgets ids behind the watermark. With ``buckets`` it is
    exact and forgets them: later copies are found in the sink, which is partitioned into so many (``exact.read_once`` reads it).
    """
    own = stream.stream_session(spark, state_partitions)
    cleaned = stream.stream_clean(stream.stream_records(own, source))
    if buckets:
        return exact.stream_once(cleaned, target, checkpoint, ["id"], buckets=buckets, **options)
    once = stream.stream_dedup(stream.with_watermark(cleaned), ["id"], bounded=bounded)
    return stream.stream_to_parquet(once, target, checkpoint, **options)


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(prog="impactflow")
    args.add_argument(
        "job", choices=[*SOURCES, "gold", "matches", "temporal", "terms", "documents", "compact", "retire", "stream"]
    )
    args.add_argument("source")
    args.add_argument("target")
    args.add_argument("--reports", help="folder for results, rejects and monitoring of a refresh")
    args.add_argument("--run-id")
    args.add_argument("--run-at", help="time of the run, as a timestamp")
    args.add_argument("--ledger", help="folder of files read before: read only new ones and merge them")
    args.add_argument("--buckets", type=int, default=0, help="parts of the table, with --ledger, or of a stream's sink")
    args.add_argument("--lenient", action="store_true", help="rebuild although a rule failed")
    args.add_argument("--as-of")
    args.add_argument("--pairs", help="folder of matched pairs, for gold")
    args.add_argument("--batch", type=int)
    args.add_argument("--checkpoint")
    args.add_argument("--state-partitions", type=int)
    args.add_argument("--bounded", action="store_true", help="forget ids behind the watermark")
    a = args.parse_args(argv)

    def need(*names: str) -> None:
        missing = [n for n in names if getattr(a, n) is None]
        if missing:
            args.error(f"{a.job} needs " + ", ".join("--" + n.replace("_", "-") for n in missing))

    if a.job in SOURCES:
        need("reports", "run_id", "run_at")
    elif a.job == "gold":
        need("as_of")
    elif a.job == "documents":
        need("batch")
    elif a.job == "stream":
        need("checkpoint", "state_partitions")
    spark = builder(f"impactflow-{a.job}").getOrCreate()
    if a.job in SOURCES:
        refresh(
            spark, a.job, a.source, a.target, reports=a.reports, run_id=a.run_id, run_at=a.run_at,
            newest="file" if a.job == "citations" else None, strict=not a.lenient,
            read_before=a.ledger, buckets=a.buckets,
        )
    elif a.job == "gold":
        write_gold(spark, a.source, a.target, a.as_of, read_table(spark, a.pairs) if a.pairs else None)
    elif a.job == "matches":
        write_matches(spark, a.source, a.target)
    elif a.job == "temporal":
        write_temporal(spark, a.source, a.target)
    elif a.job == "terms":
        write_terms(spark, a.source, a.target)
    elif a.job == "documents":
        write_documents(spark, a.source, a.target, a.batch).show()
    elif a.job == "retire":  # the target is the time before which old versions go
        retire(spark, a.source, a.target)
    elif a.job == "compact":  # the source is the change folder, the target names its key
        compact(spark, a.source, [a.target], [], scratch_dir(spark, "compact"))
    else:
        stream_posts(
            spark, a.source, a.target, a.checkpoint,
            state_partitions=a.state_partitions, bounded=a.bounded, buckets=a.buckets,
        ).awaitTermination()


if __name__ == "__main__":
    main()
