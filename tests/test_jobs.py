"""Whole jobs from raw files to gold."""

from __future__ import annotations

import json

import pytest

from impactflow.plans import jobs
from impactflow.sinks.contract import PAPER_DOCUMENT
from impactflow.sinks.tables import read_current
from impactflow.sinks.versions import read_table

PAPERS = [
    {"id": "2301.1", "title": " A ", "abstract": "x", "categories": "cs.AI cs.LG",
     "update_date": "2024-01-01", "doi": "",
     "versions": [{"version": "v1", "created": "Mon, 2 Apr 2007 19:18:42 GMT"}]},
    {"id": "2301.2", "title": "B", "abstract": "x", "categories": "cs.AI",
     "update_date": "2024-01-01", "doi": "10.1/B", "versions": []},
    {"id": "2301.3", "title": "C", "abstract": "x", "categories": "cs.AI",
     "update_date": "2024-01-01"},
]
WORKS = [
    {"id": "W1", "cited_by_count": 9, "publication_year": 2020,
     "primary_location": {"id": "pmh:oai:arXiv.org:2301.1v2"}},
    {"id": "W2", "cited_by_count": 4, "publication_year": 2020, "doi": "https://doi.org/10.1/b",
     "primary_location": None},
]
POSTS = [
    {"id": 1, "by": "u", "time": 1720000000, "type": "story", "title": "t", "score": 5,
     "descendants": 2, "url": "https://arxiv.org/pdf/2301.1v1.pdf"},
    {"id": 1, "by": "u", "time": 1720000000, "type": "story", "title": "t", "score": 8,
     "descendants": 3, "url": "https://arxiv.org/pdf/2301.1v1.pdf"},
    {"id": 2, "by": "u", "time": "soon", "type": "job", "title": "t", "score": 1,
     "url": "https://example.com"},
]


@pytest.fixture()
def raw(tmp_path):
    def lines(name, records):
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps(r) + "\n" for r in records), encoding="utf-8")

    lines("papers/p.json", PAPERS)
    lines("works/works_1.jsonl", [{"id": "old"}])
    lines("works/works_2.jsonl", WORKS)
    for i, post in enumerate(POSTS):
        lines(f"posts/batch_{i}.jsonl", [post])
    return tmp_path


def refresh(spark, base, source, folder, **options):
    found = jobs.refresh(
        spark, source, f"{base}/raw/{folder}", f"{base}/silver/{source}",
        reports=f"{base}/rep", run_id="r1", run_at="2024-01-01", **options,
    )
    return found.monitoring.where("layer = 'bronze'").first()


def test_raw_to_gold(spark, raw):
    papers = refresh(spark, raw, "papers", "papers", strict=True)
    works = refresh(spark, raw, "citations", "works/works_*.jsonl", newest="file", strict=True)
    posts = refresh(spark, raw, "posts", "posts")
    assert (papers["object_count"], papers["ge_evaluated"], papers["ge_successful"]) == (1, 8, 8)
    assert (works["object_count"], works["ge_successful"]) == (1, 7)
    assert (posts["object_count"], posts["ge_successful"], posts["ge_failed"]) == (3, 8, 2)
    stored = spark.read.parquet(f"{raw}/rep/validations")
    assert stored.count() == 25
    layers = spark.read.parquet(f"{raw}/rep/monitoring")
    assert layers.where("layer = 'silver' AND ge_evaluated = 2 AND ge_failed = 0").count() == 3
    failed = {r["rule"].split("_")[-1] for r in stored.where("NOT success").collect()}
    assert failed == {"type", "set"}

    jobs.write_gold(spark, f"{raw}/silver", f"{raw}/gold", "2026-01-01")
    gold = read_table(spark, f"{raw}/gold").collect()
    assert [(r["paper_id"], r["cited_by_count"], r["score_total"]) for r in gold] == [
        ("2301.1", 9, 8.0)
    ]
    assert gold[0]["published_date"] == "2007-04-02"

    jobs.write_matches(spark, f"{raw}/silver", f"{raw}/matches")
    pairs = read_table(spark, f"{raw}/matches/pairs")
    jobs.write_gold(spark, f"{raw}/silver", f"{raw}/gold", "2026-01-01", pairs)
    gold = {r["paper_id"]: r["cited_by_count"] for r in read_table(spark, f"{raw}/gold").collect()}
    assert gold == {"2301.1": 9, "2301.2": 4}  # the second by its DOI
    three = read_table(spark, f"{raw}/matches/three_way").collect()
    assert [(r["paper_id"], r["citation_id"], r["post_id"]) for r in three] == [("2301.1", "W1", 1)]
    coverage = read_table(spark, f"{raw}/matches/coverage").first()
    assert (coverage["pairs"], coverage["left_rows"], coverage["left_matched"], coverage["right_pct"]) == (2, 3, 2, 100.0)

    jobs.write_temporal(spark, f"{raw}/silver", f"{raw}/temporal")
    growth = read_table(spark, f"{raw}/temporal/growth").collect()
    assert {(r["category"], r["year"], r["publication_count"]) for r in growth} == {("cs.AI", 2007, 1), ("cs.LG", 2007, 1)}
    jobs.write_terms(spark, f"{raw}/silver", f"{raw}/terms")
    assert read_table(spark, f"{raw}/terms").count() >= 0
    for batch in (1, 2, 3, 4):
        parts = jobs.write_documents(spark, f"{raw}/silver", f"{raw}/changes", batch).collect()
        assert [(r["part"], r["rows"], r["rejected"]) for r in parts] == [("2", 3, 0)]
    before = sorted(map(tuple, read_current(spark, f"{raw}/changes", ["id"], []).collect()))
    jobs.main(["compact", f"{raw}/changes", "id"])
    after = sorted(map(tuple, read_current(spark, f"{raw}/changes", ["id"], []).collect()))
    assert before == after and len(after) == 3
    assert sorted(p.name for p in (raw / "changes").glob("batch_id=*")) == ["batch_id=3", "batch_id=4"]


def test_strict_refresh_replaces_nothing(spark, raw):
    with pytest.raises(ValueError, match="in_set"):
        refresh(spark, raw, "posts", "posts", strict=True)
    assert not (raw / "silver").exists()


def test_broken_lines_stop_a_strict_refresh(spark, raw):
    """47 of 50 lines cut off: the table stays, and the run says why."""
    whole = [{**PAPERS[0], "id": f"p{i}"} for i in range(50)]
    path = raw / "raw" / "papers" / "p.json"
    path.write_text("".join(json.dumps(r) + "\n" for r in whole))
    refresh(spark, raw, "papers", "papers", strict=True)
    lines = [json.dumps(r)[: None if i < 3 else -20] + "\n" for i, r in enumerate(whole)]
    path.write_text("".join(lines))
    with pytest.raises(ValueError, match="records.*47 unexpected"):
        refresh(spark, raw, "papers", "papers", strict=True)
    assert read_table(spark, f"{raw}/silver/papers").count() == 50
    run = "suite=papers/run_id=r1"
    assert spark.read.text(f"{raw}/rep/rejects/{run}").count() == 47
    failed = spark.read.parquet(f"{raw}/rep/validations/{run}").where("NOT success").collect()
    assert [(r["rows"], r["unexpected"]) for r in failed] == [(50, 47)]
    row = refresh(spark, raw, "papers", "papers")
    assert (row["ge_evaluated"], row["ge_successful"]) == (8, 7)
    report = spark.read.parquet(f"{raw}/rep/cleaning/{run}").first()
    assert (report["lines"], report["invalid_lines"], report["rows_in"], report["rows_out"]) == (50, 47, 3, 3)
    refresh(spark, raw, "papers", "papers", strict=True, allowed_invalid=47)


def test_scores_are_checked_before_publishing(spark):
    bad = spark.createDataFrame([("p", 101.0)], "paper_id string, impact_score double")
    with pytest.raises(ValueError, match="out_of_range"):
        jobs.require_scores(bad)


def test_matches_between_cleaned_tables(spark, raw):
    papers = jobs.papers_table(spark, f"{raw}/raw/papers").cache()
    works = jobs.citations_table(spark, f"{raw}/raw/works/works_2.jsonl")
    posts = jobs.posts_table(spark, f"{raw}/raw/posts")
    pairs = sorted(map(tuple, jobs.citation_matches(papers, works).collect()))
    assert pairs == [("2301.1", "W1"), ("2301.2", "W2")]
    matched = jobs.post_matches(papers, posts).collect()
    assert [(r["post_id"], r["paper_id"], r["score"]) for r in matched] == [(1, "2301.1", 8.0)]
    documents = jobs.paper_documents(papers)
    assert documents.columns == list(PAPER_DOCUMENT)
    assert dict(documents.dtypes) == PAPER_DOCUMENT


def test_command_line(spark, raw):
    run = ["--reports", f"{raw}/rep", "--run-id", "1", "--run-at", "2024-01-01"]
    jobs.main(["papers", f"{raw}/raw/papers", f"{raw}/silver/papers", *run])
    jobs.main(["citations", f"{raw}/raw/works/works_*.jsonl", f"{raw}/silver/citations", *run])
    with pytest.raises(ValueError, match="in_set"):
        jobs.main(["posts", f"{raw}/raw/posts", f"{raw}/silver/posts", *run])
    jobs.main(["posts", f"{raw}/raw/posts", f"{raw}/silver/posts", *run, "--lenient"])
    jobs.main(["gold", f"{raw}/silver", f"{raw}/gold", "--as-of", "2026-01-01"])
    assert read_table(spark, f"{raw}/gold").count() == 1
    for bad in (["gold", "a", "b"], ["papers", "a", "b"], ["stream", "a", "b", "--checkpoint", "c"]):
        with pytest.raises(SystemExit):
            jobs.main(bad)


def landed(spark, raw, n, posts):
    folder = raw / "raw" / "stream" / f"batch={n}"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text("".join(json.dumps({"by": "u", "time": 1720000000, "type": "story", "title": "t", **p}) + "\n" for p in posts))


def take(spark, raw, run):
    return jobs.refresh(
        spark, "posts", f"{raw}/raw/stream/batch=*", f"{raw}/silver/posts", reports=f"{raw}/rep", run_id=run,
        run_at="2024-01-01", read_before=f"{raw}/ledger", buckets=4,
    ).report.first()


def test_refresh_reads_each_line_once_and_equals_a_full_one(spark, raw, monkeypatch):
    landed(spark, raw, 1, [{"id": i, "score": 1} for i in range(20)])
    landed(spark, raw, 3, [{"id": 5, "score": 3}, {"id": 5, "score": 4}])
    first = take(spark, raw, "a")
    assert (first["lines"], first["rows_in"], first["rows_out"]) == (22, 22, 20)
    landed(spark, raw, 2, [{"id": 5, "score": 2}, {"id": 6, "score": 2}, {"id": 99, "score": 2}])  # an older one comes late
    # The run is lost after its rows were published: the next one reads the same file again.
    with monkeypatch.context() as m:
        m.setattr(jobs.ledger, "enter", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            take(spark, raw, "b")
    assert take(spark, raw, "b")["lines"] == 3
    none = take(spark, raw, "c")
    assert (none["lines"], none["rows_in"], none["rows_out"], none["invalid_lines"]) == (0, 0, 0, 0)
    got = sorted(map(str, jobs.silver_table(spark, f"{raw}/silver/posts").collect()))
    whole = sorted(map(str, jobs.posts_table(spark, f"{raw}/raw/stream").collect()))
    assert got == whole and len(got) == 21
    assert {r["id"]: r["score"] for r in jobs.silver_table(spark, f"{raw}/silver/posts").collect()}[5] == 4
    entered = {r["run_id"]: r["files"] for r in jobs.ledger.summary(spark, f"{raw}/ledger").collect()}
    assert entered == {"a": 2, "b": 1}
    with pytest.raises(ValueError, match="buckets"):
        jobs.refresh(spark, "posts", "x", "y", reports="z", run_id="1", run_at="2024-01-01", read_before="l")
