"""Cleaners, deduplication, scans."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from impactflow.operators import clean as k
from impactflow.plans import jobs
from impactflow.plans.inspect import plan_text
from impactflow.sinks import contract, tables, versions
from impactflow.sources import files, jsonl


def write_lines(path, lines):
    path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)


def test_tolerant_scan_counts_every_bad_line(spark, tmp_path):
    path = write_lines(
        tmp_path / "a.jsonl",
        [
            ' {"id": 1} ', "not json", "", "{'id': 1}", "5", '[{"id": 2}]', '{"id": 3} x',
            '{"id": 4}{"id": 5}', '{"id": 6},{"id": 7}', '{"id": 8}] [{}', '{"id": 9', "null",
        ],
    )
    scan = jsonl.scan_jsonl(spark, path, {"id": "bigint"})
    assert [r["id"] for r in scan.records.collect()] == [1]
    assert scan.report.first().asDict() == {"lines": 12, "records": 1, "invalid_lines": 11}
    assert scan.rejects.count() == 11


def test_last_value_of_a_repeated_field_counts(spark, tmp_path):
    path = write_lines(tmp_path / "a.jsonl", ['{"id": 1, "id": 2}'])
    assert jsonl.scan_jsonl(spark, path, {"id": "bigint"}).records.first()["id"] == 2


def test_mistyped_field_nulls_only_itself(spark, tmp_path):
    path = write_lines(tmp_path / "a.jsonl", ['{"id": 1, "kids": "x", "score": 1.5}'])
    row = jsonl.scan_jsonl(spark, path, jsonl.POST_FIELDS).records.first()
    assert (row["id"], row["kids"], row["score"]) == (1, None, "1.5")


def test_strict_scan_fails(spark, tmp_path):
    path = write_lines(tmp_path / "a.jsonl", ['{"id": 1}', "{broken"])
    with pytest.raises(Exception):
        jsonl.scan_jsonl_strict(spark, path, {"id": "bigint"}).collect()


def test_dedup_over_files_keeps_the_last_file(spark, tmp_path):
    for name, score in (("b_2.jsonl", 7), ("b_1.jsonl", 1)):
        write_lines(tmp_path / name, [json.dumps({"id": 1, "score": score, "time": None})])
    row = jobs.posts_table(spark, str(tmp_path)).collect()
    assert [(r["id"], r["score"], r["time"], r["kids"]) for r in row] == [(1, 7.0, None, [])]


def test_dedup_within_a_file_keeps_the_last_line(spark, tmp_path):
    lines = [json.dumps({"id": i % 100, "title": str(i)}) for i in range(25_000)]
    path = write_lines(tmp_path / "p.jsonl", lines)
    got = {r["id"]: r["title"] for r in jobs.papers_table(spark, path).collect()}
    assert got == {str(i): str(24_900 + i) for i in range(100)}


def test_clean_papers_edges(spark, tmp_path):
    path = write_lines(
        tmp_path / "p.jsonl",
        [
            json.dumps(
                {
                    "id": " 1 ",
                    "title": "\t Hello \n",
                    "categories": "  cs.AI   cs.LG ",
                    "versions": [{"version": "v1", "created": "Mon, 2 Apr 2007 19:18:42 GMT"}],
                    "update_date": "not a date",
                    "journal-ref": " J ",
                }
            ),
            json.dumps({"id": "2", "versions": []}),
            json.dumps({"id": None}),
            json.dumps({"id": "  "}),
        ],
    )
    rows = {r["id"]: r for r in jobs.papers_table(spark, path).collect()}
    assert set(rows) == {"1", "2"}
    one, two = rows["1"], rows["2"]
    assert (one["title"], one["categories"]) == ("Hello", ["cs.AI", "cs.LG"])
    assert one["published_date"] == datetime.date(2007, 4, 2)
    assert (one["update_date"], one["journal-ref"], one["doi"]) == (None, "J", "")
    assert (two["categories"], two["published_date"]) == ([], None)


def test_clean_citations_from_latest_snapshot(spark, tmp_path):
    write_lines(tmp_path / "works_1.jsonl", [json.dumps({"id": "old"})])
    record = {
        "id": "W1",
        "doi": "https://doi.org/10.1234/ABC",
        "title": " t ",
        "cited_by_count": "abc",
        "primary_location": {"id": "pmh:oai:arXiv.org:2308.10620v2"},
        "publication_date": "2020-13-01",
        "counts_by_year": [{"year": 2020, "cited_by_count": 3}],
    }
    write_lines(
        tmp_path / "works_2.jsonl",
        [json.dumps(record), json.dumps({**record, "title": "second"})],
    )
    newest = files.latest_snapshot(spark, f"{tmp_path}/works_*.jsonl")
    rows = jobs.citations_table(spark, newest).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["citation_id"], r["doi"], r["paper_id"], r["title"]) == (
        "W1", "10.1234/abc", "2308.10620", "t")
    assert (r["cited_by_count"], r["type"], r["publication_date"]) == (0, "unknown", None)


def test_citations_refuse_a_broken_snapshot(spark, tmp_path):
    for bad in ('{"id": "W2', '{"id": "W2"}{"id": "W3"}', ""):
        path = write_lines(tmp_path / "works_1.jsonl", ['{"id": "W1"}', bad])
        with pytest.raises(Exception, match="not a JSON record"):
            jobs.citations_table(spark, path).collect()


def test_no_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.latest_snapshot(spark, f"{tmp_path}/none_*.jsonl")
    with pytest.raises(FileNotFoundError):
        files.input_inventory(spark, f"{tmp_path}/none_*.jsonl")


def test_inventory(spark, tmp_path):
    for name in "ab":
        write_lines(tmp_path / f"{name}.jsonl", ["12345"])
    row = files.input_inventory(spark, f"{tmp_path}/*.jsonl").first()
    assert (row["files"], row["size_bytes"]) == (2, 12)


def test_project_existing_types_absent_columns(spark):
    df = k.project_existing(spark.range(1), {"id": "bigint", "x": "array<string>"})
    assert df.dtypes == [("id", "bigint"), ("x", "array<string>")]


def test_cleaning_report_matches_observed_counts(spark):
    before = spark.createDataFrame(
        [(1, "a", 1), (1, None, 2), (2, None, 1)], "id int, day string, v int"
    )
    after = k.dedup_keep_last(before, ["id"], ["v"])
    report = k.cleaning_report(before, after, dates=["day"], coverage=["day"]).first()
    assert report.asDict() == {
        "rows_in": 3, "rows_out": 2, "duplicates_removed": 1, "null_day": 2, "day_pct": 0.0,
    }
    df, seen = k.observe_cleaning(after, "clean", dates=["day"])
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2, "null_day": 2}


def test_keyed_overwrite_refuses_repeated_and_missing_keys(spark, tmp_path):
    for rows in ([(1,), (1,)], [(1,), (None,)]):
        with pytest.raises(ValueError):
            tables.keyed_overwrite(
                spark.createDataFrame(rows, "k int"), str(tmp_path / "t"), "k"
            )
    assert versions.versions(spark, str(tmp_path / "t")) == [] and not list(tmp_path.glob("t/data/*"))


def test_rebuild_is_idempotent_and_touches_only_given_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    for _ in range(2):
        tables.rebuild(df, path, partition_by=["p"], rows_per_file=1)
    newer = spark.createDataFrame([(9, "b")], "v int, p string")
    tables.rebuild(newer, path, partition_by=["p"], only_touched_partitions=True)
    assert sorted(r["v"] for r in versions.read_table(spark, path).collect()) == [1, 9]


def test_upsert_fills_missing_columns_and_rejects_keyless_rows(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, x string, ver int")
    batch = spark.createDataFrame([(1, 2), (2, 4), (3, 1), (None, 9)], "k int, ver int")
    merged, rejects = tables.upsert_by_key(base, batch, "k", ["ver"])
    assert sorted(map(tuple, merged.collect())) == [(1, None, 2), (2, "b", 5), (3, None, 1)]
    assert rejects.count() == 1
    again, _ = tables.upsert_by_key(merged, batch, "k", ["ver"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_changes_replay(spark, tmp_path):
    path = str(tmp_path / "c")
    for batch_id, rows in ((0, [(1, 1)]), (1, [(1, 2), (2, 1)]), (1, [(1, 2), (2, 1)])):
        tables.append_changes(spark.createDataFrame(rows, "k int, v int"), batch_id, path)
    assert spark.read.parquet(path).count() == 3
    current = tables.read_current(spark, path, ["k"], ["v"])
    assert sorted(map(tuple, current.collect())) == [(1, 2), (2, 1)]


def test_schema_conformance(spark):
    lines = spark.createDataFrame(
        [
            ('{"id": "1", "categories": ["a"], "doi": null}',),
            ('{"id": "2", "published_date": "2020-01-01"}',),
            ('{"id": 3}',),
            ("nope",),
        ],
        "value string",
    )
    rows = contract.check_records(lines, contract.PAPER_DOCUMENT).collect()
    assert [r["record"]["id"] for r in rows if not r["bad_fields"]] == ["1"]
    assert sorted(r["bad_fields"] for r in rows) == [
        [], ["<not an object>"], ["id"], ["published_date"],
    ]
    assert list(rows[0]["record"].asDict()) == list(contract.PAPER_DOCUMENT)


def test_conforming_values_are_never_lost(spark):
    wanted = {"n": "int", "ts": "timestamp", "cats": "array<string>", "d": "double"}
    lines = {
        '{"n": 3000000000}': ["n"],
        '{"n": 1.5}': ["n"],
        '{"ts": "soon"}': ["ts"],
        '{"cats": [1, {"a": 2}]}': ["cats"],
        '{"cats": ["a", null], "d": 1, "n": null}': [],
        '{"cats": [], "d": 1.5, "ts": "2024-01-01T00:00:00Z"}': [],
        '{"n": "x", "n": 5}': [],
        '{"x": {"y": 1, "y": 2}, "z": 1}': None,
    }
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["value"]: r for r in contract.check_records(df, wanted).collect()}
    for line, bad in lines.items():
        assert bad is None or got[line]["bad_fields"] == bad, line
        assert bad is not None or got[line]["bad_fields"], line
    assert got['{"n": "x", "n": 5}']["record"]["n"] == 5
    assert got['{"cats": ["a", null], "d": 1, "n": null}']["record"]["d"] == 1.0


@pytest.mark.parametrize("allowed", ["true", "false"])
def test_records_do_not_depend_on_the_session(spark, tmp_path, allowed):
    lines = ['{"id": 1, "id": 2}', '{"id": 3, "x": NaN}', '{"id": 4, "x": {"a": 1, "a": 2}}', "{'id': 5}", '{"id": 6} x',
             '{"id": 7},{}', "[1]", "", '{"id": 8, "t": "a"}']
    path = write_lines(tmp_path / "a.jsonl", lines)
    setting = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, allowed)
    try:
        scan = jsonl.scan_jsonl(spark, path, {"id": "bigint", "t": "string"})
        assert sorted(r["id"] for r in scan.records.collect()) == [2, 3, 4, 8]
        assert scan.report.first()["invalid_lines"] == 5
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def test_land_raw_is_replayable(spark, tmp_path):
    df = spark.createDataFrame([("x",), ("x",)], "value string")
    for _ in range(2):
        files.land_raw(df, str(tmp_path), "20240101")
    assert spark.read.text(f"{tmp_path}/batch=20240101").count() == 2


def test_head_sample_is_ordered(spark):
    rows = files.head_sample(spark.range(100), [F.desc("id")], 3).collect()
    assert [r["id"] for r in rows] == [99, 98, 97]


def test_a_line_is_parsed_once_and_its_fields_taken_in_one_pass(spark, tmp_path):
    """A parse or a path for every field made a refresh cost several times its lines."""
    (tmp_path / "a.json").write_text('{"id": "1"}\n')
    lines = jsonl.read_lines(spark, str(tmp_path / "a.json"))
    text = plan_text(jsonl.stage_lines(lines, record=jsonl.PAPER_FIELDS, rules={"id": "string"}), "extended")
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("parse_json(") + optimized.count("parseJson") == 1
    assert 1 <= optimized.count("variant_get(") <= 6
    records = jsonl.parse_lines(lines, jsonl.PAPER_FIELDS).records.where("id <> ''")
    text = plan_text(records, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Filter (isnotnull(id" in text and text.count("variant_get(") <= 3


def test_what_follows_an_object_makes_it_no_record(spark, tmp_path):
    lines = [
        '{"id": "1"}', '{"id": "2"}{}', '{"id": "3"},{}', '{"id": "4"}] {}', '{"id": "5"},0,{}', '{"id": "6"},5] {}',
        '{"id": {"x": 1}, "versions": 3}', '{"id": null, "versions": [{"created": "a"}, 7]}', '{}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    scan = jsonl.scan_jsonl(spark, str(tmp_path / "a.json"), jsonl.PAPER_FIELDS)
    got = [(r["id"], r["versions"]) for r in scan.records.orderBy("arrival").collect()]
    assert [g[0] for g in got] == ["1", '{"x":1}', None, None]
    assert got[1][1] is None and got[2][1][0]["created"] == "a" and got[2][1][1] is None
    assert scan.rejects.count() == 5
