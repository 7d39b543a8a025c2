"""The posts stream over staged files."""

from __future__ import annotations

import json

import pytest

from impactflow.operators.clean import clean_posts
from impactflow.plans import jobs
from impactflow.sinks.tables import read_current
from impactflow.sources import jsonl
from impactflow.streaming import posts as st

DAY = 86_400
START = 1_720_000_000


def record(i, day, score=1):
    return json.dumps({"id": i, "by": " a ", "time": START + day * DAY, "score": score})


def stage(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(x + "\n" for x in lines), encoding="utf-8")


def run(spark, tmp_path, *parts):
    """Each part is landed and the stream restarted on its checkpoint."""
    totals = []
    for name, lines in parts:
        stage(tmp_path / "in", name, lines)
        query = jobs.stream_posts(
            spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"),
            state_partitions=4,
            available_now=True,
        )
        totals.append(st.finish(query))
    return spark.read.parquet(str(tmp_path / "out")), totals


def test_injected_record_appears_once_after_restart(spark, tmp_path):
    live = json.dumps({"id": 777, "by": "live_tester", "time": START, "title": "LIVE TEST"})
    out, totals = run(
        spark, tmp_path, ("a.jsonl", [record(1, 0)]), ("b.jsonl", [live]), ("c.jsonl", [live])
    )
    assert out.where("id = 777 AND title = 'LIVE TEST'").count() == 1
    assert out.count() == 2
    assert [x["input_rows"] for x in totals] == [1, 1, 1]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    out, totals = run(
        spark,
        tmp_path,
        ("a.jsonl", [record(1, 0)]),
        ("b.jsonl", [record(2, 20)]),
        ("c.jsonl", [record(3, 21)]),
        ("d.jsonl", [record(4, 1), record(5, 30)]),
        ("e.jsonl", [record(6, 2), record(7, 31)]),
    )
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3, 5, 7]
    assert sum(x["late_rows"] for x in totals) == 2


def test_first_arrival_wins_and_null_times_pass(spark, tmp_path):
    null_time = json.dumps({"id": 9, "time": None})
    out, _ = run(
        spark,
        tmp_path,
        ("a.jsonl", [record(1, 0, score=1), null_time]),
        ("b.jsonl", [record(1, 0, score=7), null_time, "not json"]),
    )
    got = {r["id"]: (r["score"], r["time"]) for r in out.collect()}
    assert got == {1: (1.0, "2024-07-03T09:46:40Z"), 9: (0.0, None)}


def test_stream_equals_batch(spark, tmp_path):
    lines = [record(i % 40, i % 5, i) for i in range(40)] + ["{bad", '{"id": "x"}']
    stage(tmp_path / "in", "a.jsonl", lines)
    out, _ = run(spark, tmp_path, ("b.jsonl", []))
    batch = clean_posts(
        jsonl.scan_microbatches(spark, str(tmp_path / "in"), jsonl.POST_FIELDS).records
    ).drop("arrival")
    assert sorted(map(str, out.select(batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_changes_keep_the_latest_version(spark, tmp_path):
    for name, score in (("a.jsonl", 1), ("b.jsonl", 7), ("c.jsonl", 5)):
        stage(tmp_path / "in", name, [record(1, 0, score)])
        cleaned = st.stream_clean(st.stream_records(spark, str(tmp_path / "in")))
        st.finish(
            st.stream_changes(
                cleaned, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True
            )
        )
    current = read_current(spark, str(tmp_path / "out"), ["id"], ["event_time"])
    assert [r["score"] for r in current.collect()] == [5.0]


def test_bounded_state_is_smaller(spark, tmp_path):
    def state_rows(bounded, where):
        totals = []
        for i in range(6):
            stage(where / "in", f"{i}.jsonl", [record(i, i * 20)])
            cleaned = st.stream_clean(st.stream_records(spark, str(where / "in")))
            once = st.stream_dedup(st.with_watermark(cleaned), ["id"], bounded=bounded)
            totals.append(
                st.finish(
                    st.stream_to_parquet(
                        once, str(where / "out"), str(where / "state"), available_now=True
                    )
                )["state_rows"]
            )
        return totals[-1]

    for name in ("all", "some"):
        (tmp_path / name).mkdir()
    assert state_rows(False, tmp_path / "all") == 6
    assert state_rows(True, tmp_path / "some") < 6


def test_rocksdb_state_store_is_configured(spark):
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_unknown_time_column(spark):
    with pytest.raises(KeyError):
        st.with_watermark(spark.range(1), "absent")


def test_totals_of_more_batches_than_a_query_remembers(spark, tmp_path):
    for i in range(115):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / f"{i:04d}.txt").write_text("a\nb\n")
    own = st.stream_session(spark, 2)
    lines = st.stream_files(own, str(tmp_path / "in"), "value string", format="text", files_per_trigger=1)
    query = st.stream_to_parquet(lines, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    assert st.finish(query)["input_rows"] == 230
    assert spark.read.parquet(str(tmp_path / "out")).count() == 230


def test_stream_session_keeps_settings_made_at_run_time(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9m")
    try:
        own = st.stream_session(spark, 3)
        assert own.conf.get("spark.sql.files.maxPartitionBytes") == "9m"
        assert own.conf.get("spark.sql.shuffle.partitions") == "3"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
