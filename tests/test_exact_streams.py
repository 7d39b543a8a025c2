"""Late rows are kept, and keys that state has forgotten do not come back."""

from __future__ import annotations

import datetime as dt

import pytest

from impactflow.streaming import exact as ex
from impactflow.streaming import posts as st

SCHEMA = "k string, t timestamp, n int"
BASE = dt.datetime(2024, 1, 1)


def land(spark, folder, name, rows):
    rows = [(k, None if day is None else BASE + dt.timedelta(days=day), n) for k, day, n in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/part={name}")
    return st.stream_files(st.stream_session(spark, 4), f"{folder}/in/*", SCHEMA, format="parquet", files_per_trigger=100)


def once(spark, folder, name, rows):
    stream = land(spark, folder, name, rows)
    return st.finish(
        ex.stream_once(
            stream, f"{folder}/out", f"{folder}/state", ["k"], buckets=4, time="t", lateness="2 days", available_now=True
        )
    )


def split(spark, folder, name, rows):
    stream = land(spark, folder, name, rows)
    return st.finish(
        ex.stream_split_late(
            stream, f"{folder}/out", f"{folder}/state", time="t", lateness="2 days", available_now=True
        )
    )


def test_forgotten_keys_do_not_come_back(spark, tmp_path):
    folder, schema = str(tmp_path), spark.createDataFrame([], SCHEMA).schema
    totals = [
        once(spark, folder, 0, [("a", 0, 1), ("b", 0, 1), (None, 0, 1)]),
        once(spark, folder, 1, [("c", 20, 2)]),
        once(spark, folder, 2, [("a", 40, 3), ("d", 40, 3), (None, 41, 3)]),  # forgotten by state, found in the sink
        once(spark, folder, 3, [("d", 41, 4), ("b", 60, 4), ("e", 60, 4)]),
    ]
    got = {r.k: r.n for r in ex.read_once(spark, f"{folder}/out", schema).collect()}
    assert got == {"a": 1, "b": 1, None: 1, "c": 2, "d": 3, "e": 4}
    assert ex.read_once(spark, f"{folder}/out", schema).count() == len(got)
    assert totals[-1]["state_rows"] < len(got)
    assert not list((tmp_path / "out" / "staged").glob("*"))


def test_a_batch_that_runs_again_replaces_what_it_wrote(spark, tmp_path):
    folder, schema = str(tmp_path), spark.createDataFrame([], SCHEMA).schema
    once(spark, folder, 0, [("a", 0, 1), ("b", 0, 1)])
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"))
    for path in commits:  # as if the query had been lost after writing, before it could say so
        path.unlink()
    for path in (tmp_path / "state" / "commits").glob(".*.crc"):
        path.unlink()
    once(spark, folder, 1, [("c", 1, 2)])
    got = sorted(r.k for r in ex.read_once(spark, f"{folder}/out", schema).collect())
    assert got == ["a", "b", "c"]


def test_only_touched_buckets_grow(spark, tmp_path):
    folder = str(tmp_path)
    once(spark, folder, 0, [(f"k{i}", 0, 1) for i in range(50)])
    files = lambda: {p.parent.parent.name: len(list(p.parent.parent.rglob("*.parquet"))) for p in (tmp_path / "out" / "rows").rglob("*.parquet")}
    before = files()
    assert len(before) == 4
    once(spark, folder, 1, [("new", 1, 2)])
    assert sum(files()[b] > n for b, n in before.items()) == 1


def test_late_rows_are_kept_as_they_came(spark, tmp_path):
    folder, schema = str(tmp_path), spark.createDataFrame([], SCHEMA).schema
    split(spark, folder, 0, [("a", 0, 1), ("b", 9, 1), ("no time", None, 1)])
    split(spark, folder, 1, [("at the mark", 7, 2), ("behind", 1, 2), ("in time", 7.001, 2), ("no time", None, 2)])
    split(spark, folder, 2, [("only old", 3, 3)])
    split(spark, folder, 3, [("still behind", 6.5, 4), ("new", 30, 4)])
    split(spark, folder, 4, [("b", 9, 5)])
    late = ex.read_split(spark, f"{folder}/out", schema, ex.LATE).collect()
    assert sorted((r.k, r.n) for r in late) == [
        ("at the mark", 2), ("b", 5), ("behind", 2), ("only old", 3), ("still behind", 4)]
    assert ex.read_split(spark, f"{folder}/out", schema).count() == 11
    assert late[0].t is not None


def test_streams_of_nothing(spark, tmp_path):
    folder, schema = str(tmp_path), spark.createDataFrame([], SCHEMA).schema
    split(spark, folder, 0, [])
    split(spark, folder, 1, [("a", None, 1)])
    split(spark, folder, 2, [("b", 5, 1)])
    split(spark, folder, 3, [("c", 1, 1)])
    got = sorted((r.k, r.arrival) for r in ex.read_split(spark, f"{folder}/out", schema).collect())
    assert got == [("a", "on_time"), ("b", "on_time"), ("c", "late")]


@pytest.mark.parametrize("buckets", [1, 8])
def test_posts_stream_with_buckets(spark, tmp_path, buckets):
    from impactflow.plans import jobs

    (tmp_path / "in").mkdir()
    for i, line in enumerate(['{"id": 1, "time": 1720000000}', '{"id": 2, "time": 1740000000}', '{"id": 1, "time": 1760000000}']):
        (tmp_path / "in" / f"{i}.jsonl").write_text(line + "\n")
        st.finish(
            jobs.stream_posts(
                spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"),
                state_partitions=2, buckets=buckets, available_now=True,
            )
        )
    rows = spark.read.parquet(str(tmp_path / "out" / "rows")).select("id", "time").collect()
    assert sorted((r.id, r.time) for r in rows) == [(1, "2024-07-03T09:46:40Z"), (2, "2025-02-19T21:20:00Z")]
