"""Versioned tables: whole while they are replaced, merged by buckets, retired by age."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from impactflow.operators.clean import dedup_keep_first
from impactflow.sinks import tables, versions


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def files(path):
    return {p: (os.stat(p).st_mtime_ns, os.stat(p).st_size) for p in map(str, Path(path).rglob("*.parquet"))}


def test_a_lost_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.rebuild(spark.range(100), path)
    # The first task writes its rows, the second fails.
    broken = spark.range(0, 100, 1, 2).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.rebuild(broken, path)
    with pytest.raises(Exception, match="lost"):
        tables.keyed_overwrite(broken, path, "id")
    assert versions.versions(spark, path) == [1] and versions.read_table(spark, path).count() == 100
    tables.rebuild(versions.read_table(spark, path).where("id < 3"), path)  # reads what it replaces
    assert [r["id"] for r in versions.read_table(spark, path).orderBy("id").collect()] == [0, 1, 2]
    assert versions.read_table(spark, path, 1).count() == 100
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path, 7)
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, f"{path}-none")


def test_a_manifest_without_its_file_is_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(spark.range(3), path)
    (tmp_path / "t" / "manifest" / "000000000002-dead" / "_temporary").mkdir(parents=True)
    assert versions.versions(spark, path) == [1]
    assert versions.publish(spark.range(5), path).number == 2
    assert versions.read_table(spark, path).count() == 5


def test_of_two_writers_one_withdraws(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.publish(spark.range(3), path)
    before = versions.resolve(spark, path)
    versions.publish(spark.range(4), path)
    monkeypatch.setattr(versions, "resolve", lambda *_: before)  # both started from version 1
    monkeypatch.setattr(versions.uuid, "uuid4", lambda: type("U", (), {"hex": "z" * 32})())
    with pytest.raises(versions.PublishConflict):
        versions.publish(spark.range(5), path)
    monkeypatch.undo()
    assert versions.read_table(spark, path).count() == 4


def test_partitions_types_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("007", "a b/c", 1), ("7", None, 2)], "p string, q string, v int")
    versions.publish(df, path, partition_by=["p", "q"])
    assert rows(versions.read_table(spark, path).select("p", "q", "v")) == rows(df)
    versions.publish(df.where("false"), path, partition_by=["p", "q"])
    assert versions.read_table(spark, path).collect() == []
    with pytest.raises(ValueError, match="partitioned"):
        versions.publish(df, path, partition_by=["p"], only_touched_partitions=True)
    more = df.where("v = 1").withColumn("w", F.lit(5.0))
    versions.publish(df, path, partition_by=["p", "q"])
    versions.publish(more, path, partition_by=["p", "q"], only_touched_partitions=True)
    assert rows(versions.read_table(spark, path).select("v", "w")) == rows(spark.createDataFrame([(1, 5.0), (2, None)], "v int, w double"))


def test_retire_by_age(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        versions.publish(spark.range(n).withColumn("p", F.col("id") % 2), path, partition_by=["p"], only_touched_partitions=n == 4)
    (tmp_path / "t" / "data" / "_written=rlost").mkdir()  # a write that never was published
    assert versions.retire(spark, path, "2000-01-01") == 0
    assert versions.versions(spark, path) == [1, 2, 3, 4]
    assert versions.retire(spark, path, "2100-01-01", keep=2) == 2
    assert versions.versions(spark, path) == [3, 4] and versions.read_table(spark, path, 3).count() == 3
    assert versions.retire(spark, path, "2100-01-01") == 1
    assert versions.read_table(spark, path).count() == 4
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    assert versions.retire(spark, path, "2100-01-01") == 0
    with pytest.raises(ValueError):
        versions.retire(spark, path, "2100-01-01", keep=0)


def test_upsert_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("x"), F.lit(1).alias("ver"))
    base = base.unionByName(spark.createDataFrame([(None, "n", 1), (None, "n", 1)], "k long, x string, ver int"))
    versions.create_bucketed(base, path, ["k"], 16)
    before = files(path)
    batch = spark.createDataFrame([(7, "b", 2), (2000, "b", 2), (8, "old", 0), (None, "b", 2)], "k long, x string, ver int")
    done = versions.upsert_buckets(batch, path, ["ver"])
    assert 1 <= len(done.touched) <= 3 and done.rejects.count() == 1
    after = files(path)
    assert all(after[p] == before[p] for p in before)  # nothing is written over
    new = {p.split("/")[-2] for p in after if p not in before}
    assert new == {f"_bucket={b}" for b in done.touched}
    current = versions.resolve(spark, path)
    old = [f for p, f in current.parts.items() if p not in new]
    assert len(old) == len(current.parts) - len(new) and all(f in versions.resolve(spark, path, 1).parts.values() for f in old)
    want, _ = tables.upsert_by_key(base, batch, "k", ["ver"])
    assert rows(versions.read_bucketed(spark, path).select("k", "x", "ver")) == rows(want)
    # A batch without keys publishes nothing.
    assert versions.upsert_buckets(batch.where("k IS NULL"), path, ["ver"]).touched == ()
    assert versions.versions(spark, path) == [1, 2]
    # One shuffle, by the bucket alone.
    with pytest.raises(ValueError, match="bucketed"):
        versions.upsert_buckets(batch, f"{path}-none", ["ver"])


def test_bucketed_upserts_equal_plain_ones(spark, tmp_path):
    rnd = random.Random(2)
    path = str(tmp_path / "t")

    def some(n, columns):
        data = [(rnd.choice([None, *range(30)]), rnd.choice("ab"), rnd.randrange(5), rnd.random()) for _ in range(n)]
        keyed = {}
        for r in data:
            keyed[(r[0], r[1])] = r
        return spark.createDataFrame(list(keyed.values()), "k int, l string, ver int, x double").select(*columns)

    base = some(40, ["k", "l", "ver", "x"]).where("k IS NOT NULL")
    versions.create_bucketed(base, path, ["k", "l"], 5)
    plain = base
    for columns in (["k", "l", "ver", "x"], ["k", "l", "ver"], ["k", "l", "ver", "x"]):
        batch = some(30, columns)
        tables.write_parquet(batch, f"{path}-batch", mode="overwrite")
        stored = spark.read.parquet(f"{path}-batch")
        versions.upsert_buckets(stored, path, ["ver"])
        whole = F.col("k").isNotNull() & F.col("l").isNotNull()
        one = plain.withColumn("key", F.struct("k", "l"))
        merged, _ = tables.upsert_by_key(one, stored.where(whole).withColumn("key", F.struct("k", "l")), "key", ["ver"])
        plain = spark.createDataFrame(merged.drop("key").collect(), "k int, l string, ver int, x double")
        assert rows(versions.read_bucketed(spark, path).select("k", "l", "ver", "x")) == rows(plain)


def test_keep_first_merges(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, 5, "base"), (2, 5, "base")], "k int, ver int, x string")
    versions.create_bucketed(base, path, ["k"], 2)
    batch = spark.createDataFrame([(1, 4, "batch"), (2, 5, "batch"), (3, 9, "batch")], "k int, ver int, x string")
    versions.upsert_buckets(batch, path, ["ver"], dedup_keep_first)
    assert {r["k"]: r["x"] for r in versions.read_bucketed(spark, path).collect()} == {1: "batch", 2: "batch", 3: "batch"}
