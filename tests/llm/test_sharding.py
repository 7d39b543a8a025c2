from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from impactflow.llm import sharding
from impactflow.llm.sharding import fisher_yates, op10_sharding, shuffle_into_shards, write_shards

SF = "/root/testdata/sf0.001"


def check_slots(rows, shards, total):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    counts = [len(slots.get(i, [])) for i in range(shards)]
    assert sum(counts) == total and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 25])
def test_every_row_once_and_evenly(docs_of, bucket_bytes):
    rows = [(i, "t%d" % (i % 7) * (i % 50)) for i in range(500)] + [(7, "same")] * 40 + [(None, None)] * 3
    out = shuffle_into_shards(docs_of(rows), shards=9, bucket_bytes=bucket_bytes)
    got = out.collect()
    check_slots(got, 9, len(rows))
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    again = shuffle_into_shards(docs_of(rows[::-1]), shards=9, bucket_bytes=bucket_bytes).collect()
    assert {(r.doc_id, r.text, r.shard, r.slot) for r in got} == {
        (r.doc_id, r.text, r.shard, r.slot) for r in again}
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))] != sorted(
        (r.doc_id for r in got), key=str)


def test_equal_rows_are_scattered(docs_of):
    rows = [(None, "licence " * 10)] * 3000 + [(i, "x" * 88) for i in range(1500)] + [(5, None)] * 900
    df = docs_of(rows).repartition(7)
    hashed = df.withColumns(
        {"size": F.lit(88).cast("long"), "_crc": F.lit(0), "_hash": F.xxhash64("doc_id", F.coalesce("text", F.lit("")))}
    )
    dealt = sharding._scatter(hashed, 1, 50, 9000).groupBy("_bucket").count().collect()
    counts = [r["count"] for r in dealt]
    assert sum(counts) == len(rows) and len(counts) == 50 and max(counts) < 2 * len(rows) / 50
    got = shuffle_into_shards(df, shards=4, bucket_bytes=9000).collect()
    check_slots(got, 4, len(rows))
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    again = shuffle_into_shards(docs_of(rows[::-1]), shards=4, bucket_bytes=9000).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_each_bucket_is_a_task(docs_of):
    df = shuffle_into_shards(docs_of([(i, "t" * 90) for i in range(2000)]), shards=30, bucket_bytes=1000)
    written = df.sparkSession.read.parquet(*{f.rsplit("/", 1)[0] for f in df.inputFiles() if "/shards-" in f})
    held = written.groupBy(F.input_file_name().alias("f")).agg(F.countDistinct("_bucket").alias("n")).collect()
    assert {r["n"] for r in held} == {1} and len(held) == written.select("_bucket").distinct().count()


def plain(rows, shards, seed, buckets):
    """The two passes over a list, with the hashes that Spark gave: scatter, then shuffle bucket by bucket, then equal runs."""
    line = []
    for b in range(buckets):
        held = sorted((r for r in rows if r["bucket"] == b), key=lambda r: r["hash"])
        line += [held[i]["doc_id"] for i in fisher_yates(len(held), (seed << 32) + b)]
    short, more = divmod(len(line), shards)
    out, at = {}, 0
    for shard in range(shards):
        for slot in range(short + (shard < more)):
            out[line[at]] = (shard, slot)
            at += 1
    return out


def test_against_a_plain_two_pass_shuffle(docs_of):
    df = docs_of([(i, "w" * (i % 40)) for i in range(700)])
    hashed = F.xxhash64(F.lit(9), "doc_id", "text")
    total = sum(i % 40 for i in range(700))
    buckets = max(11, -(-total // 500))
    rows = [
        {"doc_id": r.doc_id, "hash": r.h, "bucket": r.h % buckets} for r in df.select("doc_id", hashed.alias("h")).collect()
    ]
    got = {r.doc_id: (r.shard, r.slot) for r in shuffle_into_shards(df, shards=11, seed=9, bucket_bytes=500).collect()}
    assert got == plain(rows, 11, 9, buckets)


def test_few_rows_none_and_clashes(docs_of):
    df = docs_of([(1, "a", 5), (2, "b", 6)], "doc_id long, text string, SHARD int")
    got = shuffle_into_shards(df, shards=5).collect()
    check_slots(got, 5, 2)
    assert shuffle_into_shards(docs_of([])).collect() == []


def test_permutation_is_whole():
    assert sorted(fisher_yates(1000, 3).tolist()) == list(range(1000))
    assert fisher_yates(1000, 3).tolist() != fisher_yates(1000, 4).tolist()


def test_query_and_files(spark, tmp_path):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_sharding(spark, SF).collect()
    check_slots(got, 24, len(docs))
    for r in got:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    out = shuffle_into_shards(spark.read.parquet(f"{SF}/documents.parquet"))
    write_shards(out, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(docs)
