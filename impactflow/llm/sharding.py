"""Sharding by a two-pass external shuffle.

The first pass scatters the records uniformly over buckets that fit into a task's memory, by a
seeded hash of identifier and content; rows that repeat whole so often that they would fill a good part of a bucket are
numbered, and the number is part of their hash. The second pass shuffles each bucket (Fisher-Yates) and
writes it. Buckets in their order are one long random sequence; shards are equal runs of it, so
the law is ``rows``: shard sizes differ by one row at most, whatever the texts are like.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, read, ship, total_bytes, without

SHARDS = 24
SEED = 20_177
BUCKET_BYTES = 32 << 20
#: Equal rows that make up more than this part of a bucket are scattered one by one.
HEAVY = 8
LAW = "rows"
OUTPUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation of 0 .. n - 1 (numpy's permutation is a Fisher-Yates shuffle)."""
    return np.random.Generator(np.random.PCG64(seed)).permutation(n)


def _shuffled(df: DataFrame, seed: int) -> DataFrame:
    """Each bucket of a partition in random order, with ``_at`` counting from 0 in the bucket."""

    def emit(bucket: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        order = fisher_yates(table.num_rows, (seed << 32) + bucket)
        mixed = table.take(pa.array(order)).append_column("_at", pa.array(np.arange(len(order))))
        yield from mixed.combine_chunks().to_batches(max_chunksize=1024)

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = -1
        for batch in batches:
            buckets = batch.column("_bucket").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and buckets[a] != now:
                    yield from emit(now, held)
                    held = []
                now = int(buckets[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from emit(now, held)

    return df.mapInArrow(shuffle, T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())]))


def _scatter(hashed: DataFrame, seed: int, buckets: int, bucket_bytes: int) -> DataFrame:
    """``hashed`` with ``_bucket``, uniform over rows that differ, and over rows that repeat so often that they weigh.

    Equal rows are interchangeable, so only how many of them a bucket gets matters: the rows of a heavy group are numbered from 0, by
    the partition they lie in and within it, so no task holds more of a group than an input partition does. There are
    at most HEAVY heavy groups for each bucket.
    """
    plain = F.pmod(F.col("_hash"), F.lit(buckets)).cast("int")
    heavy = materialise(
        hashed.groupBy("_hash")
        .agg(F.count("*").alias("_n"), F.sum("size").alias("_bytes"))
        .where((F.col("_n") > 1) & (F.col("_bytes") > bucket_bytes // HEAVY))
        .select("_hash"),
        "shard-heavy",
    )
    if heavy.isEmpty():
        return hashed.withColumn("_bucket", plain)
    light = hashed.join(heavy, "_hash", "left_anti").withColumn("_bucket", plain)
    repeated = hashed.withColumn("_part", F.spark_partition_id()).join(heavy, "_hash")
    before = Window.partitionBy("_hash").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        repeated.groupBy("_hash", "_part")
        .agg(F.count("*").alias("_n"))
        .select("_hash", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    here = Window.partitionBy("_hash", "_part").orderBy("_crc")  # any order will do
    number = F.col("_first") + F.row_number().over(here)
    numbered = repeated.join(materialise(first, "shard-numbers"), ["_hash", "_part"]).withColumn("_number", number)
    dealt = numbered.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "_hash", "_number"), F.lit(buckets)).cast("int"))
    return light.unionByName(dealt.select(light.columns))


def shuffle_into_shards(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows with ``size``, ``law``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    The rows are written bucket by bucket to a table in the shared scratch folder and the result
    reads that table; ``write_shards`` makes one folder for each shard. The size is the UTF-8 bytes of the text
    (null: none) plus 8. The order depends on the seed and the content alone, so a task that runs again makes the same.
    Repeated rows are shuffled like others, however many there are; a bucket, which one task holds, is about ``bucket_bytes`` and its
    longest texts. A null identifier is a value like any other, an empty table gives an empty result, and
    columns named like the added ones are replaced.
    """
    spark = df.sparkSession
    ship(spark)
    df = without(df, [*OUTPUT, "_bucket", "_crc", "_hash", "_at", "_part", "_number"])
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    buckets = max(shards, -(-total_bytes(df, text) // bucket_bytes))
    content = F.coalesce(text, F.lit(""))
    hashed = df.withColumns(
        {
            "size": size,
            "_crc": F.crc32(F.encode(content, "utf-8")),
            "_hash": F.xxhash64(F.lit(seed), key, content),
        }
    )
    scattered = _scatter(hashed, seed, buckets, bucket_bytes)
    # One bucket, one task. Sorted within the bucket, so that the shuffle starts from the same order every time.
    passed = scattered.repartitionById(buckets, "_bucket").sortWithinPartitions("_bucket", "_hash", key, "_crc")
    rows = materialise(_shuffled(passed.drop("_hash"), seed), "shards")

    line = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # One small row for each bucket, in a table of known size, so that Spark sends it to the rows where they lie.
    offsets = materialise(
        counts.select("_bucket", "_n", F.coalesce(F.sum("_n").over(line), F.lit(0)).alias("_offset")), "shard-offsets"
    )
    total = int(offsets.agg(F.sum("_n")).first()[0] or 0)
    short, more = divmod(total, shards)  # the first `more` shards have one row more
    at = F.col("_offset") + F.col("_at")
    edge = more * (short + 1)
    first = F.floor(at / F.lit(short + 1)).cast("int")
    later = (F.lit(more) + F.floor((at - edge) / F.lit(max(short, 1)))).cast("int")
    shard = F.when(at < edge, first).otherwise(later)
    start = F.col("shard") * F.lit(short).cast("long") + F.least(F.col("shard"), F.lit(more))
    return (
        rows.join(offsets.drop("_n"), "_bucket")
        .withColumns({"law": F.lit(LAW), "shard": shard, "_pos": at})
        .withColumn("slot", (F.col("_pos") - start).cast("long"))
        .select(*[c for c in df.columns], "size", "law", "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder ``shard=N`` for each shard, its rows in the order of their slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    out = shuffle_into_shards(docs)
    return out.select(
        "doc_id",
        "size",
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
        "law",
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
