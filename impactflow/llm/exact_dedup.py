"""Exact deduplication by sorting the content.

Sampled splitters range-partition the normalised bytes, an external sort inside each
partition places equal texts next to each other, and every text is compared in full with
its neighbour. The groups that cross a partition's edge are joined by comparing the last text
of one partition with the first of the next.

The splitters hold the first ``PREFIX`` normalised bytes, the digest that orders texts with the
same beginning, and the identifier. So a splitter stays small however long the texts are, and a
group of copies of any size is dealt over as many partitions as it fills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, bytes_of, frugal, lower_ascii, materialise, read, ship, without

PREFIX = 64
OUTPUT = ("keep_id", "group_size", "kept", "text_sha256")
_KEYS = ("_content_prefix", "_content_digest")


def _normalised(batch: pa.RecordBatch, text: str) -> list[bytes]:
    data, ends = bytes_of(batch.column(text))
    whole = lower_ascii(data).tobytes()
    return [whole[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _with_keys(df: DataFrame, text: str) -> DataFrame:
    @frugal
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _normalised(batch, text)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    binaries([t[:PREFIX] for t in texts]),
                    binaries([hashlib.sha256(t).digest() for t in texts]),
                ],
                names=[*batch.schema.names, *_KEYS],
            )

    fields = [T.StructField(k, T.BinaryType()) for k in _KEYS]
    return df.mapInArrow(keys, T.StructType([*df.schema.fields, *fields]))


def _numbered(df: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """Number the groups inside each sorted partition; keep the texts at its two edges.

    ``_group`` counts from 0, ``_first`` marks the first row of a group, ``_edge`` holds the
    normalised text of the first and of the last row.
    """

    @frugal
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: bytes | None = None
        group, held = -1, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                yield held
            data, ends = bytes_of(batch.column(text))
            whole = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                batch.num_rows,
                [None, pa.py_buffer(ends.astype("int64")), pa.py_buffer(lower_ascii(data))],
            )
            new = [last is None or whole[0].as_py() != last]
            new += pc.not_equal(whole[1:], whole[:-1]).to_pylist()
            groups = []
            for n in new:
                group += n
                groups.append(group)
            edge: list[bytes | None] = [None] * batch.num_rows
            if last is None:
                edge[0] = whole[0].as_py()
            last = whole[-1].as_py()
            held = pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in carry),
                    batch.column("_part"),
                    batch.column(_KEYS[1]),
                    pa.array(groups, pa.int64()),
                    pa.array(new, pa.bool_()),
                    pa.array(edge, pa.binary()),
                    pa.nulls(batch.num_rows, pa.binary()),
                ],
                names=[*carry, "_part", _KEYS[1], "_group", "_first", "_head", "_tail"],
            )
        if held is not None:
            tail = [None] * (held.num_rows - 1) + [last]
            yield held.set_column(held.num_columns - 1, "_tail", pa.array(tail, pa.binary()))

    fields = [df.schema[c] for c in carry] + [
        T.StructField("_part", T.IntegerType()),
        T.StructField(_KEYS[1], T.BinaryType()),
        T.StructField("_group", T.LongType()),
        T.StructField("_first", T.BooleanType()),
        T.StructField("_head", T.BinaryType()),
        T.StructField("_tail", T.BinaryType()),
    ]
    return df.mapInArrow(number, T.StructType(fields))


def exact_dedup(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: str = "smallest",
    carry: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """All rows with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and is a text
    like any other. Of each group the row with the ``keep`` (``smallest`` or ``largest``)
    identifier stays; exactly one row stays even where rows are repeated with their identifier. Rows
    without an identifier come last, so one stays only if its whole group has none (``keep_id`` null).
    ``carry`` names the columns to return (default: all; a column named like one of the four
    is replaced). An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = df.sparkSession
    ship(spark)
    df = without(df, [*OUTPUT, *_KEYS, "_part", "_group", "_first", "_head", "_tail"])
    carry = [c for c in (df.columns if carry is None else carry) if c in df.columns]
    if key not in carry:
        raise ValueError(f"the identifier {key} has to be carried")
    order = F.col(key).desc_nulls_last() if keep == "largest" else F.col(key).asc_nulls_last()
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _with_keys(df.select(*dict.fromkeys([*carry, text])), text)
    by = [F.col(_KEYS[0]), F.col(_KEYS[1]), order]
    ordered = (
        keyed.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
    )
    # Splitters are sampled anew by every job, so the numbering is written once and read from there.
    rows = materialise(_numbered(ordered, text, carry), "exact-dedup")

    # One row per partition and edge: few and small but for the two texts, joined by number.
    heads = rows.where("_head IS NOT NULL").select("_part", "_head")
    tails = rows.where("_tail IS NOT NULL").select(
        F.col("_part").alias("_before"), "_tail", (F.col("_group") + 1).alias("_groups")
    )
    edges = (
        tails.join(heads.withColumn("_before", F.col("_part") - 1), "_before", "full")
        .select(
            F.coalesce("_part", F.col("_before") + 1).alias("_part"),
            F.coalesce(F.col("_head") == F.col("_tail"), F.lit(False)).alias("_joined"),
            F.col("_groups").alias("_groups_before"),
        )
    )
    sizes = tails.select(F.col("_before").alias("_part"), "_groups")
    # A group that goes on begins at the last group of the nearest partition that breaks it.
    line = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.join(edges, "_part", "left")
        .withColumn("_joined", F.coalesce("_joined", F.lit(False)))
        .withColumn(
            "_opens",
            F.when(~F.col("_joined") | (F.col("_groups") > 1), F.struct("_part", F.col("_groups") - 1)),
        )
        .withColumn("_root", F.last("_opens", ignorenulls=True).over(line))
        .where("_joined")
        .select(
            "_part",
            F.lit(0).cast("long").alias("_group"),
            F.col("_root").getField("_part").alias("_root_part"),
            F.col("_root").getField("col2").alias("_root_group"),
        )
    )
    # Sizes of the pieces of a group, then of the whole group: sums that combine before they move.
    best = F.max(key) if keep == "largest" else F.min(key)
    pieces = rows.groupBy("_part", "_group").agg(best.alias("_best"), F.count("*").alias("_n"))
    located = pieces.join(starts, ["_part", "_group"], "left")
    located = located.withColumns(
        {
            "_root_part": F.coalesce("_root_part", "_part"),
            "_root_group": F.coalesce("_root_group", "_group"),
        }
    )
    located = materialise(located, "exact-dedup-groups")
    whole = (
        located.groupBy("_root_part", "_root_group")
        .agg(
            (F.max("_best") if keep == "largest" else F.min("_best")).alias("keep_id"),
            F.sum("_n").alias("group_size"),
        )
        .where("group_size > 1")
    )
    found = located.join(whole, ["_root_part", "_root_group"]).select(
        "_part",
        "_group",
        "keep_id",
        "group_size",
        ((F.col("_part") == F.col("_root_part")) & (F.col("_group") == F.col("_root_group"))).alias("_root"),
    )
    found = materialise(found, "exact-dedup-found")
    return rows.join(found, ["_part", "_group"], "left").select(
        *carry,
        F.when(F.col("group_size").isNull(), F.col(key)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("_first") & F.coalesce("_root", F.lit(True))).alias("kept"),
        F.lower(F.hex(_KEYS[1])).alias("text_sha256"),
    )


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return exact_dedup(docs, keep="largest", carry=["doc_id"])


OP1_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""
