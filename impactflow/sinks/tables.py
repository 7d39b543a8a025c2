"""Parquet sinks: plain, rebuilt, keyed, upserted, and change logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import dedup_keep_last
from ..session import remove_dir
from .versions import publish

BATCH = "batch_id"


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    rows_per_file: int = 0,
) -> None:
    """Snappy Parquet, one pass over ``df``."""
    writer = df.write.mode(mode).option("compression", "snappy")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def rebuild(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    rows_per_file: int = 0,
    only_touched_partitions: bool = False,
) -> None:
    """Idempotent rebuild: a new version takes the place of the old one, which stays whole until then.

    With ``only_touched_partitions`` just the partitions present in ``df`` are
    replaced. ``read_table`` reads the result.
    """
    publish(
        df, path, partition_by=partition_by, rows_per_file=rows_per_file,
        only_touched_partitions=only_touched_partitions,
    )


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, NULL keys included."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def require_key_of(df: DataFrame, key: str) -> None:
    """Stop the job if ``key`` is NULL or repeated; one pass."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    found = counted.where((F.col("n") > 1) | F.col(key).isNull()).limit(5).collect()
    if found:
        raise ValueError(f"{key} is not a key, for example {[r[0] for r in found]}")


def keyed_overwrite(
    df: DataFrame, path: str, key: str, *, format: str = "parquet", **options: str
) -> None:
    """Replace a whole keyed table; the old one stays if ``key`` is NULL or repeated.

    A Parquet table is published as a new version: ``df`` is evaluated once, and what was written is checked before it takes
    effect. For other formats the check comes before the write, as a connector replaces what it finds.
    """
    if format == "parquet" and not options:
        publish(df, path, check=lambda written: require_key_of(written, key))
        return
    require_key_of(df, key)
    df.write.mode("overwrite").format(format).options(**options).save(path)


def upsert_by_key(
    base: DataFrame, batch: DataFrame, key: str, version: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Merge ``batch`` into ``base``: (merged, rejects).

    Rows of the batch without a key are rejected. At equal versions the batch
    row wins, so applying a batch twice changes nothing. Columns the batch
    lacks become NULL. Rows of the base without a key are kept as they are.
    """
    rejects = batch.where(F.col(key).isNull())
    incoming = batch.where(F.col(key).isNotNull()).withColumn("_from_batch", F.lit(1))
    keyed = base.where(F.col(key).isNotNull()).withColumn("_from_batch", F.lit(0))
    both = keyed.unionByName(incoming, allowMissingColumns=True)
    merged = dedup_keep_last(both, [key], [*version, "_from_batch"]).drop("_from_batch")
    keyless = base.where(F.col(key).isNull())
    return merged.unionByName(keyless, allowMissingColumns=True), rejects


def upsert_report(base: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """One row: batch_rows, rejected, inserted_keys, updated_keys.

    Keys of both sides meet in one grouped count, so each side is read once.
    """
    sides = base.select(key, F.lit(0).alias("_b")).union(batch.select(key, F.lit(1)))
    by_key = sides.groupBy(key).agg(F.sum("_b").alias("_n"), F.min("_b").alias("_least"))
    touched = F.col(key).isNotNull() & (F.col("_n") > 0)
    return by_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("batch_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("rejected"),
        F.count_if(touched & (F.col("_least") == 1)).alias("inserted_keys"),
        F.count_if(touched & (F.col("_least") == 0)).alias("updated_keys"),
    )


def part_report(batch: DataFrame, key: str, part: str) -> DataFrame:
    """(part, rows, accepted, rejected): keyed and keyless rows per part of a batch."""
    return batch.groupBy(part).agg(
        F.count("*").alias("rows"),
        F.count(key).alias("accepted"),
        F.count_if(F.col(key).isNull()).alias("rejected"),
    )


def append_changes(batch: DataFrame, batch_id: int, path: str) -> None:
    """Store one batch of changes under its id; a replay of the batch replaces it.

    Usable as ``foreachBatch`` body: costs the size of the batch, not of the table.
    """
    batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")


def _current(changes: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The last change of each key; changes without a whole key are all kept."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    last = dedup_keep_last(changes.where(whole), key, [*version, BATCH])
    return last.unionByName(changes.where(~whole))


def read_current(
    spark: SparkSession, path: str, key: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Current state of a change folder: per key the highest version, then the last batch."""
    return _current(spark.read.parquet(path), key, version).drop(BATCH)


def compact(
    spark: SparkSession, path: str, key: Sequence[str], version: Sequence[str], scratch: str
) -> int:
    """Merge all batches but the newest into one; returns how many were merged.

    The newest batch may still be replayed by its stream, so it stays apart. The merged
    rows are added to the last of the merged batches before anything is removed: a reader may meet a
    change twice, never miss one, and ``read_current`` gives the same rows before, meanwhile and after.
    """
    changes = spark.read.parquet(path)
    batches = sorted(r[0] for r in changes.select(BATCH).distinct().collect())
    merged = batches[:-1]
    if len(merged) < 2:
        return 0
    last = merged[-1]
    older = changes.where(F.col(BATCH) <= last)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    # Of rows without a key those of the kept folder are there already.
    state = _current(older, key, version).where(whole | (F.col(BATCH) < last)).drop(BATCH)
    state.write.parquet(scratch)
    folder = path.rstrip("/")
    spark.read.schema(state.schema).parquet(scratch).write.mode("append").parquet(f"{folder}/{BATCH}={last}")
    for batch in merged[:-1]:
        remove_dir(spark, f"{folder}/{BATCH}={batch}")
    remove_dir(spark, scratch)
    return len(merged)
