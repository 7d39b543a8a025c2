"""Streams that lose nothing behind the watermark: late rows are kept, and forgotten keys are found in the sink.

Both write in ``foreachBatch`` to folders that bear the batch's number, so a batch that runs again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import listed, remove_dir
from .posts import LATENESS, TRIGGER, start, stream_dedup, with_watermark

ARRIVAL, LATE, ON_TIME = "arrival", "late", "on_time"
BUCKET, BATCH = "_bucket", "_batch"
ROWS, MARKS, STAGED = "rows", "marks", "staged"


def stream_split_late(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    time: str = "event_time",
    lateness: str = LATENESS,
    available_now: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """Write every row of a stream, marked by whether it came behind the watermark.

    The watermark is Spark's own: the greatest time of all batches before, to the millisecond, less ``lateness``; a row at or
    below it is late. Rows without time are on time. What a watermark downstream would only count is a table here (``read_split``). The
    mark of a batch is one row beside its files, made from that of the batch before, so a batch reads nothing older.
    ``df`` has no column named like the added one.
    """
    base = path.rstrip("/")

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = f"{base}/{MARKS}/{BATCH}="
        newest = None
        if batch_id:  # every batch leaves a mark; a missing one is an error, as late rows would pass
            newest = spark.read.schema("newest long").parquet(f"{marks}{batch_id - 1}").first()[0]
        event = F.col(time).cast("timestamp")
        late = F.lit(False)
        if newest is not None:
            late = F.coalesce(event <= F.expr(f"timestamp_millis({newest}) - INTERVAL {lateness}"), F.lit(False))
        folder = f"{base}/{ROWS}/{BATCH}={batch_id}"
        marked = batch.withColumn(ARRIVAL, F.when(late, LATE).otherwise(ON_TIME))
        marked.write.mode("overwrite").partitionBy(ARRIVAL).parquet(folder)
        written = listed(spark, f"{folder}/{ARRIVAL}=*")
        if written:  # the time column of what was just written; the batch itself is not evaluated again
            times = spark.read.schema(batch.schema).parquet(*(p for p, _ in written))
            here = times.agg(F.max(F.unix_millis(event)).alias("newest"))
        else:
            here = spark.createDataFrame([(None,)], "newest long")
        here.select(F.greatest("newest", F.lit(newest).cast("long")).alias("newest")).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{marks}{batch_id}")

    return start(df.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint), available_now, interval)


def read_split(spark: SparkSession, path: str, schema: StructType, arrival: str | None = None) -> DataFrame:
    """The rows that ``stream_split_late`` wrote, with ``arrival``; or those of one arrival, by their folders alone."""
    full = StructType([*schema.fields]).add(BATCH, "long").add(ARRIVAL, "string")
    rows = spark.read.schema(full).parquet(f"{path.rstrip('/')}/{ROWS}").drop(BATCH)
    return rows if arrival is None else rows.where(F.col(ARRIVAL) == arrival)


def stream_once(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    *,
    buckets: int,
    time: str = "event_time",
    lateness: str = LATENESS,
    available_now: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """First arrival per key over all time, with state for the keys within the watermark alone.

    State drops a key once the watermark has passed it. A copy that comes later than that is found in the sink, which is
    partitioned by a hash of the key: only the buckets that a batch has keys of are read, and of them only the keys. Null is a
    key like others. Rows behind the watermark are dropped, as in any watermarked stream; put ``stream_split_late`` before to
    keep them. ``buckets`` holds for the sink's life. Each batch adds one folder to the buckets it has keys of.
    """
    keys, base = list(keys), path.rstrip("/")
    once = stream_dedup(with_watermark(df, time, lateness), keys, bounded=True)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{base}/{STAGED}/{BATCH}={batch_id}"
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        batch.withColumn(BUCKET, bucket).write.mode("overwrite").partitionBy(BUCKET).parquet(staged)
        touched = [p.split("/")[-1] for p, _ in listed(spark, f"{staged}/{BUCKET}=*")]
        if touched:
            full = StructType([*batch.schema.fields]).add(BUCKET, "integer")
            fresh = spark.read.schema(full).option("basePath", staged).parquet(*(f"{staged}/{b}" for b in touched))
            there = {p.split("/")[-1] for p, _ in listed(spark, f"{base}/{ROWS}/{BUCKET}=*")}
            earlier = [f"{base}/{ROWS}/{b}" for b in touched if b in there]
            if earlier:
                fresh = _unseen(fresh, _stored(spark, base, batch.schema, earlier).where(F.col(BATCH) < batch_id), keys)
            fresh.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(BUCKET, BATCH).parquet(f"{base}/{ROWS}")
        remove_dir(spark, staged)

    writer = once.writeStream.foreachBatch(add).outputMode("append").option("checkpointLocation", checkpoint)
    return start(writer, available_now, interval)


def _unseen(fresh: DataFrame, earlier: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored. Stored keys are cut down to the batch's first, so that the batch, which is
    small, may be broadcast to them and they need no shuffle."""
    both = [BUCKET, *keys]

    def same(a: DataFrame, b: DataFrame):
        return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"_{k}"]) for k in both))

    asked = fresh.select(*(F.col(k).alias(f"_{k}") for k in both))
    stored = earlier.select(*both)
    known = stored.join(asked, same(stored, asked), "left_semi")
    known = known.select(*(F.col(k).alias(f"_{k}") for k in both))
    return fresh.join(known, same(fresh, known), "left_anti")


def _stored(spark: SparkSession, base: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
    full = StructType([*schema.fields]).add(BUCKET, "integer").add(BATCH, "long")
    return spark.read.schema(full).option("basePath", f"{base}/{ROWS}").parquet(*folders)


def read_once(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that ``stream_once`` has written."""
    base = path.rstrip("/")
    return _stored(spark, base, schema, [f"{base}/{ROWS}"]).drop(BUCKET, BATCH)
