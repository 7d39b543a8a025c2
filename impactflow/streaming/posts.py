"""A file stream of post records, cleaned by the batch functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.clean import clean_posts
from ..session import ROCKSDB_PROVIDER
from ..sinks.tables import append_changes
from ..sources.jsonl import POST_FIELDS, parse_lines

FILES_PER_TRIGGER = 10
TRIGGER = "30 seconds"
LATENESS = "7 days"
# Progress reports a query keeps between two looks at them.
KEPT_REPORTS = 10_000


def stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session for streams that leaves the caller's settings alone.

    State lives in RocksDB in ``state_partitions`` parts. The first run of a checkpoint settles that
    number for good, so choose it for the state expected later. Settings the caller made at run time
    hold here too.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    own.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(KEPT_REPORTS))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    format: str = "json",
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """File stream with an explicit schema and bounded micro-batches."""
    return (
        spark.readStream.format(format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def stream_records(
    spark: SparkSession, path: str, *, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """Raw post records from a stream of JSONL files; bad lines are left out,
    mistyped values become NULL, exactly as in the batch scan."""
    lines = stream_files(
        spark, path, "value string", format="text", files_per_trigger=files_per_trigger
    )
    return parse_lines(lines, POST_FIELDS).records


def stream_clean(raw: DataFrame) -> DataFrame:
    """The batch cleaner; it only uses stateless expressions."""
    return raw.transform(clean_posts)


def with_watermark(df: DataFrame, time: str = "event_time", lateness: str = LATENESS) -> DataFrame:
    """Bound lateness by event time. Zone-less timestamps are read as UTC."""
    if dict(df.dtypes)[time] == "timestamp_ntz":
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    return df.withWatermark(time, lateness)


def stream_dedup(df: DataFrame, keys: Sequence[str], *, bounded: bool = False) -> DataFrame:
    """First arrival per key.

    By default a key is remembered for good: exact, with state growing by one
    entry per key (the RocksDB store keeps it off the heap). ``bounded`` forgets
    a key once the watermark passes it, so a copy arriving later than that may
    appear again; re-deduplicate at read if that matters.
    """
    keys = list(keys)
    return df.dropDuplicatesWithinWatermark(keys) if bounded else df.dropDuplicates(keys)


def start(writer, available_now: bool, interval: str) -> StreamingQuery:
    """Start a query that ends with what is there, or runs on."""
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def stream_to_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """Append to Parquet; the checkpoint makes a restart carry on where it stopped."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, available_now, interval)


def stream_changes(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    interval: str = TRIGGER,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Every micro-batch becomes one replayable change folder (see ``read_current``),
    so the latest version of a key wins as it does in batch."""
    writer = (
        df.writeStream.foreachBatch(
            lambda batch, batch_id: append_changes(prepare(batch), batch_id, path)
        )
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, available_now, interval)


def finish(query: StreamingQuery, poll: float = 0.5) -> dict[str, int]:
    """Wait for an available-now query; returns input rows, late rows, state rows.

    A query keeps its last progress reports only, so they are added up while it runs, each batch
    once. Should reports be lost between two looks, that is an error and not a smaller total.
    """
    batches: dict[int, tuple[int, int]] = {}
    state_rows = 0
    done = False
    while not done:
        done = query.awaitTermination(poll)
        for progress in query.recentProgress:
            operators = progress["stateOperators"]
            late = sum(op["numRowsDroppedByWatermark"] for op in operators)
            state_rows = max([state_rows, *(op["numRowsTotal"] for op in operators)])
            was = batches.get(progress["batchId"], (0, 0))
            batches[progress["batchId"]] = (max(was[0], progress["numInputRows"]), max(was[1], late))
    if batches and len(batches) != max(batches) - min(batches) + 1:
        raise RuntimeError("progress reports were lost; raise spark.sql.streaming.numRecentProgressUpdates")
    return {
        "input_rows": sum(n for n, _ in batches.values()),
        "late_rows": sum(n for _, n in batches.values()),
        "state_rows": state_rows,
    }
