"""Streams over files, run until the input is used up, and read back.

Sinks and checkpoints lie in new folders below the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ...session import scratch_dir
from ...sinks.tables import read_current, write_parquet
from ...sources.files import land_raw
from ...streaming import exact as ex
from ...streaming import posts as st
from .cleaning import POSTS_CLEAN_SQL, raw_posts
from .registry import query, table


def own_session(spark: SparkSession) -> SparkSession:
    return st.stream_session(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))


def events_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return st.stream_files(own_session(spark), path, schema, format="parquet")


def table_stream(spark: SparkSession, sf: str) -> DataFrame:
    return events_stream(spark, f"{sf}/events.parque*", table(spark, sf, "events").schema)


def run(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run a stream once over what is there and read its sink."""
    folder = scratch_dir(spark, "stream")
    st.finish(
        st.stream_to_parquet(stream, f"{folder}/out", f"{folder}/state", available_now=True)
    )
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query(
    "stream_file_source",
    "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
)
def stream_file_source(spark: SparkSession, sf: str) -> DataFrame:
    out = run(spark, table_stream(spark, sf).select("event_id", "event_type"))
    return out.groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_parquet_sink", "SELECT event_id, user_id, event_type, value FROM events")
def stream_parquet_sink(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, table_stream(spark, sf).drop("ts", "props"))


STREAM_CLEAN_SQL = """SELECT user_id * 1000 + ascii(event_type) AS id, 'u' || user_id AS "by",
      CASE WHEN event_type <> 'signup'
        THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') END AS time,
      event_type AS title, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS score
    FROM events WHERE event_type <> 'error'"""


@query("stream_clean", STREAM_CLEAN_SQL)
def stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Raw post lines through the batch cleaner, as a stream; bad lines stay out."""
    folder = scratch_dir(spark, "landing")
    land_raw(raw_posts(spark, sf).select("value"), folder, "20240101")
    cleaned = st.stream_clean(st.stream_records(own_session(spark), f"{folder}/batch=*"))
    return run(spark, cleaned).select("id", "by", "time", "title", "score")


@query("stream_watermark", "SELECT event_id, event_type FROM events")
def stream_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """First arrival per event within the watermark."""
    marked = st.with_watermark(table_stream(spark, sf), "ts")
    once = st.stream_dedup(marked, ["event_id"], bounded=True)
    return run(spark, once.select("event_id", "event_type"))


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """First arrival per user and type. Which event that is depends on the order
    of rows within a micro-batch, so the keys are shown."""
    marked = st.with_watermark(table_stream(spark, sf), "ts")
    return run(spark, st.stream_dedup(marked, ["user_id", "event_type"])).select(
        "user_id", "event_type"
    )


def resumed(
    spark: SparkSession, parts: list[DataFrame], dedup: bool
) -> tuple[DataFrame, list[dict[str, int]]]:
    """Land parts one after the other; after each, restart the stream on the same
    checkpoint. Returns the sink's content and the totals of each run."""
    folder = scratch_dir(spark, "resume")
    totals = []
    for i, part in enumerate(parts):
        write_parquet(part, f"{folder}/in/part={i}")
        source = events_stream(spark, f"{folder}/in/*", parts[0].schema)
        marked = st.with_watermark(source, "ts")
        stream = st.stream_dedup(marked, ["event_id"]) if dedup else marked
        totals.append(
            st.finish(
                st.stream_to_parquet(
                    stream, f"{folder}/out", f"{folder}/state", available_now=True
                )
            )
        )
    return spark.read.parquet(f"{folder}/out"), totals


@query(
    "stream_resume",
    "SELECT event_id, event_type, value FROM events",
)
def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Three landings, the last a repeat of the second: every event exactly once."""
    events = table(spark, sf, "events").drop("props")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    out, _ = resumed(spark, [events.where(early), *[events.where(~early)] * 2], dedup=True)
    return out.select("event_id", "event_type", "value")


LATE_DAYS = 7


@query(
    "late_data",
    f"""WITH n AS (SELECT count(*) AS n, max(ts) AS newest FROM events)
    SELECT 'on time' AS arrival, count(*) AS n FROM events
    UNION ALL SELECT 'late, kept', count(*) FROM events, n
      WHERE ts > date_trunc('milliseconds', newest) - INTERVAL {LATE_DAYS} DAY
    UNION ALL SELECT 'late, dropped', 2 * count(*) FROM events, n
      WHERE ts <= date_trunc('milliseconds', newest) - INTERVAL {LATE_DAYS} DAY
    UNION ALL SELECT 'input', 3 * count(*) FROM events""",
)
def late_data(spark: SparkSession, sf: str) -> DataFrame:
    """All events arrive, then a repeat of them, then copies under new ids: the
    copies older than the watermark are dropped and counted, in the repeat as well."""
    events = table(spark, sf, "events").select("event_id", "ts")
    copies = events.withColumn("event_id", -1 - F.col("event_id"))
    out, totals = resumed(spark, [events, events, copies], dedup=True)
    arrival = F.when(F.col("event_id") >= 0, "on time").otherwise("late, kept")
    counts = [("late, dropped", sum(t["late_rows"] for t in totals)), ("input", sum(t["input_rows"] for t in totals))]
    return out.groupBy(arrival.alias("arrival")).agg(F.count("*").alias("n")).unionByName(
        spark.createDataFrame(counts, "arrival string, n bigint")
    )


def landings(spark: SparkSession, folder: str, parts: list[DataFrame]):
    """Land parts one after the other, each a single micro-batch of the stream given for it."""
    for i, part in enumerate(parts):
        write_parquet(part, f"{folder}/in/part={i}")
        yield st.stream_files(
            own_session(spark), f"{folder}/in/*", part.schema, format="parquet", files_per_trigger=1_000_000
        )


@query(
    "late_rows",
    f"""WITH n AS (SELECT max(ts) AS newest FROM events)
    SELECT event_id, event_type, epoch_us(ts) AS micros, 'on_time' AS arrival FROM events
    UNION ALL SELECT -1 - event_id, event_type, epoch_us(ts),
      CASE WHEN ts <= date_trunc('milliseconds', newest) - INTERVAL {LATE_DAYS} DAY THEN 'late' ELSE 'on_time' END
    FROM events, n""",
)
def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All events arrive, then copies under new ids: the copies behind the watermark are kept as late rows."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    copies = events.withColumn("event_id", -1 - F.col("event_id"))
    folder = scratch_dir(spark, "late")
    for stream in landings(spark, folder, [events, copies]):
        st.finish(
            ex.stream_split_late(
                stream, f"{folder}/out", f"{folder}/state", time="ts", lateness=f"{LATE_DAYS} days", available_now=True
            )
        )
    out = ex.read_split(spark, f"{folder}/out", events.schema)
    micros = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts").cast("timestamp"))
    return out.select("event_id", "event_type", micros.alias("micros"), "arrival")


@query(
    "stream_dedup_exact",
    "SELECT event_id, event_type, value, false AS copied FROM events",
)
def stream_dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    """All events arrive, then copies half a year and a year younger, when state has forgotten the ids: every event once, as it came first."""
    events = table(spark, sf, "events").drop("props").withColumn("copied", F.lit(False))
    parts = [
        events,
        *(
            events.withColumns({"ts": F.col("ts") + F.make_dt_interval(F.lit(days)), "copied": F.lit(True)})
            for days in (180, 360)
        ),
    ]
    folder = scratch_dir(spark, "once")
    for stream in landings(spark, folder, parts):
        st.finish(
            ex.stream_once(
                stream, f"{folder}/out", f"{folder}/state", ["event_id"], buckets=16, time="ts", available_now=True
            )
        )
    return ex.read_once(spark, f"{folder}/out", events.schema).select("event_id", "event_type", "value", "copied")


@query(
    "stream_upsert",
    f"""WITH {POSTS_CLEAN_SQL} SELECT user_id, event_type, event_id, value FROM last""",
)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batches stored as changes; reading gives the last version per key, as
    the batch deduplication does."""
    folder = scratch_dir(spark, "changes")
    stream = table_stream(spark, sf).where("event_type <> 'error'").drop("ts", "props")
    st.finish(
        st.stream_changes(stream, f"{folder}/out", f"{folder}/state", available_now=True)
    )
    current = read_current(spark, f"{folder}/out", ["user_id", "event_type"], ["event_id"])
    return current.select("user_id", "event_type", "event_id", "value")
