"""Scans and sinks: the tables go out through a sink and come back through a source.

Folders are new ones below the shared checkpoint folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.clean import dedup_keep_last
from ...operators.scoring import gold_projection
from ...session import scratch_dir
from ...sinks import contract, tables, versions
from ...sources import files, jsonl
from .registry import query, table
from .scoring import GOLD_SQL, scored, shown_gold

EVENT_FIELDS = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double"}


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON lines; those of type 'error' lose their closing brace. Some have a field twice, the last value
    counts, and some a number that is none."""
    line = F.to_json(F.struct(*EVENT_FIELDS))
    broken = F.substring(line, F.lit(1), F.length(line) - 1)
    twice = F.concat(F.lit('{"event_id":-1,'), F.substring(line, F.lit(2), F.length(line)))
    odd = F.concat(broken, F.lit(',"rate":NaN}'))
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.when(kind == "error", broken)
        .when(kind == "click", twice)
        .when(kind == "view", odd)
        .otherwise(line)
        .alias("value")
    )


@query(
    "scan_jsonl_tolerant",
    """SELECT 'record' AS kind, event_id, user_id, event_type, value FROM events
    WHERE event_type <> 'error'
    UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL FROM events WHERE event_type = 'error'""",
)
def scan_jsonl_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "jsonl")
    files.land_raw(event_lines(spark, sf), folder, "20240101")
    scan = jsonl.scan_jsonl(spark, f"{folder}/*", EVENT_FIELDS)
    return scan.records.select(F.lit("record").alias("kind"), *EVENT_FIELDS).unionByName(
        scan.rejects.select(F.lit("reject").alias("kind")), allowMissingColumns=True
    )


@query(
    "scan_jsonl_report",
    """SELECT count(*) AS lines, count(*) FILTER (WHERE event_type <> 'error') AS records,
    count(*) FILTER (WHERE event_type = 'error') AS invalid_lines FROM events""",
)
def scan_jsonl_report(spark: SparkSession, sf: str) -> DataFrame:
    return jsonl.parse_lines(event_lines(spark, sf), EVENT_FIELDS).report


@query(
    "scan_jsonl_strict",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""",
)
def scan_jsonl_strict(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "jsonl")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
    )
    orders.write.json(folder)
    return jsonl.scan_jsonl_strict(spark, folder, dict(orders.dtypes)).drop(jsonl.ARRIVAL)


@query("scan_parquet", "SELECT p_partkey, p_brand FROM part WHERE p_size >= 25")
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    parts = files.scan_parquet(spark, f"{sf}/part.parque*")
    return parts.where("p_size >= 25").select("p_partkey", "p_brand")


@query("latest_snapshot", "SELECT o_orderkey, o_orderstatus FROM orders")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "snapshots")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables.write_parquet(orders.where("o_orderstatus = 'F'"), f"{folder}/orders_20240101")
    tables.write_parquet(orders, f"{folder}/orders_20240102")
    newest = files.latest_snapshot(spark, f"{folder}/orders_*", folders=True)
    return files.scan_parquet(spark, newest)


@query(
    "scan_microbatches",
    """SELECT user_id, max_by(event_id, (CAST(ts AS DATE), event_id)) AS event_id
    FROM events GROUP BY user_id""",
)
def scan_microbatches(spark: SparkSession, sf: str) -> DataFrame:
    """One landing folder per day; the last record of a user in landing order."""
    folder = scratch_dir(spark, "microbatches")
    lines = table(spark, sf, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("batch"),
        "event_id",
        F.to_json(F.struct(*EVENT_FIELDS)).alias("value"),
    )
    ordered = lines.repartitionByRange("batch", "event_id").sortWithinPartitions(
        "batch", "event_id"
    )
    ordered.drop("event_id").write.partitionBy("batch").text(folder)
    records = jsonl.scan_microbatches(spark, folder, EVENT_FIELDS, "*/*").records
    return dedup_keep_last(records, ["user_id"], [jsonl.ARRIVAL]).select("user_id", "event_id")


@query(
    "head_sample",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10000",
)
def head_sample(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return files.head_sample(orders, ["o_orderkey"], 10_000)


@query(
    "input_inventory",
    """SELECT 'o_orderstatus=' || o_orderstatus AS folder, true AS has_files, true AS has_bytes,
    count(*) AS rows FROM orders GROUP BY o_orderstatus""",
)
def input_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Files and bytes per partition folder, next to the rows found in it."""
    folder = scratch_dir(spark, "inventory")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables.write_parquet(orders, folder, partition_by=["o_orderstatus"])
    per_folder = (
        files.list_files(spark, f"{folder}/*/*.parquet")
        .groupBy(F.element_at(F.split("path", "/"), -2).alias("folder"))
        .agg(
            (F.count("*") > 0).alias("has_files"),
            (F.sum("size_bytes") > 0).alias("has_bytes"),
        )
    )
    rows = (
        files.scan_parquet(spark, folder)
        .groupBy(F.concat(F.lit("o_orderstatus="), "o_orderstatus").alias("folder"))
        .agg(F.count("*").alias("rows"))
    )
    return per_folder.join(rows, "folder")


@query("land_raw", "SELECT props AS value, count(*) AS n FROM events GROUP BY props")
def land_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Landed lines come back unchanged, repeats included."""
    folder = scratch_dir(spark, "landing")
    files.land_raw(table(spark, sf, "events").select("props"), folder, "20240101")
    return spark.read.text(f"{folder}/batch=20240101").groupBy("value").agg(
        F.count("*").alias("n")
    )


@query("sink_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "customer")
    tables.write_parquet(table(spark, sf, "customer").drop("c_mktsegment"), folder)
    return files.scan_parquet(spark, folder)


@query("sink_rebuild", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Rebuilt as a whole, then again in one partition: no row twice, none lost."""
    folder = scratch_dir(spark, "rebuild")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for _ in range(2):
        tables.rebuild(orders, folder, partition_by=["o_orderstatus"])
    tables.rebuild(
        orders.where("o_orderstatus = 'F'"),
        folder,
        partition_by=["o_orderstatus"],
        only_touched_partitions=True,
    )
    return versions.read_table(spark, folder)


@query("sink_keyed_overwrite", GOLD_SQL)
def sink_keyed_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    staged, target = scratch_dir(spark, "staged"), scratch_dir(spark, "gold")
    tables.write_parquet(gold_projection(scored(spark, sf)), staged)
    for _ in range(2):
        tables.keyed_overwrite(files.scan_parquet(spark, staged), target, "paper_id")
    return shown_gold(versions.read_table(spark, target))


@query(
    "publish_versions",
    """SELECT 1 AS version, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 2, o_orderkey, o_orderstatus FROM orders
    UNION ALL SELECT 3, o_orderkey, o_orderstatus FROM orders""",
)
def publish_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of a table, all readable; a fourth fails its check and leaves no trace. The third has new files in
    one partition only."""
    folder = scratch_dir(spark, "versions")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    finished = orders.where("o_orderstatus = 'F'")
    for df, touched in ((finished, False), (orders, False), (finished, True)):
        versions.publish(df, folder, partition_by=["o_orderstatus"], only_touched_partitions=touched)

    def refuse(_: DataFrame) -> None:
        raise ValueError("not fit")

    try:
        versions.publish(finished, folder, partition_by=["o_orderstatus"], check=refuse)
    except ValueError:
        pass
    rows = [versions.read_table(spark, folder, n).select(F.lit(n).alias("version"), "*") for n in versions.versions(spark, folder)]
    return reduce(DataFrame.unionByName, rows)


UPSERT_SQL = """batch AS (
      SELECT o_custkey AS c_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS balance
      FROM orders GROUP BY 1
      UNION ALL SELECT -1 - s_suppkey, CAST(s_acctbal AS DECIMAL(18,2)) FROM supplier)"""


def balances(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customer balances, and a newer batch with changed, new and keyless rows."""
    base = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        F.lit(0).alias("version"),
    )
    changed = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("balance"))
    )
    suppliers = table(spark, sf, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
    )
    keyless = suppliers.withColumn("c_custkey", F.lit(None).cast("bigint"))
    batch = changed.unionByName(suppliers).unionByName(keyless)
    return base, batch.withColumn("version", F.lit(1))


@query(
    "upsert_by_key",
    f"""WITH {UPSERT_SQL}
    SELECT c_custkey, CAST(balance AS DOUBLE) AS balance, 'merged' AS part FROM batch
    UNION ALL SELECT c_custkey, c_acctbal, 'merged' FROM customer
      WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
    UNION ALL SELECT NULL, s_acctbal, 'rejected' FROM supplier""",
)
def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """The batch is applied twice; the second time changes nothing."""
    base, batch = balances(spark, sf)
    once, _ = tables.upsert_by_key(base, batch, "c_custkey", ["version"])
    merged, rejects = tables.upsert_by_key(once, batch, "c_custkey", ["version"])
    return (
        merged.withColumn("part", F.lit("merged"))
        .unionByName(rejects.withColumn("part", F.lit("rejected")))
        .select("c_custkey", F.col("balance").cast("double").alias("balance"), "part")
    )


@query(
    "upsert_buckets",
    f"""WITH {UPSERT_SQL}
    SELECT c_custkey, CAST(balance AS DOUBLE) AS balance, 'merged' AS part FROM batch
    UNION ALL SELECT c_custkey, c_acctbal, 'merged' FROM customer
      WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
    UNION ALL SELECT NULL, s_acctbal, 'rejected' FROM supplier""",
)
def upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """As ``upsert_by_key``, into a table of buckets; the second time changes nothing."""
    folder, staged = scratch_dir(spark, "buckets"), scratch_dir(spark, "staged")
    base, batch = balances(spark, sf)
    versions.create_bucketed(base, folder, ["c_custkey"], 8)
    tables.write_parquet(batch, staged)
    for _ in range(2):
        done = versions.upsert_buckets(files.scan_parquet(spark, staged), folder, ["version"])
    merged = versions.read_bucketed(spark, folder).withColumn("part", F.lit("merged"))
    return merged.unionByName(done.rejects.withColumn("part", F.lit("rejected"))).select(
        "c_custkey", F.col("balance").cast("double").alias("balance"), "part"
    )


@query(
    "upsert_report",
    f"""WITH {UPSERT_SQL} SELECT count(*) + (SELECT count(*) FROM supplier) AS batch_rows,
    (SELECT count(*) FROM supplier) AS rejected,
    count(*) FILTER (WHERE c_custkey < 0) AS inserted_keys,
    count(*) FILTER (WHERE c_custkey >= 0) AS updated_keys FROM batch""",
)
def upsert_report(spark: SparkSession, sf: str) -> DataFrame:
    base, batch = balances(spark, sf)
    return tables.upsert_report(base, batch, "c_custkey")


@query(
    "part_report",
    f"""WITH {UPSERT_SQL} SELECT c_custkey < 0 AS is_new, count(*) AS rows, count(*) AS accepted,
    0 AS rejected FROM batch GROUP BY 1
    UNION ALL SELECT NULL, count(*), 0, count(*) FROM supplier""",
)
def part_report(spark: SparkSession, sf: str) -> DataFrame:
    _, batch = balances(spark, sf)
    parts = batch.withColumn("is_new", F.col("c_custkey") < 0)
    return tables.part_report(parts, "c_custkey", "is_new")


CONTRACT = contract.PAPER_DOCUMENT | {"object_count": "int", "timestamp": "timestamp"}


@query(
    "schema_conformance",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'published_date'
      WHEN event_type = 'view' THEN 'title' WHEN event_type = 'click' THEN '<not an object>'
      WHEN event_type = 'signup' THEN 'categories' WHEN event_id % 3 = 0 THEN 'object_count'
      WHEN event_id % 3 = 1 THEN 'timestamp' ELSE '' END AS bad_fields,
      event_type = 'purchase' AND event_id % 3 = 2 AS conforms,
      CASE WHEN event_type = 'purchase' AND event_id % 3 = 2 THEN 7 END AS object_count FROM events""",
)
def schema_conformance(spark: SparkSession, sf: str) -> DataFrame:
    """Strict document layout: an extra field, wrong kinds (also of an element), a broken line, a
    number and a time that the type cannot hold."""
    kind, third = F.col("event_type"), F.col("event_id") % 3
    # Few bytes and much work a row: the file's own splits would leave it to a few tasks.
    events = table(spark, sf, "events").repartition("event_id").select(
        "event_id",
        F.concat(
            F.lit('{"id":"'),
            "event_id",
            F.when(kind == "view", F.lit('","title":5')).otherwise(F.lit('","title":"t"')),
            F.when(kind == "error", F.lit(',"published_date":"2024-01-01"')).otherwise(""),
            F.when(kind == "signup", F.lit(',"categories":[1,{"a":2}]')).otherwise(
                F.lit(',"categories":["a",null]')
            ),
            F.when((kind == "purchase") & (third == 0), F.lit(',"object_count":3000000000'))
            .when((kind == "purchase") & (third == 1), F.lit(',"timestamp":"soon"'))
            .otherwise(F.lit(',"object_count":7,"timestamp":"2024-01-01T00:00:00Z"')),
            F.when(kind == "click", "").otherwise("}"),
        ).alias("value"),
    )
    checked = contract.check_records(events, CONTRACT)
    conforms = F.size("bad_fields") == 0
    return checked.select(
        "event_id",
        F.concat_ws(",", "bad_fields").alias("bad_fields"),
        conforms.alias("conforms"),
        F.when(conforms, F.col("record.object_count")).alias("object_count"),
    )
