"""Key tables stored in hash buckets, so that joins on the key need no exchange.

Below a table's folder lie ``rows``, one file for each bucket, sorted by key, and ``spec`` with the key and the number of
buckets, written last. Tables with the same number of buckets and the same type of key line up bucket by bucket. One bucket is one task
of a join: choose buckets by the larger table. A key that holds a great part of all rows makes its bucket large; where that is to
be expected, join tables that are not bucketed, as Spark splits hot partitions only behind an exchange.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEY = "_k"


def write_key_table(df: DataFrame, path: str, key: Column, buckets: int) -> None:
    """Write the rows that have a key, with the key as ``_k``. Rows without one never match and stay out.

    ``path`` is a new folder: a table that is being read cannot be replaced in place, so write beside it.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    keyed = df.withColumn(KEY, key).where(F.col(KEY).isNotNull())
    name = f"bucketed_{uuid.uuid4().hex}"
    # Dealt as the buckets are, so each bucket is one file.
    (
        keyed.repartition(buckets, KEY)
        .write.format("parquet")
        .mode("errorifexists")
        .bucketBy(buckets, KEY)
        .sortBy(KEY)
        .option("path", f"{base}/rows")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the entry in the catalog; the files belong to the path
    spec = json.dumps({"schema": keyed.schema.jsonValue(), "buckets": buckets})
    spark.createDataFrame([(spec,)], "value string").coalesce(1).write.text(f"{base}/spec")


def read_key_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a key table; Spark knows how they are dealt and sorted. A table without its spec is not whole: an error."""
    base = path.rstrip("/")
    spec = json.loads(spark.read.text(f"{base}/spec", wholetext=True).first()[0])
    schema = StructType.fromJson(spec["schema"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
        f"INTO {spec['buckets']} BUCKETS LOCATION '{base}/rows'"
    )
    df = spark.table(name)
    df.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return df
