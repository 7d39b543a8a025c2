"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def builder(
    app_name: str = "impactflow",
    *,
    shuffle_partitions: int | None = None,
    object_store: Mapping[str, str] | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession.Builder:
    """A session builder with the settings every job here relies on.

    The master and resources are left to spark-submit. ``object_store`` takes
    plain S3A option names (``endpoint``, ``path.style.access``, ...).
    """
    b = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        # A repeated field in a record is no error, its last value counts.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (object_store or {}).items():
        b = b.config(f"spark.hadoop.fs.s3a.{key}", value)
    for key, value in (extra or {}).items():
        b = b.config(key, value)
    return b


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def listed(spark: SparkSession, glob: str) -> list[tuple[str, int]]:
    """(path, time of modification in milliseconds) of what matches, none if nothing does; for a few paths."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [(s.getPath().toString(), s.getModificationTime()) for s in found or ()]


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Falls back to a machine-local folder only for a local master, where there
    is just one machine to lose.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.sparkContext.getCheckpointDir()
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="impactflow-")
    return f"{base.rstrip('/')}/impactflow/{purpose}-{uuid.uuid4().hex}"
