"""A ledger of the files that have been read, so that a refresh reads only new ones.

The ledger is a folder with one part for each run: (path, size_bytes, modified). A run is entered after
its rows have been published. If it is lost in between, the next one reads the same files again, and merging them again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import listed
from .files import list_files

ENTRY = ["path", "size_bytes", "modified"]
LAYOUT = "path string, size_bytes bigint, modified timestamp, run_id string"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Every file that a run has read: path, size_bytes, modified, run_id."""
    if not listed(spark, f"{ledger.rstrip('/')}/run_id=*"):
        return spark.createDataFrame([], LAYOUT)
    return spark.read.schema(LAYOUT).parquet(ledger)


def new_files(spark: SparkSession, raw: str, ledger: str) -> DataFrame:
    """Files below ``raw`` that no run has read as they are: others, or of another size or time."""
    return list_files(spark, raw).select(*ENTRY).join(read_ledger(spark, ledger), ENTRY, "left_anti")


def enter(files: DataFrame, ledger: str, run_id: str) -> None:
    """Add a run's files. A file that is entered twice counts as read, as once."""
    files.select(*ENTRY).write.mode("append").parquet(f"{ledger.rstrip('/')}/run_id={run_id}")


def summary(spark: SparkSession, ledger: str) -> DataFrame:
    """(run_id, files, size_bytes) of each run that read any."""
    return read_ledger(spark, ledger).distinct().groupBy("run_id").agg(
        F.count("*").alias("files"), F.sum("size_bytes").alias("size_bytes")
    )
