"""Parquet scans, file inventories, snapshots, samples and raw landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """Parquet scan of a file, folder, glob or list of them."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file: path, name, size_bytes, modified. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(path if isinstance(path, str) else list(path))
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def inventory_of(files: DataFrame) -> DataFrame:
    """One row over listed files: files, size_bytes, newest."""
    return files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
        F.max("modified").alias("newest"),
    )


def input_inventory(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row: files, size_bytes, newest. FileNotFoundError if nothing matches."""
    try:
        files = list_files(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no input below {path}") from e
        raise
    return inventory_of(files)


def latest_snapshot(spark: SparkSession, path: str, *, folders: bool = False) -> str:
    """Path of the last member (by name) of a stamped family such as ``works_*.jsonl``.

    With ``folders`` the members are folders, as Spark writes them. Brings one
    path to the driver, because a read needs it.
    """
    try:
        files = list_files(spark, f"{path.rstrip('/')}/*" if folders else path)
        if folders:
            files = files.where(~F.col("name").rlike(r"^[_.]")).select(
                F.regexp_replace("path", r"/[^/]*$", "").alias("path")
            )
        newest = files.agg(F.max("path")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        raise FileNotFoundError(f"no snapshot matches {path}")
    return newest


def head_sample(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order, as a profiling sample.

    A bounded top-n: each task keeps n rows, so n must stay small. The profile
    and rule operators take whole tables; a sample is opt-in.
    """
    return df.orderBy(*order).limit(n)


def land_raw(lines: DataFrame, folder: str, batch: str) -> None:
    """Append raw lines unchanged under ``batch=<stamp>``; no cleaning, no dedup.

    ``lines`` has a single string column. A rerun of the same batch replaces it.
    """
    lines.write.mode("overwrite").text(f"{folder.rstrip('/')}/batch={batch}")
