"""Tables that are always whole: new versions are written beside the old, and a manifest is put in place last.

Below a table's folder lie ``data/_written=<id>`` with the files of each write, and ``manifest/<version>-<id>`` with one
small file that lists the parts of a version: for each partition the folder it is in, so a version can take over
parts of the one before as they are. A reader takes the newest manifest that has its file. A run that is lost before that leaves
files that nothing refers to; ``retire`` removes them, and old versions, by age.

One writer at a time: of two that publish the same version, the one with the greater id withdraws and fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.clean import dedup_keep_last
from ..session import listed, remove_dir

DATA, MANIFEST, WRITTEN = "data", "manifest", "_written"
BUCKET, BATCH_FLAG = "_bucket", "_from_batch"


class PublishConflict(RuntimeError):
    """Another writer has published the same version."""


@dataclass(frozen=True)
class Version:
    """What a manifest says: parts by partition folder ('' if there are none), relative to the table."""

    number: int
    schema: StructType
    parts: Mapping[str, str]
    partition_by: tuple[str, ...] = ()
    properties: Mapping[str, str] = field(default_factory=dict)


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, folder) of every manifest that has its file, in order; of one version the valid one comes last."""
    names = {p.split("/")[-2] for p, _ in listed(spark, f"{path.rstrip('/')}/{MANIFEST}/*/*.json")}
    return sorted(((int(n.split("-")[0]), n) for n in names), key=lambda x: (-x[0], x[1]))[::-1]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return sorted({n for n, _ in _manifests(spark, path)})


def resolve(spark: SparkSession, path: str, version: int | None = None) -> Version | None:
    """The newest version, or the one asked for; None if the table has never been published."""
    found = [m for m in _manifests(spark, path) if version in (None, m[0])]
    if not found:
        if version is not None:
            raise FileNotFoundError(f"{path} has no version {version}")
        return None
    number, name = found[-1]
    text = spark.read.text(f"{path.rstrip('/')}/{MANIFEST}/{name}", wholetext=True).first()[0]
    said = json.loads(json.loads(text)["value"])
    return Version(number, StructType.fromJson(said["schema"]), said["parts"], tuple(said["partition_by"]), said["properties"])


def _scan(spark: SparkSession, path: str, version: Version, parts: Sequence[str] | None = None) -> DataFrame:
    base = path.rstrip("/")
    wanted = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
    if not wanted:
        return spark.createDataFrame([], version.schema)
    reader = spark.read.schema(version.schema).option("basePath", f"{base}/{DATA}")
    return reader.parquet(*(f"{base}/{f}" for f in wanted.values())).select(*(f"`{n}`" for n in version.schema.names))


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an older one. FileNotFoundError if there is none."""
    found = resolve(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no table has been published at {path}")
    return _scan(spark, path, found)


def part_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of the newest version's parts, for an inventory of its files."""
    found = resolve(spark, path)
    return [] if found is None else [f"{path.rstrip('/')}/{f}" for f in found.parts.values()]


def publish(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    rows_per_file: int = 0,
    only_touched_partitions: bool = False,
    check: Callable[[DataFrame], None] | None = None,
    properties: Mapping[str, str] | None = None,
) -> Version:
    """Replace a table by ``df``, which is evaluated once; readers see all of it or the version before.

    With ``only_touched_partitions`` the partitions that ``df`` does not have are taken over from the version before, their files untouched.
    ``check`` gets the written rows before they are published; what it raises leaves the table as it was. ``df`` may read the table itself.
    Partition values are few: their folders are listed in the manifest.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    before = resolve(spark, base)
    if only_touched_partitions and before is not None and tuple(partition_by) != before.partition_by:
        raise ValueError(f"{path} is partitioned by {before.partition_by}, not {tuple(partition_by)}")
    # The reader gives data columns first, then partitions.
    names = [c for c in df.columns if c not in partition_by] + list(partition_by)
    schema = StructType([StructField(n, df.schema[n].dataType) for n in names])
    name = uuid.uuid4().hex
    folder = f"{DATA}/{WRITTEN}=r{name}"
    writer = df.write.option("compression", "snappy")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{folder}")
    parts = {"": folder}
    if partition_by:
        depth = len(partition_by)
        found = {"/".join(p.split("/")[-1 - depth : -1]) for p, _ in listed(spark, f"{base}/{folder}/{'*/' * depth}*.parquet")}
        parts = {p: f"{folder}/{p}" for p in sorted(found)}
    new = Version((before.number if before else 0) + 1, schema, parts, tuple(partition_by), dict(properties or (before.properties if before else {})))
    if check is not None:
        try:
            check(_scan(spark, base, new))
        except BaseException:
            remove_dir(spark, f"{base}/{folder}")
            raise
    if only_touched_partitions and before is not None:
        wider = [f for f in before.schema if f.name not in schema.names]
        fields = [*(f for f in schema if f.name not in partition_by), *wider, *(schema[p] for p in partition_by)]
        new = Version(new.number, StructType(fields), {**before.parts, **parts}, new.partition_by, new.properties)
    said = {"schema": json.loads(new.schema.json()), "parts": dict(new.parts), "partition_by": list(new.partition_by), "properties": dict(new.properties)}
    manifest = f"{new.number:012d}-{name}"
    # One row, so one file: it is there whole or not at all.
    spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.json(f"{base}/{MANIFEST}/{manifest}")
    rivals = [n for v, n in _manifests(spark, base) if v == new.number]
    if min(rivals) != manifest:
        remove_dir(spark, f"{base}/{MANIFEST}/{manifest}")
        raise PublishConflict(f"version {new.number} of {path} was published by another writer")
    return new


def retire(spark: SparkSession, path: str, before: str | Column, keep: int = 1) -> int:
    """Remove versions published before a time, but never the ``keep`` newest, and files of that age that no version has.

    Manifests go first, so a version that can be resolved is whole. Returns how many versions went. Jobs that still read an old version,
    or write a new one, must be younger than ``before``.
    """
    if keep < 1:
        raise ValueError("the newest version is never retired")
    base = path.rstrip("/")
    age = F.lit(before).cast("timestamp") if isinstance(before, str) else before
    limit = spark.range(1).select(F.unix_millis(age)).first()[0]
    old = {p.split("/")[-2] for p, t in listed(spark, f"{base}/{MANIFEST}/*/*.json") if t < limit}
    gone = old & {n for _, n in _manifests(spark, base)[:-keep]}
    for name in gone:
        remove_dir(spark, f"{base}/{MANIFEST}/{name}")
    used = {f.split("/")[1] for n in versions(spark, base) for f in resolve(spark, base, n).parts.values()}
    for folder, t in listed(spark, f"{base}/{DATA}/{WRITTEN}=*"):
        if t < limit and folder.split("/")[-1] not in used:
            remove_dir(spark, folder)
    return len(gone)


def _bucket(key: Sequence[str], buckets: int) -> Column:
    """Number of the key's bucket; rows without a whole key are in bucket -1."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return F.when(whole, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")).otherwise(F.lit(-1))


def create_bucketed(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> Version:
    """Publish a keyed table in ``buckets`` parts by the hash of its key, as ``upsert_buckets`` merges into.

    A bucket is what one task merges: choose the number so that one is a few hundred megabytes.
    """
    dealt = df.withColumn(BUCKET, _bucket(key, buckets)).repartition(buckets, BUCKET)
    return publish(dealt, path, partition_by=[BUCKET], properties={"key": ",".join(key), "buckets": str(buckets)})


@dataclass(frozen=True)
class Upserted:
    """What a merge did: the new version, the buckets it rewrote, and the rows without a key."""

    version: Version
    touched: tuple[int, ...]
    rejects: DataFrame


def upsert_buckets(
    batch: DataFrame, path: str, version: Sequence[str], dedup: Callable[..., DataFrame] = dedup_keep_last
) -> Upserted:
    """Merge ``batch`` into a bucketed table, as ``upsert_by_key`` does, reading and writing only the buckets of its keys.

    The rows of a bucket are shuffled by its number alone, once, and merged where they meet; all other buckets keep their
    files. At equal versions the row of the batch wins, so applying it twice changes nothing; with ``dedup_keep_first`` the lowest
    version wins. ``batch`` is read twice, so give a stored table. Columns that either side lacks become NULL.
    """
    spark = batch.sparkSession
    base = resolve(spark, path)
    if base is None or "buckets" not in base.properties:
        raise ValueError(f"{path} is no bucketed table")
    key, buckets = base.properties["key"].split(","), int(base.properties["buckets"])
    dealt = batch.withColumn(BUCKET, _bucket(key, buckets))
    incoming = dealt.where(F.col(BUCKET) >= 0)
    rejects = dealt.where(F.col(BUCKET) < 0).drop(BUCKET)
    touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())
    if not touched:
        return Upserted(base, (), rejects)
    held = _scan(spark, path, base, [f"{BUCKET}={b}" for b in touched])
    # Earlier of two equal versions is what keep-first takes, later what keep-last takes.
    first = dedup is not dedup_keep_last
    both = held.withColumn(BATCH_FLAG, F.lit(int(first))).unionByName(
        incoming.withColumn(BATCH_FLAG, F.lit(int(not first))), allowMissingColumns=True
    )
    met = both.repartition(len(touched), BUCKET)
    merged = dedup(met, [BUCKET, *key], [*version, BATCH_FLAG]).drop(BATCH_FLAG)
    return Upserted(publish(merged, path, partition_by=[BUCKET], only_touched_partitions=True), tuple(touched), rejects)


def read_bucketed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a bucketed table, without the bucket number."""
    return read_table(spark, path, version).drop(BUCKET)
