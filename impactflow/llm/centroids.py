"""Centroid clustering with a tournament of bisectors.

For centroids a < b, a vector x is nearer to b exactly if 2 (b - a) . x > |b|^2 - |a|^2: the sign of a linear function, in whole numbers.
Normals and thresholds of all pairs are computed once a round. A vector holds a tournament: the
winner so far meets the next centroid, and k - 1 sign tests leave the nearest one; zero favours the smaller
number, which is the winner so far. Only the last distance is computed, to the winner.

A task reads its vectors where they are and gives one sum for each centroid and component; only their totals reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, materialise, ship
from .vectors import _EXACT, means, numeric, usable, whole

WIDTH, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Vectors that hold their tournaments at a time.
BLOCK_ROWS = 4096
OUTPUT = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


class Bisectors:
    """Normals and thresholds of all pairs of centroids, as whole numbers."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        k, width = centroids.shape
        lengths = (centroids * centroids).sum(axis=1)
        a, b = np.triu_indices(k, 1)
        self.row = np.zeros((k, k), np.int64)
        self.row[a, b] = np.arange(len(a))
        self.normals = 2 * (centroids[b] - centroids[a])
        self.thresholds = lengths[b] - lengths[a]
        self._quick = self.normals.astype(np.float64)
        self._size = width * float(np.abs(self.normals).max(initial=0))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector, ties to the smaller one, and the squared distance to it."""
        winner = np.zeros(len(x), np.int64)
        exact = self._size * float(np.abs(x).max(initial=0)) < _EXACT
        own, normals = (x.astype(np.float64), self._quick) if exact else (x, self.normals)
        for other in range(1, len(self.centroids)):
            pair = self.row[winner, other]
            sign = np.einsum("ij,ij->i", normals[pair], own) - self.thresholds[pair]
            winner[sign > 0] = other
        off = x - self.centroids[winner]
        return winner, (off * off).sum(axis=1)


def _tables(batches: Iterator[pa.RecordBatch], scale: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the batches, the numbers of their usable rows, and those rows' vectors."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            piece = batch.slice(at, BLOCK_ROWS)
            rows, table = whole(piece.column("v"), scale, width, True)
            if len(rows):
                yield piece, rows, table


def first_centroids(df: DataFrame, key: str, vector: str, scale: int, width: int, k: int, seed: int) -> np.ndarray:
    """The usable vectors with the smallest SHA-256 of seed and identifier; ties to the lesser vector, null identifiers last."""
    some = df.where(usable(vector) & (F.size(vector) == width)).select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("long").cast("string")), 256).alias("h"), numeric(df, vector).alias("v")
    )
    first = some.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).toArrow()
    return whole(first.column("v").combine_chunks(), scale, width, True)[1]


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """The centroids after one round over ``vectors`` (v); empty clusters keep theirs."""
    k, width = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, total = Bisectors(centroids), np.zeros((k, width + 1), np.int64)
        for _, _, table in _tables(batches, scale, width):
            winner, _ = pairs.nearest(table)
            np.add.at(total, winner, np.column_stack([table, np.ones(len(table), np.int64)]))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    sums = np.zeros(k * (width + 1), np.int64)
    for r in vectors.mapInArrow(add, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        sums[r["at"]] = r["n"]
    sums = sums.reshape(k, width + 1)
    return means(sums[:, :width], sums[:, width], centroids)


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = WIDTH, scale: int = SCALE,
    k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED,
) -> DataFrame:
    """Key, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every usable vector.

    Usable are vectors of exactly ``width`` components, none null, NaN or infinite; all other rows are left out. A component x becomes
    floor(scale * x), held within LARGEST either way. Repeated rows, identifiers and vectors all count and all come back; rows with a null
    identifier come back with it, and are the last to become a first centroid. With fewer vectors than ``k`` there are fewer centroids;
    equal centroids leave the one with the greater number empty, and it stays where it is. Other columns are not read, so their names cannot clash. An
    inertia that 64 bits cannot hold is null. An empty table gives an empty result.
    """
    if width > 64:
        raise ValueError("64-bit sums are proven for at most 64 components")
    spark = df.sparkSession
    ship(spark)
    vectors = df.select(F.col(key).cast("long").alias("id"), numeric(df, vector).alias("v"))
    centroids = first_centroids(df, key, vector, scale, width, k, seed)
    schema = "id long, cluster int, distance long"
    if not len(centroids):
        added = ", cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema + added).toDF(key, *OUTPUT)
    for _ in range(rounds):
        centroids = moved(vectors.select("v"), centroids, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Bisectors(centroids)
        for piece, rows, table in _tables(batches, scale, width):
            winner, away = pairs.nearest(table)
            ids = piece.column("id").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(winner.astype(np.int32)), pa.array(away)], names=["id", "cluster", "distance"])

    found = materialise(vectors.mapInArrow(assign, schema), "clusters")
    # One row for each centroid, at most k.
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    own = {r["cluster"]: r["cluster_inertia"] for r in sums.collect()}
    total = None if None in own.values() or sum(own.values()) >= 1 << 63 else sum(own.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, own[c], total, digests[c]) for c in sorted(own)],
        T.StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid_sha256 string"),
    )
    return found.join(F.broadcast(facts), "cluster").select("id", *OUTPUT).toDF(key, *OUTPUT)


def op12_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return cluster(read(spark, sf, "embeddings").select("vec_id", "embedding"))


def _sql() -> str:
    # Plain Lloyd with all distances; one pair of steps for each round.
    steps = [
        """k AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id) - 1 AS n,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "c AS (SELECT n, unnest(range(len(v))) AS place, unnest(v) AS x FROM k)",
        "b0 AS (SELECT n AS cluster, place, x AS y FROM c WHERE n < 40)",
    ]
    nearest = """{to} AS (
  SELECT n, min(d * 40 + cluster) % 40 AS cluster, min(d * 40 + cluster) // 40 AS d
  FROM (SELECT c.n, b.cluster, CAST(sum((c.x - b.y) * (c.x - b.y)) AS BIGINT) AS d
        FROM c JOIN {book} b ON c.place = b.place GROUP BY c.n, b.cluster)
  GROUP BY n)"""
    for r in range(5):
        steps.append(nearest.format(to=f"a{r}", book=f"b{r}"))
        steps.append(f"""b{r + 1} AS (
  SELECT o.cluster, o.place,
         CASE WHEN m.c IS NULL THEN o.y ELSE (m.s - ((m.s % m.c) + m.c) % m.c) // m.c END AS y
  FROM b{r} o LEFT JOIN (
    SELECT a.cluster, c.place, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS c
    FROM c JOIN a{r} a ON c.n = a.n GROUP BY a.cluster, c.place) m
  ON o.cluster = m.cluster AND o.place = m.place)""")
    steps.append(nearest.format(to="z", book="b5"))
    steps.append("h AS (SELECT cluster, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY place)) AS digest FROM b5 GROUP BY cluster)")
    return (
        "WITH " + ",\n".join(steps) + """
SELECT k.vec_id, CAST(z.cluster AS INT) AS cluster, CAST(z.d AS BIGINT) AS distance,
       CAST(sum(z.d) OVER (PARTITION BY z.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(z.d) OVER () AS BIGINT) AS inertia, h.digest AS centroid_sha256
FROM k JOIN z ON k.n = z.n JOIN h ON z.cluster = h.cluster"""
    )


OP12_SQL = _sql()
