"""Exact top-k search by inner product, with MaxScore over the dimensions.

A dimension is a term of the query; what it can add to a score within a shard lies between the shard's least
and greatest component times the query's. Measured from the least, every contribution is at
least zero and has an upper bound. The terms with the greatest bounds are essential: their
postings (the columns of the shard) are traversed for all vectors, until the bounds of the other terms together
cannot lift a vector over the k-th best score. The others are probed only for vectors that are still
competitive. Each shard gives its k best for each query, but for those below the k-th best of shards that the same task has
searched before; these are merged.

Queries and candidates meet in blocks: every shard sees every block of queries once. Blocks of queries are copied to groups of shards;
a shard is moved once at most, and not at all while Spark broadcasts the queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read, ship

K = 10
SCALE = 1024
EVERY = 100
SHARD_ROWS, QUERY_ROWS, SHARDS_EACH = 4096, 256, 64
#: Queries whose k-th best score so far a task remembers; for others it starts anew.
REMEMBERED = 1 << 20
#: Terms that are traversed or probed at a time.
STEP = 8


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component; vectors with a null or non-finite one are left out."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(finite).select(
        F.col(key).cast("long").alias("id"), whole.alias("v")
    )


def _packed(ids: np.ndarray, lists: list[list[int]]) -> tuple[bytes, bytes, int]:
    width = max((len(x) for x in lists), default=0)
    table = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        table[i, : len(x)] = x
    if table.size and -(1 << 31) <= table.min() and table.max() < 1 << 31:
        table = table.astype(np.int32)
    return ids.astype(np.int64).tobytes(), table.tobytes(), width


_BLOCK = "block int, ids binary, table binary, width int"


def _blocks(df: DataFrame, rows: int) -> DataFrame:
    """The vectors of each partition in blocks of at most ``rows``; ``block`` never mixes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        lists: list[list[int]] = []
        now = 0

        def out() -> pa.RecordBatch:
            a, b, width = _packed(np.asarray(ids), lists)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([now], pa.int32()),
                    pa.array([a], pa.binary()),
                    pa.array([b], pa.binary()),
                    pa.array([width], pa.int32()),
                ],
                names=["block", "ids", "table", "width"],
            )

        for batch in batches:
            for block, i, v in zip(*(batch.column(c).to_pylist() for c in ("block", "id", "v")), strict=True):
                if ids and (block != now or len(ids) >= rows):
                    yield out()
                    ids, lists = [], []
                now = block
                ids.append(i)
                lists.append(v)
        if ids:
            yield out()

    return df.mapInArrow(pack, _BLOCK)


def _open(ids: bytes, table: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    kind = np.int32 if len(table) == 4 * len(i) * width else np.int64
    return i, np.frombuffer(table, kind).reshape(len(i), width)


def maxscore(
    q: np.ndarray, own: int, ids: np.ndarray, table: np.ndarray, least: np.ndarray, most: np.ndarray, k: int,
    bar: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best vectors of a shard for one query, ties to the smaller id.

    ``least`` and ``most`` are the shard's extremes by dimension. Vectors that score below ``bar``, if there is one, are left out.
    """
    width = min(len(q), table.shape[1])
    q = q[:width].astype(np.int64)
    low = np.minimum(q * least[:width], q * most[:width])
    gain = np.maximum(q * least[:width], q * most[:width]) - low
    terms = np.argsort(-gain, kind="stable")
    left = np.concatenate([np.cumsum(gain[terms][::-1])[::-1], [0]])  # bound of the terms from t on
    base = int(low.sum())
    alive = np.flatnonzero(ids != own)
    partial = np.full(len(alive), base, np.int64)
    # The exact scores of the first few give the score to beat.
    head = alive[: 4 * k]
    if len(head) >= k:
        first = np.partition(table[head, :width] @ q, len(head) - k)[len(head) - k]
        bar = first if bar is None else max(bar, first)
    for t in range(0, width, STEP):
        some = terms[t : t + STEP]
        partial += table[np.ix_(alive, some)] @ q[some] - low[some].sum()
        if len(partial) >= k:
            # What a vector has already is a lower bound of its score.
            least_sure = np.partition(partial, len(partial) - k)[len(partial) - k]
            bar = least_sure if bar is None else max(bar, least_sure)
        if bar is not None:
            keep = partial + left[min(t + STEP, width)] >= bar
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
    order = np.lexsort((ids[alive], -partial))[:k]
    return ids[alive][order], partial[order]


def top_k(
    df: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row where ``queries`` is true.

    Every row but those with the query's own identifier is a candidate. Components become floor(scale * x). Vectors that
    are null or hold a null or non-finite component take no part, nor do rows without identifier; a shorter vector
    is filled up with zeros, so an empty one scores 0 everywhere. Scores must fit into 64 bits. Of query rows that repeat an identifier the
    smallest vector asks; repeated candidates are returned as often as they are there. Other columns of the input, whatever their names, are not read. An empty table, or no query, gives an empty result.
    """
    ship(df.sparkSession)
    vectors = integer_vectors(df, key, vector, scale)
    asked = (
        integer_vectors(df.where(queries), key, vector, scale).groupBy("id").agg(F.min("v").alias("v"))
    )
    asked = materialise(asked, "topk-queries")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    # Hashed blocks are uneven, so a large one is packed in pieces.
    hashed = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    query_blocks = materialise(
        _blocks(hashed.repartition("block").sortWithinPartitions("block", "id"), QUERY_ROWS), "topk-query-blocks"
    )
    shards = materialise(_blocks(vectors.withColumn("block", F.lit(0)), SHARD_ROWS), "topk-shards")
    # A block of queries goes to so many groups of about SHARDS_EACH shards, whose rows meet it as they are read.
    groups = max(1, shards.count() // SHARDS_EACH)
    asking = query_blocks.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("shard_group"),
        F.col("ids").alias("q_ids"),
        F.col("table").alias("q_table"),
        F.col("width").alias("q_width"),
    )
    dealt = shards.withColumn("shard_group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")).drop("block")
    meet = dealt.join(asking, "shard_group")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bars: dict[int, int] = {}  # the k-th best score that a query has in some shard of this task
        for batch in batches:
            for row in batch.to_pylist():
                ids, table = _open(row["ids"], row["table"], row["width"])
                q_ids, q_table = _open(row["q_ids"], row["q_table"], row["q_width"])
                least, most = table.min(axis=0), table.max(axis=0)
                least, most = least.astype(np.int64), most.astype(np.int64)
                got = []
                for i, v in zip(q_ids.tolist(), q_table, strict=True):
                    found_here = maxscore(v, i, ids, table, least, most, k, bars.get(i))
                    got.append(found_here)
                    if len(found_here[1]) == k:
                        if len(bars) >= REMEMBERED:
                            bars.clear()
                        bars[i] = int(found_here[1][-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(q_ids, [len(a) for a, _ in got])),
                        pa.array(np.concatenate([a for a, _ in got])),
                        pa.array(np.concatenate([b for _, b in got]).astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    found = meet.mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op5_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read(spark, sf, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % EVERY == 0)


OP5_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
