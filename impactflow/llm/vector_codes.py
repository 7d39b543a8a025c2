"""Vector compression by product codes, with codebooks trained by Lloyd rounds over cover trees.

Vectors of whole numbers are cut into equal parts. Each partition packs its vectors into blocks and builds, for each block and
each part, a cover tree once: a node's points lie within its radius of its centre, and its children have at most half of
its radius and centres further apart than that. Every node holds the number and the sum of its points. A round
walks the trees from the root: where the nearest entry is nearer to a node's centre than any other by more
than twice the radius, the triangle inequality gives it the whole subtree, and its sum is added at once; only ambiguous nodes descend,
and only points of ambiguous leaves are compared one by one. Equal points make a node of radius zero, so they are
settled together however many they are.

What a round brings together is one sum for each entry and partition. Blocks lie in the shared scratch folder between rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, read, ship
from .vectors import means, numeric, squared, usable, whole

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors in a block; points that a leaf may hold.
BLOCK_ROWS, LEAF = 4096, 24
OUTPUT = ("code", "error", "label_error", "codebooks_sha256")

# Columns of a packed tree, before the sums of the components.
_LO, _HI, _CENTRE, _CHILD, _KIDS, _RADIUS, _SUMS = range(7)


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part, a table of (parts, entries, components) of whole numbers."""

    entries: np.ndarray
    scale: int

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, decimal, with commas between."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): a permutation of the points in which each node's are a run, and the nodes, children side by side.

    Radii are distances in double precision, as bits of the whole-number table.
    """
    order = np.arange(len(points))
    away = np.sqrt(squared(points, points[:1])[:, 0].astype(np.float64))
    lo, hi, centre, child, kids = [0], [len(points)], [0], [0], [0]
    radius = [float(away.max())]
    at = 0
    while at < len(lo):
        a, b, reach = lo[at], hi[at], radius[at] / 2
        if b - a > LEAF and reach > 0:
            child[at] = len(lo)
            left, far, c = order[a:b].copy(), away[a:b].copy(), centre[at]
            start = a
            while True:
                near = far <= reach
                n = int(near.sum())
                order[start : start + n], away[start : start + n] = left[near], far[near]
                lo.append(start)
                hi.append(start + n)
                centre.append(int(c))
                child.append(0)
                kids.append(0)
                radius.append(float(away[start : start + n].max()))
                start += n
                left = left[~near]
                if not len(left):
                    break
                c = left[0]
                far = np.sqrt(squared(points[left], points[c : c + 1])[:, 0].astype(np.float64))
            kids[at] = len(lo) - child[at]
        at += 1
    nodes = np.zeros((len(lo), _SUMS + points.shape[1]), np.int64)
    for column, values in ((_LO, lo), (_HI, hi), (_CENTRE, centre), (_CHILD, child), (_KIDS, kids)):
        nodes[:, column] = values
    nodes[:, _RADIUS] = np.array(radius).view(np.int64)
    sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order], axis=0)])
    nodes[:, _SUMS:] = sums[nodes[:, _HI]] - sums[nodes[:, _LO]]
    return order, nodes


def walk(points: np.ndarray, order: np.ndarray, nodes: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(which, entry, whole subtrees?): nodes, or else points, with the nearest entry of each; together all points once.

    Ties go to the entry with the smaller number. A subtree is settled only by a margin that rounding cannot reach.
    """
    front = np.zeros(1, np.int64)
    while len(front):
        some = nodes[front]
        away = squared(points[some[:, _CENTRE]], entries)
        best = away.argmin(axis=1)
        far = np.sqrt(away.astype(np.float64))
        nearest = far[np.arange(len(front)), best]
        far[np.arange(len(front)), best] = np.inf
        radius = some[:, _RADIUS].copy().view(np.float64)
        sure = (far.min(axis=1) - nearest > 2 * radius + 1e-6 * (1 + nearest)) | (radius == 0)
        yield front[sure], best[sure], True
        open_ = some[~sure]
        leaf = open_[:, _KIDS] == 0
        last, inner = open_[leaf], open_[~leaf]
        if len(last):
            which = order[_runs(last[:, _LO], last[:, _HI] - last[:, _LO])]
            yield which, squared(points[which], entries).argmin(axis=1), False
        front = _runs(inner[:, _CHILD], inner[:, _KIDS])


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run behind the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def _blocks(df: DataFrame, key: str, label: str | None, vector: str, scale: int, parts: int, width: int) -> DataFrame:
    """Blocks of at most BLOCK_ROWS usable vectors of a partition, each with its cover trees."""
    named = [F.col(key).cast("long").alias("id"), *([F.col(label).alias("label")] if label else []), numeric(df, vector).alias("v")]
    some = df.select(*named)
    kept = [f for f in some.schema.fields if f.name != "v"]

    def packed(held: list[pa.Table], rows: list[np.ndarray]) -> pa.RecordBatch:
        table, names = np.concatenate(rows), [f.name for f in kept]
        orders, trees = [], []
        for p in range(parts):
            order, nodes = cover_tree(_part(table, p, parts))
            orders.append(order.astype(np.int32))
            trees.append(nodes.tobytes())
        columns = [pa.concat_arrays([x.column(c) for x in held]) for c in names]
        one = pa.array([0, len(table)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                *(pa.ListArray.from_arrays(one, c) for c in columns),
                pa.array([table.astype(np.int32).tobytes()], pa.binary()),
                pa.array([np.concatenate(orders).tobytes()], pa.binary()),
                pa.array([trees], pa.list_(pa.binary())),
            ],
            names=[*names, "vectors", "orders", "trees"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, n = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                which, table = whole(piece.column("v"), scale, width, False)
                if not len(which):
                    continue
                if n + len(which) > BLOCK_ROWS:
                    yield packed(held, rows)
                    held, rows, n = [], [], 0
                held.append(piece.take(pa.array(which)))
                rows.append(table)
                n += len(which)
        if n:
            yield packed(held, rows)

    listed = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in kept]
    more = [T.StructField("vectors", T.BinaryType()), T.StructField("orders", T.BinaryType()), T.StructField("trees", T.ArrayType(T.BinaryType()))]
    return some.mapInArrow(pack, T.StructType([*listed, *more]))


def _part(table: np.ndarray, p: int, parts: int) -> np.ndarray:
    each = table.shape[1] // parts
    return np.ascontiguousarray(table[:, p * each : (p + 1) * each])


def _opened(batch: pa.RecordBatch, parts: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Number of the row, vectors, orders and trees of each block of a batch."""
    for i in range(batch.num_rows):
        table = np.frombuffer(batch.column("vectors")[i].as_py(), np.int32).reshape(-1, width).astype(np.int64)
        orders = np.frombuffer(batch.column("orders")[i].as_py(), np.int32).reshape(parts, len(table))
        trees = [np.frombuffer(x.as_py(), np.int64).reshape(-1, _SUMS + width // parts) for x in batch.column("trees")[i].values]
        yield i, table, orders, trees


def _round(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """One Lloyd round: only sums by part and entry leave a partition, and only their totals reach the driver."""
    parts, k, each = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, each + 1), np.int64)
        for batch in batches:
            for _, table, orders, trees in _opened(batch, parts, parts * each):
                for p in range(parts):
                    points, nodes = _part(table, p, parts), trees[p]
                    counted = np.column_stack([nodes[:, _SUMS:], nodes[:, _HI] - nodes[:, _LO]])
                    single = np.column_stack([points, np.ones(len(points), np.int64)])
                    for which, entry, subtrees in walk(points, orders[p], nodes, books.entries[p]):
                        np.add.at(total[p], entry, (counted if subtrees else single)[which])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    sums = np.zeros(parts * k * (each + 1), np.int64)
    for r in blocks.mapInArrow(add, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        sums[r["at"]] = r["n"]
    sums = sums.reshape(parts, k, each + 1)
    entries = np.stack([means(s[:, :each], s[:, each], e) for s, e in zip(sums, books.entries, strict=True)])
    return Codebooks(entries, books.scale)


def _coded(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """id, label if there is one, code and error of every vector."""
    parts, _, each = books.entries.shape
    kept = [f for f in blocks.schema.fields if f.name in ("id", "label")]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, table, orders, trees in _opened(batch, parts, parts * each):
                found = np.zeros((len(table), parts), np.int64)
                error = np.zeros(len(table), np.int64)
                for p in range(parts):
                    points, nodes, order = _part(table, p, parts), trees[p], orders[p]
                    for which, entry, subtrees in walk(points, order, nodes, books.entries[p]):
                        if subtrees:
                            size = nodes[which, _HI] - nodes[which, _LO]
                            which, entry = order[_runs(nodes[which, _LO], size)], np.repeat(entry, size)
                        found[which, p] = entry
                    off = points - books.entries[p][found[:, p]]
                    error += (off * off).sum(axis=1)
                codes = found.astype(np.uint8).tobytes().hex()
                codes = [codes[2 * parts * j : 2 * parts * (j + 1)] for j in range(len(table))]
                held = [batch.column(f.name)[i].values for f in kept]
                yield pa.RecordBatch.from_arrays([*held, pa.array(codes, pa.string()), pa.array(error)], names=[*(f.name for f in kept), *OUTPUT[:2]])

    own = [T.StructField(f.name, f.dataType.elementType) for f in kept]
    return blocks.select(*(f.name for f in blocks.schema.fields)).mapInArrow(
        assign, T.StructType([*own, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    )


def train(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = None,
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[Codebooks, DataFrame] | None:
    """Codebooks after ``rounds`` Lloyd rounds, and the table of blocks they come from; None if no vector is usable.

    The first entries are the parts of the vectors with the smallest identifiers; of equal identifiers the lesser vector
    comes first, null identifiers last.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte for each part, so there are 1 to 256 entries")
    ship(df.sparkSession)
    kept = df.where(usable(vector)).select(F.col(key).cast("long").alias("id"), numeric(df, vector).alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts)) * parts
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()
    start = whole(first.column("v").combine_chunks(), scale, width, False)[1]
    books = Codebooks(np.stack([_part(start, p, parts) for p in range(parts)]), scale)
    blocks = materialise(_blocks(df, key, label, vector, scale, parts, width), "vector-blocks")
    for _ in range(rounds):
        books = _round(blocks, books)
    return books, blocks


def compress(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """Key, label, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable vector.

    A component x becomes floor(scale * x), held within LARGEST either way. Rows are left out whose vector is null or has a null, NaN or infinite
    component. Vectors shorter than the longest, or than a multiple of ``parts``, count as filled up with zeros; an empty one is all zeros.
    Repeated rows, identifiers and vectors all count and all come back; rows with a null identifier come back with it. Distance ties go to the entry with the smaller
    number, and an entry that nothing is nearest to stays as it was; with fewer vectors than entries there are fewer
    entries. ``label_error`` is the error over equal labels, nulls together. Other columns are not read, so their names cannot clash.
    An empty table gives an empty result.
    """
    out = df.select(F.col(key).cast("long").alias(key), F.col(label).alias(label)).schema
    found = train(df, key, vector, label, scale, parts, entries, rounds)
    if found is None:
        added = "code string, error long, label_error long, codebooks_sha256 string"
        return df.sparkSession.createDataFrame([], T.StructType([*out, *T.StructType.fromDDL(added)]))
    books, blocks = found
    coded = materialise(_coded(blocks, books), "vector-codes")
    discard(blocks)
    # As tables of their own, both sides are dealt by label and large labels can be split.
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    totals = materialise(totals, "vector-label-errors")
    return (
        coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
        .select("id", "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
        .toDF(key, label, *OUTPUT)
    )


def decompress(df: DataFrame, books: Codebooks, code: str = "code", vector: str = "decoded") -> DataFrame:
    """The rows with the vectors that their codes stand for, scaled back; a null code gives null.

    The codebooks are part of the plan: at most 256 entries for each part.
    """
    parts = books.entries.shape[0]
    pieces = []
    for p in range(parts):
        book = F.array(*(F.array(*(F.lit(float(x) / books.scale) for x in e)) for e in books.entries[p].tolist()))
        number = F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")
        pieces.append(F.element_at(book, number + 1))
    return df.withColumn(vector, F.when(F.col(code).isNotNull(), F.concat(*pieces)))


def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    out = compress(read(spark, sf, "embeddings"))
    return out.select("vec_id", *OUTPUT)


def _sql() -> str:
    # Plain Lloyd over (vector, part, place) rows; one pair of steps for each round.
    steps = [
        """k AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS n,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c AS (
  SELECT vec_id, label, n, i // (len(v) // 8) AS part, i % (len(v) // 8) AS place, v[i + 1] AS x
  FROM (SELECT *, unnest(range(len(v))) AS i FROM k))""",
        "b0 AS (SELECT part, n AS entry, place, x AS y FROM c WHERE n < 16)",
    ]
    nearest = """{to} AS (
  SELECT n, part, min(d * 16 + entry) % 16 AS entry, min(d * 16 + entry) // 16 AS d
  FROM (SELECT c.n, c.part, b.entry, CAST(sum((c.x - b.y) * (c.x - b.y)) AS BIGINT) AS d
        FROM c JOIN {book} b ON c.part = b.part AND c.place = b.place GROUP BY c.n, c.part, b.entry)
  GROUP BY n, part)"""
    for r in range(6):
        steps.append(nearest.format(to=f"a{r}", book=f"b{r}"))
        steps.append(f"""b{r + 1} AS (
  SELECT o.part, o.entry, o.place,
         CASE WHEN m.c IS NULL THEN o.y ELSE (m.s - ((m.s % m.c) + m.c) % m.c) // m.c END AS y
  FROM b{r} o LEFT JOIN (
    SELECT c.part, a.entry, c.place, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS c
    FROM c JOIN a{r} a ON c.n = a.n AND c.part = a.part GROUP BY c.part, a.entry, c.place) m
  ON o.part = m.part AND o.entry = m.entry AND o.place = m.place)""")
    steps.append(nearest.format(to="z", book="b6"))
    steps.append("""e AS (
  SELECT k.vec_id, k.label, string_agg(lpad(lower(to_hex(z.entry)), 2, '0'), '' ORDER BY z.part) AS code,
         CAST(sum(z.d) AS BIGINT) AS error
  FROM k JOIN z ON k.n = z.n GROUP BY k.n, k.vec_id, k.label)""")
    return (
        "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, place)) FROM b6) AS codebooks_sha256
FROM e"""
    )


OP11_SQL = _sql()
