"""Similarity join of texts by the Jaccard similarity of their word shingles, by a partitioned universe.

Two sets of l <= s elements whose similarity is at least t differ in at most (l + s)(1 - t)/(1 + t)
elements. The universe of hashed shingles is cut into more segments than that, so a similar pair has the same subset in at
least one segment (the pigeonhole). Sizes are dealt into bands, and every band has its own number of segments; a set is indexed in the
band of its size and in those of the smaller sets it may be similar to.

* Index: the subsets in the non-empty segments, and, where the band's allocation says so, every subset less
  one element (a one-deletion neighbourhood: a segment then stands for two differences). The allocation of a band is the
  cheaper of the two by the expected number of entries and of chance candidates, from the band's number of
  sets. Empty segments are never indexed: a set is safe if it fills more segments than the pair may differ in, and a set that is not
  (it is checked, not assumed) is indexed by its single elements besides.
* Hot subsets, held by more than HOT sets, are allocated nothing where the set has enough rarer ones: each set keeps the
  rarest it needs (bound + 1), in one global order, which is the prefix that any similar pair must
  share. In a group that remains hot no pairs are formed: all are compared with one reference, and those that are not connected to
  it meet by their rarest differences to it; there, groups of one family take one reference.
* Candidates that share fewer subsets than the pigeonhole guarantees for their sizes are dropped; the others are verified on their full
  sets. As components are asked for, pairs that are connected already are not verified again: every round verifies some links of
  each set, merges, and goes on until no candidate joins two components.

Texts with equal sets are one node throughout. Candidates are found by 64-bit hashes of shingles, in which every byte is mixed with its place;
each link is decided on the shingles' words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, bytes_of, discard, frugal, materialise, partitions_for, read, ship, slices, total_bytes, without
from .components import components
from .listed import only_listed
from .shingles import mix64, same_shingles, shingle_sets

PERCENT = 80
#: Sizes of a band lie within this factor.
FACTOR = 1.5
#: A subset held by more sets than this is hot; larger groups are never expanded into pairs.
HOT = 32
#: Chance that a set of the same band holds a given element, for the allocation's cost.
CHANCE = 0.001
#: Sizes of a class, for hot sets, lie within this factor, over 100 / PERCENT: similar sets are in one class or in neighbouring ones.
CLASS = 1.26
#: Members of a hot group, besides its reference, that those which it does not connect are compared with.
CENTRES = 4
SLICE_BYTES = 512 << 10
#: Index entries a task holds before it deals them out, and bytes of text that one bucket of the index stands for.
ENTRIES, BUCKET_BYTES = 1 << 19, 8 << 20
OUTPUT = ("n_shingles", "component_id")

_LOWS = [1]
while _LOWS[-1] < 1 << 40:
    _LOWS.append(max(_LOWS[-1] + 1, int(_LOWS[-1] * FACTOR)))
LOWS = np.array(_LOWS[:64], np.int64)


def band_of(n: int) -> int:
    return int(np.searchsorted(LOWS, n, "right")) - 1


def most_different(a: int, b: int, percent: int = PERCENT) -> int:
    """How many elements two similar sets of these sizes can differ in."""
    return (a + b) * (100 - percent) // (100 + percent)


@dataclass(frozen=True)
class Band:
    """How the sets of a band are cut: bound on differences, number of segments, one-deletion neighbourhoods or not."""

    number: int
    bound: int
    segments: int
    deletions: bool


def _filled(m: int, n: int) -> tuple[float, float, float]:
    """Expected non-empty segments, expected sum of min(2, elements), and a bound on their deviation."""
    t = n / m
    none = (1 - 1 / m) ** n if m > 1 else 0.0
    one = t * (1 - 1 / m) ** (n - 1) if m > 1 else float(n == 1)
    spread = m * (math.exp(-t) - (1 + t) * math.exp(-2 * t))
    return m * (1 - none), m * (2 * (1 - none) - one), math.sqrt(max(spread, 0.0))


def allocate(number: int, sets: int, percent: int = PERCENT) -> Band:
    """The cheaper allocation for a band that has so many sets."""
    low, high = int(LOWS[number]), int(LOWS[number + 1]) - 1
    bound = most_different(high, high * 100 // percent, percent)
    best: tuple[float, Band] | None = None
    for deletions in (False, True):
        need = bound + 1 if not deletions else (bound + 1) / 2
        m = max(1, math.ceil(need))
        spare = 0.05 * bound + 1 if bound else 0  # room for hot subsets
        while m < 4 * low * low:
            one, two, deviation = _filled(m, low)
            if (two if deletions else one) >= bound + 1 + spare + 3 * deviation or (deletions and m == 1 and bound <= 1 and low > 1):
                break
            m += max(1, m // 20)
        one, _, _ = _filled(m, low)
        size = low / max(one, 1)
        entries = one
        chance = entries * CHANCE**size
        if deletions:
            entries += low
            chance += low * CHANCE ** max(size - 1, 0)
        cost = entries + sets * chance
        if best is None or cost < best[0]:
            best = cost, Band(number, bound, m, deletions)
    return best[1]


def entries_of(tokens: np.ndarray, band: Band) -> tuple[np.ndarray, int]:
    """Index entries of a set in a band, and how many segments it fills.

    The low six bits of an entry are the band's number. A set that fills too few segments has its single elements
    as entries too, and counts as filling none. With one-deletion neighbourhoods, where segments are not counted, the number is -1
    less the segments that the set can spare.
    """
    n, m = len(tokens), band.segments
    segment = ((tokens >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # ascending, as the elements are
    first = np.concatenate([[0], np.flatnonzero(segment[1:] != segment[:-1]) + 1])
    values = mix64(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    sums = np.add.reduceat(values, first)
    place = mix64(segment[first] + np.uint64((band.number + 1) << 40))
    out = [mix64(sums ^ place)]
    sizes = np.diff(np.append(first, n))
    filled = len(first)
    if band.deletions:
        owner = np.repeat(np.arange(filled), sizes)
        more = sizes[owner] > 1
        out.append(mix64((sums[owner] - values)[more] ^ place[owner[more]]))
        capacity = int(np.minimum(sizes, 2).sum())  # differences that its segments stand for
        enough = capacity > band.bound
        filled = -1 - (capacity - band.bound - 1) // 2
    else:
        enough = filled > band.bound
    if not enough:
        out.append(mix64(values + np.uint64((band.number + 1) << 20)))
        filled = 0
    entries = np.unique(np.concatenate(out) & ~np.uint64(63)) | np.uint64(band.number)
    return entries, filled


def bands_for(n: int, percent: int = PERCENT) -> range:
    """The bands in which a set of n elements can be part of a pair: those of its smaller partners, and its own."""
    return range(band_of(max(1, -(-n * percent // 100))), band_of(n) + 1)


def describe(df: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """The carried columns, ``n_shingles`` of each text's set, and ``_digest``, which equal sets share."""

    @frugal
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE_BYTES):
            tokens, at = shingle_sets(*bytes_of(batch.column(text)))
            digests = [
                hashlib.blake2b(tokens[a:b].tobytes(), digest_size=16).digest() if a < b else None
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(np.diff(at)), pa.array(digests, pa.binary())],
                names=[*carry, "n_shingles", "_digest"],
            )

    fields = [df.schema[c] for c in carry]
    added = [T.StructField("n_shingles", T.LongType()), T.StructField("_digest", T.BinaryType())]
    return df.select(*dict.fromkeys([*carry, text])).mapInArrow(sets, T.StructType([*fields, *added]))


_ENTRY = np.dtype([("entry", "<u8"), ("same", "<u8"), ("node", "<i8"), ("n", "<i4"), ("filled", "<i4")])


def _columns(rows: np.ndarray) -> bytes:
    """The fields one after the other, so that ascending and small numbers can be packed."""
    return b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)


def _rows(data: bytes, kind: np.dtype) -> np.ndarray:
    out = np.empty(len(data) // kind.itemsize, kind)
    at = 0
    for name in kind.names:
        field = kind[name]
        out[name] = np.frombuffer(data, field, len(out), at)
        at += field.itemsize * len(out)
    return out


def _index(df: DataFrame, text: str, key: str, bands: dict[int, Band], buckets: int, percent: int) -> DataFrame:
    """(bucket, entries): index entries of all sets, packed for each bucket; of equal sets of a task those that follow a smaller node go once.

    Each entry tells all of its set that the bucket has to know, so its size does not depend on the number of buckets.
    """

    def out(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        bucket = ((mix64(rows["entry"]) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.lexsort((rows["entry"], bucket))
        rows, bucket = rows[order], bucket[order]
        cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        pack = zstandard.ZstdCompressor(level=1)
        names, blobs = [], []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            names.append(int(bucket[a]))
            blobs.append(pack.compress(_columns(rows[a:b])))
        for a in range(0, len(names), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[a : a + 64], pa.int32()), binaries(blobs[a : a + 64])], names=["bucket", "entries"]
            )

    @frugal
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0
        sent: dict[bytes, int] = {}  # the smallest node that has gone for each set of this task
        for batch in slices(batches, text, SLICE_BYTES):
            tokens, at = shingle_sets(*bytes_of(batch.column(text)))
            nodes = batch.column(key).to_pylist()
            smallest: dict[bytes, int] = {}
            for i, node in enumerate(nodes):
                if node is not None and at[i] < at[i + 1]:
                    same = hashlib.blake2b(tokens[at[i] : at[i + 1]].tobytes(), digest_size=8).digest()
                    j = smallest.get(same)
                    if j is None or node < nodes[j]:
                        smallest[same] = i
            for same, i in smallest.items():
                if sent.get(same, nodes[i] + 1) <= nodes[i]:
                    continue
                sent[same] = nodes[i]
                own = tokens[at[i] : at[i + 1]]
                for b in bands_for(len(own), percent):
                    entries, filled = entries_of(own, bands[b])
                    rows = np.empty(len(entries), _ENTRY)
                    rows["entry"], rows["same"] = entries, int.from_bytes(same, "little")
                    rows["node"], rows["n"], rows["filled"] = nodes[i], len(own), filled
                    held.append(rows)
                    count += len(rows)
                    if count >= ENTRIES:
                        yield from out(held)
                        held, count = [], 0
        if held:
            yield from out(held)

    return df.select(key, text).mapInArrow(index, "bucket int, entries binary")


_GROUPED = "hot boolean, a long, b long, band int, entry long, number int, need int"


def _group(rows: np.ndarray, percent: int, hot: int) -> pa.RecordBatch | None:
    """Pairs of sets in the groups of a bucket; the members of its hot groups."""
    order = np.argsort(rows["entry"], kind="stable")
    entry = rows["entry"][order]
    alike = np.zeros(len(entry) + 1, bool)
    alike[1:-1] = entry[1:] == entry[:-1]
    some = alike[1:] | alike[:-1]
    entry, h = entry[some], rows[order[some]]
    if not len(entry):
        return None
    # Equal sets of other slices: the smallest node stands for all.
    order = np.lexsort((h["node"], h["same"], entry))
    entry, h = entry[order], h[order]
    keep = np.ones(len(entry), bool)
    keep[1:] = (entry[1:] != entry[:-1]) | (h["same"][1:] != h["same"][:-1])
    entry, h = entry[keep], h[keep]
    cut = np.concatenate([[0], np.flatnonzero(entry[1:] != entry[:-1]) + 1, [len(entry)]])
    size = np.diff(cut)
    firsts, seconds = [], []
    for k in np.unique(size[(size > 1) & (size <= hot)]).tolist():
        i, j = np.triu_indices(k, 1)
        start = cut[:-1][size == k]
        firsts.append((start[:, None] + i).ravel())
        seconds.append((start[:, None] + j).ravel())
    out = {name: [] for name in ("hot", "a", "b", "band", "entry", "number", "need")}

    def add(n: int, **columns: np.ndarray) -> None:
        for name, values in out.items():
            values.append(columns.get(name, np.zeros(n, np.int64)))

    if firsts:
        x, y = np.concatenate(firsts), np.concatenate(seconds)
        swap = h["node"][x] > h["node"][y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        a, b = h[x], h[y]
        band = (entry[x] & np.uint64(63)).astype(np.int64)
        less, more = np.minimum(a["n"], b["n"]).astype(np.int64), np.maximum(a["n"], b["n"]).astype(np.int64)
        fits = (100 * less >= percent * more) & (np.searchsorted(LOWS, less, "right") - 1 == band) & (a["node"] != b["node"])
        a, b, band, less, more = a[fits], b[fits], band[fits], less[fits], more[fits]
        bound = (less + more) * (100 - percent) // (100 + percent)
        need = np.maximum(np.maximum(a["filled"], b["filled"]), 0).astype(np.int64) - bound
        if len(a):
            pair = np.empty(len(a), np.dtype([("a", "<i8"), ("b", "<i8"), ("band", "<i8"), ("need", "<i8")]))
            pair["a"], pair["b"], pair["band"], pair["need"] = a["node"], b["node"], band, need
            order = np.lexsort((pair["need"], pair["band"], pair["b"], pair["a"]))
            pair = pair[order]
            new = np.ones(len(pair), bool)
            new[1:] = pair[1:] != pair[:-1]
            at = np.flatnonzero(new)
            pair, number = pair[at], np.diff(np.append(at, len(order)))
            add(len(at), a=pair["a"], b=pair["b"], band=pair["band"], need=pair["need"], number=number)
    large = np.repeat(size > hot, size)
    if large.any():
        x, e = h[large], entry[large]
        add(
            len(x),
            hot=np.ones(len(x), np.int64),
            a=x["node"],
            b=x["n"].astype(np.int64),
            band=(e & np.uint64(63)).astype(np.int64),
            entry=e.view(np.int64),
            number=np.repeat(size, size)[large],
            need=x["filled"].astype(np.int64),
        )
    if not out["a"]:
        return None
    joined = {name: np.concatenate(values) for name, values in out.items()}
    return pa.RecordBatch.from_arrays(
        [
            pa.array(joined["hot"].astype(bool)),
            pa.array(joined["a"]),
            pa.array(joined["b"]),
            pa.array(joined["band"].astype(np.int32)),
            pa.array(joined["entry"]),
            pa.array(joined["number"].astype(np.int32)),
            pa.array(joined["need"].astype(np.int32)),
        ],
        names=list(out),
    )


def _grouped(index: DataFrame, buckets: int, percent: int, hot: int) -> DataFrame:
    """Pairs (a, b, band, number of shared entries in the bucket, how many they need) and members of hot groups."""

    @frugal
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        unpack = zstandard.ZstdDecompressor()

        def done() -> Iterator[pa.RecordBatch]:
            found = _group(np.concatenate(blobs), percent, hot)
            if found is not None:
                for a in range(0, found.num_rows, 50_000):
                    yield found.slice(a, 50_000)

        for batch in batches:
            for bucket, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and blobs:
                    yield from done()
                    blobs = []
                now = bucket
                blobs.append(_rows(unpack.decompress(blob), _ENTRY))
        if blobs:
            yield from done()

    return index.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(group, _GROUPED)


def _linked(batch: pa.RecordBatch, one: str, two: str, i: int, percent: int) -> bool:
    """Are the two texts of a row similar, by their words?"""
    a, b = (batch.column(c)[i].as_py().encode() for c in (one, two))
    n, m, both = same_shingles(a, b)
    return both > 0 and 100 * both >= percent * (n + m - both)


def _verify(links: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the links (a, b) whose full sets are similar."""
    both = links.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    @frugal
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "text_a", SLICE_BYTES), "text_b", SLICE_BYTES):
            (x, at), (y, bt) = (shingle_sets(*bytes_of(batch.column(c))) for c in ("text_a", "text_b"))
            good = []
            for i in range(batch.num_rows):
                p, q = x[at[i] : at[i + 1]], y[bt[i] : bt[i + 1]]
                where = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[where] == p).sum()) if len(p) and len(q) else 0
                alike = 100 * both >= percent * (len(p) + len(q) - both) and both > 0
                # Hashes only reject; what they let pass is counted on the words.
                good.append(alike and _linked(batch, "text_a", "text_b", i, percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long").distinct()


def _size_class(n: F.Column) -> F.Column:
    return F.floor(F.log(n.cast("double")) / math.log(CLASS))


def _members(grouped: DataFrame, percent: int) -> DataFrame:
    """(entry, node, n): what each set keeps of its hot entries, the rarest it needs.

    A set differs from a similar one in at most ``bound`` elements, whatever the other's size, so each has a common entry among
    its bound + 1 rarest. (With one-deletion neighbourhoods a set keeps none of its hot entries, if it can spare their segments, or else all.) From here on an
    entry is one of a class of sizes: a set keeps it for its own class and for the one below, so similar sets, whose classes are the same or neighbours,
    have one in common.
    """
    rarest = Window.partitionBy("a", "band").orderBy("number", "entry")
    n = F.col("n")
    bound = F.floor((n + F.floor(n * 100 / percent)) * F.lit((100 - percent) / (100 + percent)) + F.lit(1e-9))
    own = _size_class(n)
    return (
        grouped.where("hot")
        .withColumnRenamed("b", "n")
        .withColumn("held", F.count("*").over(Window.partitionBy("a", "band")))
        .withColumn("place", F.row_number().over(rarest))
        .where(
            (F.col("need") == 0)
            | ((F.col("need") > 0) & (F.col("place") <= F.col("held") - (F.col("need") - bound - 1)))
            | ((F.col("need") < 0) & (F.col("held") > -F.col("need") - 1))
        )
        .select("entry", F.col("a").alias("node"), "n", F.explode(F.array(own, own - 1)).alias("class"))
        .select(F.xxhash64("entry", "class").alias("entry"), "node", "n")
        .distinct()
    )


def _groups(members: DataFrame) -> DataFrame:
    """(entry, least): the groups of several members."""
    sizes = members.groupBy("entry").agg(F.count("*").alias("size"), F.min("node").alias("least"))
    return sizes.where("size > 1").drop("size")


def _stars(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(r, x): every member of a hot group with the group's smallest one."""
    return (
        members.join(groups.select("entry", F.col("least").alias("r")), "entry")
        .where(F.col("node") != F.col("r"))
        .select("r", F.col("node").alias("x"))
        .distinct()
    )


def _differences(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(r, x, n_r, n, d, near): sizes of both sets, the elements that only one of them has, and whether they are similar by their words."""
    both = pairs.join(texts.toDF("r", "text_r"), "r").join(texts.toDF("x", "text_x"), "x")

    def near(batch: pa.RecordBatch, i: int, n: int, m: int, different: int) -> bool:
        both = (n + m - different) // 2
        return both > 0 and 100 * both >= percent * (n + m - both) and _linked(batch, "text_r", "text_x", i, percent)

    @frugal
    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "text_r", SLICE_BYTES), "text_x", SLICE_BYTES):
            (p, at), (q, bt) = (shingle_sets(*bytes_of(batch.column(c))) for c in ("text_r", "text_x"))
            found = [
                np.setxor1d(p[at[i] : at[i + 1]], q[bt[i] : bt[i + 1]], assume_unique=True)
                for i in range(batch.num_rows)
            ]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            values = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("r"),
                    batch.column("x"),
                    pa.array(np.diff(at)),
                    pa.array(np.diff(bt)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))),
                    pa.array([near(batch, i, int(at[i + 1] - at[i]), int(bt[i + 1] - bt[i]), len(f)) for i, f in enumerate(found)], pa.bool_()),
                ],
                names=["r", "x", "n_r", "n", "d", "near"],
            )

    ordered = both.select("r", "x", "text_r", "text_x")
    return ordered.mapInArrow(differ, "r long, x long, n_r long, n long, d array<long>, near boolean")


def _similar(n: F.Column, m: F.Column, different: F.Column, percent: int) -> F.Column:
    """Are sets of n and m elements similar that differ in so many?"""
    both = (n + m - different) / 2
    return 100 * both >= percent * (n + m - both)


def _open_groups(differences: DataFrame, labels: DataFrame) -> DataFrame:
    """(r, x, n, s, label, label_r, top, least, first): members of the groups that have one outside their reference's component.

    s is the number of differences to the reference; top and least are the largest and the smallest size in the group. Of the groups that
    x is in, or is the reference of, first is the largest: two members of another group that have the same one meet there.
    """
    labelled = materialise(
        differences.select("r", "x", "n_r", "n", F.size("d").alias("s"))
        .join(labels.toDF("x", "label"), "x", "left")
        .join(labels.toDF("r", "label_r"), "r", "left")
        .withColumns({"label": F.coalesce("label", "x"), "label_r": F.coalesce("label_r", "r")}),
        "jaccard-labelled",
    )
    tops = materialise(
        labelled.groupBy("r")
        .agg(
            F.max(F.greatest("n", "n_r")).alias("top"),
            F.min("n").alias("least"),
            F.bool_or(F.col("label") != F.col("label_r")).alias("open"),
            F.count("*").alias("size"),
        )
        .where("open")
        .drop("open"),
        "jaccard-references",
    )
    known = materialise(labelled.join(tops, "r").drop("n_r"), "jaccard-open")
    group = F.struct((-F.col("size")).alias("order"), "r")
    first = known.select("x", group.alias("g")).union(tops.select("r", group)).groupBy("x").agg(F.min("g")["r"].alias("first"))
    out = materialise(known.drop("size").join(materialise(first, "jaccard-first"), "x"), "jaccard-open")
    discard(labelled, tops, known)
    return out


def _similar_by_differences(pairs: DataFrame, differences: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (r, a, b) that are similar, by their differences to r, as (a, b)."""
    one = differences.select("r", F.col("x").alias("a"), F.col("n").alias("n_a"), F.col("d").alias("d_a"))
    two = differences.select("r", F.col("x").alias("b"), F.col("n").alias("n_b"), F.col("d").alias("d_b"))
    common = F.size(F.array_intersect("d_a", "d_b"))
    different = F.size("d_a") + F.size("d_b") - 2 * common
    return (
        pairs.join(one, ["r", "a"])
        .join(two, ["r", "b"])
        .where(_similar(F.col("n_a"), F.col("n_b"), different, percent))
        .select("a", "b")
        .distinct()
    )


def _regrouped(differences: DataFrame, labels: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The differences of the groups that are still open, with the groups of alike references put together.

    Copies of one text are in as many hot groups as they have hot entries in common, and would deal out their differences in each. A group takes
    the reference of the largest group whose reference is like its own, so a member is in few groups, however many entries are hot. All members of
    a group move together, with its reference, so two that met before meet again.
    """
    apart = (
        differences.select("r", "x")
        .join(labels.toDF("x", "label"), "x", "left")
        .join(labels.toDF("r", "label_r"), "r", "left")
        .where(F.coalesce("label", "x") != F.coalesce("label_r", "r"))
    )
    known = materialise(differences.join(apart.select("r").distinct(), "r", "left_semi"), "jaccard-known")
    sizes = materialise(known.groupBy("r").agg(F.count("*").alias("size")), "jaccard-sizes")
    # Half of the elements of both are common, and the sizes are of one class: what the members share cancels out as before.
    alike = (3 * F.size("d") <= F.col("n_r") + F.col("n")) & (F.greatest("n_r", "n") <= F.least("n_r", "n") * CLASS)
    ends = known.where(alike).select("r", F.col("x").alias("q"))
    ranked = sizes.select("r", F.struct((-F.col("size")).alias("order"), "r").alias("rank"))
    larger = (
        ends.union(ends.select("q", "r"))
        .join(ranked, "r")
        .join(ranked.toDF("q", "rank_q"), "q")
        .where("rank_q < rank")
        .groupBy("r")
        .agg(F.min("rank_q")["r"].alias("to"))
    )
    larger = materialise(larger, "jaccard-larger")
    moves = materialise(
        larger.join(larger.toDF("to", "further"), "to", "left").select("r", F.coalesce("further", "to").alias("to")), "jaccard-moves"
    )
    pairs = materialise(
        known.select("r", "x")
        .join(moves, "r", "left")
        .select(F.coalesce("to", "r").alias("r"), "x")
        .union(moves.select("to", "r"))
        .where("r <> x")
        .distinct(),
        "jaccard-regrouped",
    )
    new = _differences(pairs.join(known.select("r", "x"), ["r", "x"], "left_anti"), texts, percent)
    out = materialise(known.join(pairs, ["r", "x"], "left_semi").select(*new.columns).union(new), "jaccard-differences")
    discard(known, sizes, larger, moves, pairs)
    return out


def _by_centres(differences: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members outside their reference's component and the group's CENTRES members with the fewest differences.

    A reference is the smallest identifier, so it may be a much edited copy. Those nearest to it are edited less, and
    connect most of the members that it does not.
    """
    known = _open_groups(differences, labels)
    nearest = Window.partitionBy("r").orderBy("s", "x")
    centres = materialise(
        known.withColumn("k", F.row_number().over(nearest))
        .where(F.col("k") <= CENTRES)
        .select("r", F.col("x").alias("y"), F.col("label").alias("label_y")),
        "jaccard-centres",
    )
    pairs = (
        known.where("label <> label_r")
        .join(centres, "r")
        .where("label <> label_y")
        .select("r", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    found = materialise(_similar_by_differences(pairs, differences, percent), "jaccard-by-centres")
    discard(known, centres)
    return found


def _by_differences(differences: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of hot groups that are not both connected to their reference.

    Of x and y only their differences to the common reference count: x and y differ in as many elements as the two sets of
    differences do. So the numbers of differences of similar ones are near each other: a member takes part only if another component has one
    within reach, one of the two is outside the reference's, and they do not meet in a larger group. Similar ones share at least (|dx| + |dy| - bound) / 2 differences, and with the rarest first each
    needs only a prefix of its own to find the other. Edits that no other copy shares come first, so members that
    were edited on their own meet nobody. A pair that meets has to have as many differences left as it must share.
    """
    share = (100 - percent) / (100 + percent)

    def bound(n: F.Column, m: F.Column) -> F.Column:
        return F.floor((n + m) * share + 1e-9)

    def reach(n: F.Column) -> F.Column:
        """The most that a set of n elements and any similar one of its group differ in."""
        return bound(n, F.least(F.col("top"), F.floor(n * 100 / percent)))

    known = _open_groups(differences, labels)
    outside = F.col("label") != F.col("label_r")
    width = F.greatest(F.lit(4), F.floor(bound(F.col("top"), F.col("top")) / 4))
    sized = known.withColumns({"width": width, "reach": reach(F.col("n"))}).withColumn("own", F.floor(F.col("s") / F.col("width")))
    # The classes that a group has; fewer than 50, as s is at most twice the largest size and a width a twentieth of that.
    classes = materialise(
        sized.groupBy("r", "own")
        .agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.bool_or(outside).alias("outs"),
            F.min("first").alias("from"), F.max("first").alias("to"),
        )
        .groupBy("r")
        .agg(F.collect_list(F.struct("own", "low", "high", "outs", "from", "to")).alias("classes")),
        "jaccard-classes",
    )

    def met(c: F.Column) -> F.Column:
        near = c["own"].between(
            F.floor((F.col("s") - F.col("reach")) / F.col("width")), F.floor((F.col("s") + F.col("reach")) / F.col("width"))
        )
        here = (F.col("first") == F.col("r")) | (c["from"] != F.col("first")) | (c["to"] != F.col("first"))
        return near & here & (c["outs"] | outside) & ((c["low"] != F.col("label")) | (c["high"] != F.col("label")))

    facts = materialise(
        sized.join(classes, "r").withColumn("class", F.explode(F.transform(F.filter("classes", met), lambda c: c["own"])))
        .withColumn("shared", F.ceil((F.col("s") + F.col("class") * F.col("width") - F.col("reach")) / 2))
        .drop("classes"),
        "jaccard-facts",
    )
    # Members of the other class decide by their own size and differences. If one of them has to share some, so has
    # whoever it is similar to: then a set that need not share any by its own count is found by each of its differences.
    most_of_other = (F.col("class") + 1) * F.col("width") - 1
    asked = F.ceil((most_of_other + F.col("own") * F.col("width") - reach(F.col("least"))) / 2)
    # A prefix depends on the other's number of differences; the longest one holds all others, so each member deals out that one once.
    about = ["r", "x", "n", "s", "label", "label_r", "first"]
    by_shared = (
        facts.where((F.col("shared") > 0) | (asked > 0)).groupBy(*about).agg(F.greatest(F.min("shared"), F.lit(1)).alias("shared"))
    )
    # Differences are dealt out for the members that need them only.
    tokens = (
        differences.select("r", "x", "d")
        .join(by_shared.select("r", "x"), ["r", "x"], "left_semi")
        .select("r", "x", F.explode("d").alias("t"))
    )
    rarity = tokens.groupBy("r", "t").agg(F.count("*").alias("f"))
    place = Window.partitionBy("r", "x").orderBy("f", "t")
    placed = tokens.join(rarity, ["r", "t"]).withColumn("pos", F.row_number().over(place) - 1).drop("f")
    key = ["r", "any", "t", "low", "high"]

    columns = [*key, "x", "n", "s", "label", "label_r", "pos", "first"]
    # Where neither need share anything, all of the two classes meet.
    loose = facts.where("shared <= 0").withColumns(
        {"any": F.lit(True), "t": F.lit(0).cast("long"), "pos": F.lit(0), "low": F.least("own", "class"), "high": F.greatest("own", "class")}
    )
    no_class = F.lit(0).cast("long")
    tight = (
        by_shared.join(placed, ["r", "x"])
        .where(F.col("pos") <= F.col("s") - F.col("shared"))
        .withColumns({"any": F.lit(False), "low": no_class, "high": no_class})
    )
    entries = materialise(loose.select(*columns).union(tight.select(*columns)), "jaccard-prefixes")
    probes = entries.where("label <> label_r").drop("label_r")
    others = entries.drop("label_r").toDF(*key, "y", "m", "z", "label_y", "pos_y", "first_y")
    most = bound(F.col("n"), F.col("m"))
    left = F.least(F.col("s") - F.col("pos"), F.col("z") - F.col("pos_y"))
    enough = F.col("any") | (left >= F.ceil((F.col("s") + F.col("z") - most) / 2))
    here = (F.col("first") == F.col("r")) | (F.col("first") != F.col("first_y"))
    within = F.abs(F.col("s") - F.col("z")) <= most
    pairs = (
        probes.join(others, key)
        .where((F.col("label") != F.col("label_y")) & within & enough & here)
        .select("r", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    found = materialise(_similar_by_differences(pairs, differences, percent), "jaccard-by-differences")
    discard(known, classes, facts, entries)
    return found


def linked_components(
    df: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, hot: int = HOT
) -> DataFrame:
    """(node, label): the smallest node reachable by links, for each set that has a link to another set.

    Nodes are the smallest identifiers of equal sets.
    """
    spark = df.sparkSession
    ship(spark)
    docs = df.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    size = F.octet_length("text")
    # The number of sets in each band is estimated from the texts' sizes; it only steers the allocation.
    guess = docs.groupBy(F.floor(F.log2(F.coalesce(size, F.lit(0)) / 6 + 1)).alias("p")).count().collect()
    sets = {int(r["p"]): r["count"] for r in guess}
    bands = {b: allocate(b, sets.get(int(math.log2(LOWS[b] + 1)), 0), percent) for b in range(len(LOWS) - 1)}
    buckets = partitions_for(spark, total_bytes(docs, "text"), BUCKET_BYTES)
    index = _index(docs, "text", "node", bands, buckets, percent)
    grouped = materialise(_grouped(index, buckets, percent, hot), "jaccard-groups")

    # Pairs that share as many entries as they must; their hot ones may be among those they share.
    hot_of = grouped.where("hot").groupBy("a", "band").agg(F.count("*").alias("h"))
    hot_of = materialise(hot_of, "jaccard-hot")
    pairs = grouped.where("NOT hot").groupBy("a", "b", "band", "need").agg(F.sum("number").alias("shared"))
    pairs = (
        pairs.join(hot_of.withColumnRenamed("h", "h_a"), ["a", "band"], "left")
        .join(hot_of.select(F.col("a").alias("b"), "band", F.col("h").alias("h_b")), ["b", "band"], "left")
        .where(
            F.col("shared")
            >= F.greatest(
                F.lit(1),
                F.col("need") - F.least(F.coalesce("h_a", F.lit(0)), F.coalesce("h_b", F.lit(0))),
            )
        )
        .select("a", "b")
        .distinct()
    )
    open_ = materialise(pairs, "jaccard-candidates")
    members = materialise(_members(grouped, percent), "jaccard-members")
    groups = materialise(_groups(members), "jaccard-hot-groups")
    discard(grouped, hot_of)

    active = open_.select(F.col("a").alias("node")).union(open_.select("b")).union(members.select("node")).distinct()
    # A join would move every text of the table to find these.
    texts = materialise(only_listed(docs, materialise(active, "jaccard-active"), ["node"]), "jaccard-texts")
    # Hot groups: everybody is compared with one smallest member, which connects most of them; then with
    # the smallest set of the component that the smallest member of each of its groups is in.
    stars = materialise(_stars(members, groups), "jaccard-stars")
    discard(members, groups)
    links = stars.groupBy(F.col("x").alias("b")).agg(F.min("r").alias("a")).select("a", "b")
    verified = materialise(_verify(links, texts, percent), "jaccard-verified")
    labels = components(verified)
    references = (
        stars.join(labels.toDF("r", "label"), "r", "left")
        .select(F.coalesce("label", "r").alias("r"), "x")
        .union(stars.join(labels.toDF("r", "label"), "r").select(F.col("label").alias("r"), F.col("r").alias("x")))
        .where("r <> x")
        .distinct()
    )
    differences = materialise(_differences(references, texts, percent), "jaccard-differences")
    discard(stars, labels)
    near = differences.where("near").select(F.col("r").alias("a"), F.col("x").alias("b"))
    verified, labels = _merged(verified, near)
    # Candidate pairs: the smallest partner of each set, then a few more, then all that are still apart.
    open_ = _replaced(open_, _apart(open_, labels))
    tries = 1
    while open_.limit(1).count():
        order = Window.partitionBy("b").orderBy("a")
        some = open_.withColumn("k", F.row_number().over(order)).where(F.col("k") <= tries).drop("k")
        links = materialise(some, "jaccard-links")
        before = labels
        verified, labels = _merged(verified, _verify(links, texts, percent))
        open_ = _replaced(open_, _apart(open_.join(links, ["a", "b"], "left_anti"), labels))
        discard(links, before)
        tries = 16 if tries == 1 else 1 << 30  # what is still apart has to be verified in any case
    discard(open_)
    # Members of hot groups that are not connected to their reference may be to those nearest to it, or to each other.
    if differences.limit(1).count():
        verified, labels = _with_found(verified, labels, _by_centres(differences, labels, percent), texts, percent)
        every, differences = differences, _regrouped(differences, labels, texts, percent)
        discard(every)
        near = differences.where("near").select(F.col("r").alias("a"), F.col("x").alias("b"))
        verified, labels = _with_found(verified, labels, materialise(_apart(near, labels), "jaccard-near"), texts, percent)
        verified, labels = _with_found(verified, labels, _by_differences(differences, labels, percent), texts, percent)
    discard(differences, texts, verified)
    return labels


def _merged(verified: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links so far, as a new table, and their components."""
    both = _replaced(verified, verified.union(more).distinct())
    return both, components(both)


def _with_found(verified: DataFrame, labels: DataFrame, found: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """All links and their components with those of the links found, a table that nothing else reads, that are similar by their words."""
    if found.limit(1).count():
        before = labels
        verified, labels = _merged(verified, _verify(found, texts, percent))
        discard(before)
    discard(found)
    return verified, labels


def _replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` as a table, which takes the place of the table it was made from."""
    out = materialise(new, "jaccard-links")
    discard(old)
    return out


def _apart(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links between different components."""
    return (
        links.join(labels.toDF("a", "label_a"), "a", "left")
        .join(labels.toDF("b", "label_b"), "b", "left")
        .where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))
        .select("a", "b")
    )


def jaccard_join(
    df: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, carry: list[str] | None = None
) -> DataFrame:
    """All rows with ``n_shingles`` and ``component_id``, the smallest identifier reachable by links.

    Two texts link when 100 times the intersection of their sets of 5-word shingles is at least ``percent`` times the union. A-Z are lower-cased;
    a text of fewer than five words has its whole sequence as its set; a text without words, or null, has none
    and is linked with nothing, so its component is its own identifier. Identifiers are expected to be unique; of rows that share one each has its own size, and the component
    of its own text. Rows without an identifier link with nothing and have no component. ``carry`` names the columns to return (default: all; columns named
    like the added ones are replaced). A very long text takes about ten times its size in a task. An empty table gives an empty result.
    """
    ship(df.sparkSession)
    df = without(df, [*OUTPUT, "_digest", "_label"])
    carry = [c for c in (df.columns if carry is None else carry) if c in df.columns]
    if key not in carry:
        raise ValueError(f"the identifier {key} has to be carried")
    described = describe(df, text, carry)
    if text not in carry:  # small without the texts, and read twice
        described = materialise(described, "jaccard-sets")
    labels = linked_components(df, text, key, percent)
    # The component of each set that several rows have or that is linked: the label of its smallest identifier.
    of_sets = (
        described.where(F.col("_digest").isNotNull() & F.col(key).isNotNull())
        .groupBy("_digest")
        .agg(F.min(F.col(key).cast("long")).alias("node"), F.count("*").alias("n"))
        .join(labels, "node", "left")
        .where("n > 1 OR label IS NOT NULL")
        .select("_digest", F.coalesce("label", "node").alias("_label"))
    )
    found = described.join(materialise(of_sets, "jaccard-of-sets"), "_digest", "left")
    own = F.col(key).cast("long")
    return found.select(
        *carry, "n_shingles", F.when(own.isNotNull(), F.coalesce("_label", own)).alias("component_id")
    )


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return jaccard_join(docs, carry=["doc_id"])
