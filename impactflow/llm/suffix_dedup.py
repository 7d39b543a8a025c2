"""Removal of repeated passages, with a logarithmic family of suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller identifier. Strings are
judged on the input and never cross documents; strings that only repeat inside one document stay.

Equal strings have to meet in one task without moving every string. Each string of LENGTH bytes names the
least hashed K-byte word in it as its anchor, which depends on nothing but the string. Neighbouring strings with the
same anchor make up a fragment.

1. The anchors' hashes meet; those that occur in one document only are dropped, with all their strings.
2. The fragments of the others are dealt out by anchor. A task takes the fragments of a bucket in the order of their documents, in batches. Each batch
   gets a suffix array (of the suffixes that begin a whole string); it is merge-scanned against the levels of the index for matches in
   earlier documents, and then becomes a level itself. Two levels of one size are merged into one of
   twice the size, so there are never more levels than the logarithm of the number of batches.
3. The matches go back to their documents, which drop the bytes.

Before anything moves, a task gives only the first of equal fragments to the index and settles the others itself, so a passage
that a third of all documents share is sent once for each task. Nothing is compared by hash alone but anchors, and those only decide
who meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, bytes_of, discard, materialise, partitions_for, read, ship, slices, total_bytes, without
from .shingles import mix64

LENGTH, K = 50, 24
SLICE_BYTES, BLOCK = 2 << 20, 1 << 21
#: Anchors or fragments a task holds before it deals them out; strings in a batch of the index.
ENTRIES, FRAGMENTS, BATCH = 1 << 20, 1 << 17, 1 << 17
#: Bytes of text that one bucket stands for.
BUCKET_BYTES = 8 << 20
OUTPUT = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
LAST = (1 << 63) - 1  # stands for a null identifier

_RANDOM = np.random.Generator(np.random.PCG64(987_654_321))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 ^ 6
_HIGH = np.uint64(0xFFFFFFFF00000000)

IDENT = [("doc", "<i8"), ("check", "<u4")]
HEAD = np.dtype(IDENT)
ANCHOR = np.dtype([("key", "<u8"), ("row", "<u4")])
SHARED = np.dtype([*IDENT, ("key", "<u8")])
PIECE = np.dtype([("key", "<u8"), ("row", "<u4"), ("at", "<u4"), ("size", "u1")])
SPAN = np.dtype([*IDENT, ("start", "<i8"), ("end", "<i8")])
MANY = np.uint32(1 << 31)  # set in an anchor's row: it occurs in several documents of its task


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def fragments(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """First and last string of each fragment (positions in ``data``), and its anchor's hash.

    Every string of ``length`` bytes inside a text is in exactly one fragment.
    """
    total = len(data) - length + 1
    firsts, lasts, keys = [], [], []
    if total <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    step = np.zeros(len(data) + 1, np.int32)
    begin = ends[:-1]
    np.add.at(step, begin, 1)
    np.add.at(step, np.maximum(begin, ends[1:] - length + 1), -1)
    inside = np.cumsum(step[:total]) > 0
    text_begins = np.zeros(len(data) + 1, bool)
    text_begins[begin] = True
    wide = length - k + 1  # words in a string
    power, inverse = _powers(BLOCK + length + 1)
    for s in range(0, total, BLOCK):
        e = min(s + BLOCK, total)
        part = data[s : e + length - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        m = len(part) - k + 1
        h = mix64((sums[k:] - sums[:m]) * inverse[:m])
        least = (h & _HIGH) | np.arange(m, dtype=np.uint64)
        span = 1
        while span * 2 <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = wide - span
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = np.flatnonzero(inside[s:e])
        if not len(at):
            continue
        anchor = (least[at] & ~_HIGH).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | text_begins[s + at[1:]]
        first = np.flatnonzero(new)
        firsts.append(s + at[first])
        lasts.append(s + at[np.append(first[1:], len(at)) - 1])
        keys.append(h[anchor[first]])
    if not firsts:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(keys)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (((mix64(key) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _home(rows: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a document; the same as ``_home_column``."""
    return (rows["check"].astype(np.int64) ^ (rows["doc"] & 0xFFFFFFFF)) % buckets


def _home_column(buckets: int) -> F.Column:
    low = F.col("doc").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.pmod(F.col("check").bitwiseXOR(low), F.lit(buckets)).cast("int")


def _dealt(by: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each bucket."""
    order = np.argsort(by, kind="stable")
    by = by[order]
    cut = np.concatenate([[0], np.flatnonzero(by[1:] != by[:-1]) + 1, [len(by)]])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if a < b:
            yield int(by[a]), rows[order[a:b]]


_KEYED = "bucket int, home int, heads binary, entries binary, bytes binary"


def _keyed_batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 64):
        bucket, home, heads, entries, data = zip(*rows[a : a + 64], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), pa.array(home, pa.int32()), *(binaries(list(x)) for x in (heads, entries, data))],
            names=["bucket", "home", "heads", "entries", "bytes"],
        )


def _homed(homes: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(homes), 64):
        some = homes[a : a + 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in some], pa.int32()), binaries([r.tobytes() for _, r in some])],
            names=["home", "blob"],
        )


def _anchors(texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """Anchors by bucket. Those found in several documents of a task are told to these documents at once (``home``)."""

    def group(held: list[np.ndarray], heads: np.ndarray) -> Iterator[pa.RecordBatch]:
        entries = np.concatenate(held)
        doc = heads["doc"][entries["row"]]
        order = np.lexsort((doc, entries["key"]))
        entries, doc = entries[order], doc[order]
        first = np.ones(len(entries), bool)
        first[1:] = entries["key"][1:] != entries["key"][:-1]
        number = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        last = np.append(at[1:], len(entries)) - 1
        many = (doc[last] != doc[at])[number]
        out = []
        if many.any():
            told = np.empty(int(many.sum()), SHARED)
            told["doc"], told["check"] = doc[many], heads["check"][entries["row"][many]]
            told["key"] = entries["key"][many]
            out += [(home, home, b"", rows.tobytes(), b"") for home, rows in _dealt(_home(told, buckets), told)]
        sent = entries[~many | first]
        sent["row"] |= np.where(many[~many | first], MANY, np.uint32(0))
        for bucket, rows in _dealt(_bucket(sent["key"], buckets), sent):
            used, local = np.unique(rows["row"] & ~MANY, return_inverse=True)
            rows = rows.copy()
            rows["row"] = local.astype(np.uint32) | (rows["row"] & MANY)
            out.append((bucket, -1, heads[used].tobytes(), rows.tobytes(), b""))
        yield from _keyed_batch(out)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        heads: list[np.ndarray] = []
        count = rows = 0
        for batch in slices(batches, "text", SLICE_BYTES):
            data, ends = bytes_of(batch.column("text"))
            first, _, key = fragments(data, ends, length)
            head = np.empty(batch.num_rows, HEAD)
            head["doc"], head["check"] = batch.column("doc").to_numpy(), batch.column("check").to_numpy()
            entry = np.empty(len(key), ANCHOR)
            entry["key"], entry["row"] = key, rows + np.searchsorted(ends, first, "right") - 1
            entry = np.unique(entry)
            held.append(entry)
            heads.append(head)
            count, rows = count + len(entry), rows + len(head)
            if count >= ENTRIES:
                yield from group(held, np.concatenate(heads))
                held, heads, count, rows = [], [], 0, 0
        if count:
            yield from group(held, np.concatenate(heads))

    return texts.select("doc", "check", "text").mapInArrow(find, _KEYED)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list]]:
    """Of each bucket: heads and entries (and bytes) of the pieces to compare; the blobs that only pass through."""
    now, heads, entries, data, past = None, [], [], [], []
    for batch in batches:
        for bucket, home, h, e, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is not None and bucket != now:
                yield heads, entries, data, past
                heads, entries, data, past = [], [], [], []
            now = bucket
            if home >= 0:
                past.append((home, e))
            else:
                heads.append(np.frombuffer(h, HEAD))
                entries.append(e)
                data.append(d)
    if now is not None:
        yield heads, entries, data, past


def _joined(heads: list[np.ndarray], entries: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All heads, and all entries with their rows counted through."""
    shift = np.concatenate([[0], np.cumsum([len(h) for h in heads])[:-1]])
    parts = [np.frombuffer(e, kind).copy() for e in entries]
    for p, s in zip(parts, shift.tolist(), strict=True):
        p["row"] += np.uint32(s)
    return np.concatenate(heads), np.concatenate(parts)


def _shared(anchors: DataFrame, buckets: int) -> DataFrame:
    """(home, blob): the anchors of each document that occur in another document too."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for heads, entries, _, past in _by_bucket(batches):
            for _, blob in past:
                found.append(np.frombuffer(blob, SHARED))
            if entries:
                head, entry = _joined(heads, entries, ANCHOR)
                many = (entry["row"] & MANY) > 0
                row = entry["row"] & ~MANY
                doc = head["doc"][row]
                order = np.lexsort((doc, entry["key"]))
                entry, row, doc, many = entry[order], row[order], doc[order], many[order]
                first = np.ones(len(entry), bool)
                first[1:] = entry["key"][1:] != entry["key"][:-1]
                at = np.flatnonzero(first)
                number = np.cumsum(first) - 1
                last = np.append(at[1:], len(entry)) - 1
                both = (doc[last] != doc[at]) | np.logical_or.reduceat(many, at)
                told = both[number] & ~many
                rows = np.empty(int(told.sum()), SHARED)
                rows["doc"], rows["check"] = doc[told], head["check"][row[told]]
                rows["key"] = entry["key"][told]
                found.append(rows)
            if sum(map(len, found)) >= ENTRIES:
                every = np.concatenate(found)
                yield from _homed(list(_dealt(_home(every, buckets), every)))
                found = []
        if found:
            every = np.concatenate(found)
            yield from _homed(list(_dealt(_home(every, buckets), every)))

    grouped = anchors.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(meet, "home int, blob binary")


def _with_texts(blobs: DataFrame, texts: DataFrame, buckets: int) -> DataFrame:
    """Blobs and texts of the same home together, the blobs first."""
    rows = [f for f in texts.schema.fields if f.name not in ("home",)]
    left = blobs.select(
        "home", F.lit(0).alias("kind"), "blob", *(F.lit(None).cast(f.dataType).alias(f.name) for f in rows)
    )
    right = texts.select("home", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("blob"), *(f.name for f in rows))
    return left.union(right).repartition(buckets, "home").sortWithinPartitions("home", "kind")


def _homes(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """Batches of texts, each with what was sent to its home, by document."""
    now, blobs, sent = None, [], None
    for batch in batches:
        homes = batch.column("home").to_numpy()
        kinds = batch.column("kind").to_numpy()
        edge = np.flatnonzero((homes[1:] != homes[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        cut = [0, *edge.tolist(), batch.num_rows]
        for a, b in zip(cut, cut[1:], strict=False):
            if a == b:
                continue
            if homes[a] != now:
                now, blobs, sent = homes[a], [], None
            if kinds[a] == 0:
                blobs += [np.frombuffer(x, kind) for x in batch.column("blob").slice(a, b - a).to_pylist()]
                continue
            if sent is None:
                sent = {}
                if blobs:
                    rows = np.concatenate(blobs)
                    rows = rows[np.lexsort((rows["check"], rows["doc"]))]
                    new = np.flatnonzero((rows["doc"][1:] != rows["doc"][:-1]) | (rows["check"][1:] != rows["check"][:-1])) + 1
                    starts = [0, *new.tolist(), len(rows)]
                    for s, e in zip(starts, starts[1:], strict=False):
                        sent[int(rows["doc"][s]), int(rows["check"][s])] = rows[s:e]
            yield sent, batch.slice(a, b - a)


def _rows_of(piece: np.ndarray, start: np.ndarray, data: np.ndarray, width: int) -> np.ndarray:
    """The bytes of each fragment, filled up with zeros to one width."""
    size = piece["size"].astype(np.int64)
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[start]
    return np.where(np.arange(width) < size[:, None], rows, np.uint8(0))


def first_of_equals(piece: np.ndarray, doc: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fragment the index of the one that stands for all equal ones, and that one's document, the smallest."""
    values = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()
    mark = mix64(piece["key"] + piece["size"])
    for a in range(0, rows.shape[1] - 7, 8):
        mark = mix64(mark ^ np.ascontiguousarray(rows[:, a : a + 8]).view("<u8").ravel())
    order = np.lexsort((piece["at"], doc, mark))
    same = np.zeros(len(order), bool)
    before, after = order[:-1], order[1:]
    like = (mark[after] == mark[before]) & (piece["size"][after] == piece["size"][before])
    same[1:] = like
    at = np.flatnonzero(like)
    same[1:][at] = values[after[at]] == values[before[at]]
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    out = np.empty(len(order), np.int64)
    out[order] = order[leader]
    return out, doc[out]


def _fragments(shared: DataFrame, texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """Fragments with shared anchors by bucket; of equal ones in a task, only those of the first document."""
    width = 2 * length - K + 6 & ~7

    def group(held: list[tuple], heads: np.ndarray) -> Iterator[pa.RecordBatch]:
        piece = np.concatenate([p for p, _, _ in held])
        lengths = [len(d) for _, _, d in held]
        shift = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        start = np.concatenate([s + o for (_, s, _), o in zip(held, shift.tolist(), strict=True)])
        data = np.concatenate([d for _, _, d in held])
        doc = heads["doc"][piece["row"]]
        rows = _rows_of(piece, start, data, width)
        _, first = first_of_equals(piece, doc, rows)
        pack = zstandard.ZstdCompressor(level=1)  # overlapping fragments of prose, half the size of a shuffle's own
        out = []
        later = doc > first
        if later.any():
            span = np.empty(int(later.sum()), SPAN)
            span["doc"], span["check"] = doc[later], heads["check"][piece["row"][later]]
            span["start"] = piece["at"][later]
            span["end"] = span["start"] + piece["size"][later].astype(np.int64)
            span = merged(span)
            out += [(home, home, b"", s.tobytes(), b"") for home, s in _dealt(_home(span, buckets), span)]
        kept = np.flatnonzero(~later)
        for bucket, index in _dealt(_bucket(piece["key"][kept], buckets), kept):
            some = piece[index]
            used, local = np.unique(some["row"], return_inverse=True)
            some["row"] = local
            inside = np.arange(width) < some["size"][:, None]
            packed = pack.compress(rows[index][inside].tobytes())
            out.append((bucket, -1, heads[used].tobytes(), some.tobytes(), packed))
        yield from _keyed_batch(out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        heads: list[np.ndarray] = []
        count = many = 0
        for sent, texts in _homes(batches, SHARED):
            for batch in slices(iter([texts]), "text", SLICE_BYTES):
                docs, checks = batch.column("doc").to_pylist(), batch.column("check").to_pylist()
                wanted = [sent.get((d, c)) for d, c in zip(docs, checks, strict=True)]
                if not any(w is not None for w in wanted):
                    continue
                data, ends = bytes_of(batch.column("text"))
                first, last, key = fragments(data, ends, length)
                text = np.searchsorted(ends, first, "right") - 1
                edges = np.searchsorted(text, np.arange(len(docs) + 1))
                good = np.zeros(len(first), bool)
                for i, w in enumerate(wanted):
                    if w is not None:
                        a, b = edges[i], edges[i + 1]
                        good[a:b] = np.isin(key[a:b], w["key"])
                first, last, key, text = first[good], last[good], key[good], text[good]
                piece = np.empty(len(first), PIECE)
                piece["key"], piece["row"] = key, many + text
                piece["at"], piece["size"] = first - ends[text], last - first + length
                head = np.empty(len(docs), HEAD)
                head["doc"], head["check"] = docs, checks
                held.append((piece, first, data))
                heads.append(head)
                count, many = count + len(piece), many + len(head)
                if count >= FRAGMENTS:
                    yield from group(held, np.concatenate(heads))
                    held, heads, count, many = [], [], 0, 0
        if count:
            yield from group(held, np.concatenate(heads))

    return _with_texts(shared, texts.select("home", "doc", "check", "text"), buckets).mapInArrow(cut, _KEYED)


def merged(span: np.ndarray) -> np.ndarray:
    """Spans of the same document that touch or overlap become one."""
    if len(span) < 2:
        return span
    span = span[np.lexsort((span["start"], span["check"], span["doc"]))]
    new = np.ones(len(span), bool)
    new[1:] = (span["doc"][1:] != span["doc"][:-1]) | (span["check"][1:] != span["check"][:-1])
    group = np.cumsum(new) - 1
    # The greatest end so far in each document: ends are lifted by document, so one running maximum will do.
    lift = group * (int(span["end"].max()) + 2)
    reach = np.maximum.accumulate(span["end"] + lift)
    new[1:] |= span["start"][1:] + lift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    out = span[at]
    last = np.append(at[1:], len(span)) - 1
    out["end"] = reach[last] - lift[last]
    return out


class Family:
    """Suffix arrays of geometric sizes over batches that come in the order of their documents.

    A level holds the distinct strings of its batches, sorted, each with the first document that has it.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, strings: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which strings of a batch also start in a smaller document; the batch joins the index."""
        order = np.lexsort((np.arange(len(doc)), doc)) if np.any(doc[1:] < doc[:-1]) else np.arange(len(doc))
        order = order[np.argsort(strings[order], kind="stable")]
        ranked = strings[order]
        new = np.ones(len(order), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        at = np.flatnonzero(new)
        array, first = ranked[at], doc[order[at]]
        earliest = first.copy()
        places = []
        for _, level, docs in self.levels:  # the merge scan
            place = np.searchsorted(level, array)
            places.append(place)
            hit = np.minimum(place, len(level) - 1)
            equal = level[hit] == array
            earliest[equal] = np.minimum(earliest[equal], docs[hit[equal]])
        matched = np.empty(len(order), bool)
        matched[order] = doc[order] > earliest[np.cumsum(new) - 1]
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, level, docs = self.levels.pop()
            array, first = self._merge(level, docs, array, first)
            size *= 2
        self.levels.append((size, array, first))
        return matched

    @staticmethod
    def _merge(a: np.ndarray, a_doc: np.ndarray, b: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(a, b)
        hit = np.minimum(place, len(a) - 1)
        new = a[hit] != b  # of equal strings the older level has the smaller document
        return np.insert(a, place[new], b[new]), np.insert(a_doc, place[new], b_doc[new])


def _search(heads: np.ndarray, piece: np.ndarray, data: np.ndarray, length: int, batch: int) -> np.ndarray:
    """Spans of a bucket's fragments whose strings start in a smaller document."""
    width = 2 * length - K + 6 & ~7
    size = piece["size"].astype(np.int64)
    start = np.cumsum(size) - size
    doc = heads["doc"][piece["row"]]
    leader, first = first_of_equals(piece, doc, _rows_of(piece, start, data, width))
    later = np.flatnonzero(doc > first)

    def spans(index: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(index), SPAN)
        out["doc"], out["check"] = doc[index], heads["check"][piece["row"][index]]
        at = piece["at"][index].astype(np.int64)
        out["start"], out["end"] = at + begin, at + end
        return out

    found = [spans(later, np.zeros(len(later), np.int64), size[later])]
    # Anchors with several different fragments: their strings are compared.
    leaders = np.unique(leader)
    order = leaders[np.argsort(piece["key"][leaders], kind="stable")]
    key = piece["key"][order]
    alone = np.ones(len(order) + 1, bool)
    alone[1:-1] = key[1:] != key[:-1]
    order = order[~(alone[1:] & alone[:-1])]
    order = order[np.argsort(doc[order], kind="stable")]
    strings = np.lib.stride_tricks.sliding_window_view(data, length) if len(data) >= length else None
    number = size[order] - length + 1
    family = Family()
    # The last part ends behind the last fragment, also where the strings fill their batches exactly.
    parts = np.searchsorted(np.cumsum(number), np.arange(0, int(number.sum()), batch), "left")
    parts = np.append(parts, len(order))
    aliases = np.flatnonzero(doc == first)  # equal fragments of the first document itself
    aliases = aliases[np.argsort(leader[aliases], kind="stable")]
    for a, b in zip(parts[:-1].tolist(), parts[1:].tolist(), strict=True):
        some = order[a:b]
        if not len(some):
            continue
        n = size[some] - length + 1
        owner = np.repeat(np.arange(len(some)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        rows = np.ascontiguousarray(strings[start[some][owner] + offset]).view(f"V{length}").ravel()
        hit = family.add(rows, doc[some][owner])
        edge = np.zeros(len(hit) + 1, bool)
        edge[1:-1] = (owner[1:] != owner[:-1]) | (hit[1:] != hit[:-1])
        edge[0] = edge[-1] = True
        cut = np.flatnonzero(edge)
        run = np.flatnonzero(hit[cut[:-1]])
        begin, end = cut[run], cut[run + 1] - 1
        lead = some[owner[begin]]
        lo = np.searchsorted(leader[aliases], lead, "left")
        hi = np.searchsorted(leader[aliases], lead, "right")
        times = hi - lo
        which = np.repeat(np.arange(len(lead)), times)
        index = aliases[np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + lo[which]]
        found.append(spans(index, offset[begin][which], offset[end][which] + length))
    return merged(np.concatenate(found))


def _matches(pieces: DataFrame, buckets: int, length: int, batch: int) -> DataFrame:
    """(home, blob): the repeated spans of each document."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for heads, entries, data, past in _by_bucket(batches):
            found += [np.frombuffer(blob, SPAN) for _, blob in past]
            if entries:
                head, piece = _joined(heads, entries, PIECE)
                unpack = zstandard.ZstdDecompressor()
                strings = np.frombuffer(b"".join(map(unpack.decompress, data)), np.uint8)
                found.append(_search(head, piece, strings, length, batch))
            if sum(map(len, found)) >= ENTRIES:
                every = merged(np.concatenate(found))
                yield from _homed(list(_dealt(_home(every, buckets), every)))
                found = []
        if found:
            every = merged(np.concatenate(found))
            yield from _homed(list(_dealt(_home(every, buckets), every)))

    grouped = pieces.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(search, "home int, blob binary")


def remove_repeats(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    carry: list[str] | None = None,
    length: int = LENGTH,
    batch: int = BATCH,
) -> DataFrame:
    """All rows with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (start and end of each removed run) and ``kept``.

    Texts are UTF-8 bytes, null is empty; ``kept`` is binary, as a run may end inside a character. Rows without an identifier come after
    all others; rows with equal identifiers take nothing from each other, so repeated rows stay repeated. ``carry`` names the columns to
    return (default: all; columns named like the added ones are replaced). An empty table gives an empty result.
    """
    if not K < length < 128:
        raise ValueError(f"length is over {K} and under 128")
    spark = df.sparkSession
    ship(spark)
    df = without(df, OUTPUT)
    carry = [c for c in (df.columns if carry is None else carry) if c in df.columns]
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    buckets = partitions_for(spark, total_bytes(df, text), BUCKET_BYTES)
    texts = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"),
        F.crc32(body).alias("check"),
        body.alias("text"),
        F.struct(F.lit(0).alias("_"), *carry).alias("rest"),
    ).withColumn("home", _home_column(buckets))
    shared = materialise(_shared(_anchors(texts, buckets, length), buckets), "repeats-anchors")
    pieces = _fragments(shared, texts, buckets, length)
    matches = materialise(_matches(pieces, buckets, length, batch), "repeats-spans")
    discard(shared)

    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sent, texts in _homes(batches, SPAN):
            for some in slices(iter([texts]), "text", SLICE_BYTES):
                sizes, removed, counts, lists, kept = [], [], [], [], []
                columns = (some.column(c).to_pylist() for c in ("doc", "check", "text"))
                for doc, check, body in zip(*columns, strict=True):
                    span = sent.get((doc, check))
                    span = [] if span is None else merged(span)
                    pairs = [(int(s["start"]), int(s["end"])) for s in span]
                    at, parts = 0, []
                    for s, e in pairs:
                        parts.append(body[at:s])
                        at = e
                    parts.append(body[at:])
                    sizes.append(len(body))
                    kept.append(b"".join(parts))
                    removed.append(len(body) - len(kept[-1]))
                    counts.append(len(pairs))
                    lists.append([{"start": s, "end": e} for s, e in pairs])
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("rest"),
                        *(pa.array(x, pa.int64()) for x in (sizes, removed, counts)),
                        pa.array(lists, arrow_spans),
                        binaries(kept),
                    ],
                    names=["rest", *OUTPUT],
                )

    rest = T.StructField("rest", texts.schema["rest"].dataType)
    longs = [T.StructField(c, T.LongType()) for c in OUTPUT[:3]]
    schema = T.StructType([rest, *longs, T.StructField("spans", spans_type), T.StructField("kept", T.BinaryType())])
    done = _with_texts(matches, texts, buckets).mapInArrow(drop, schema)
    return done.select(*(F.col("rest")[c].alias(c) for c in carry), *OUTPUT)


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    out = remove_repeats(docs, carry=["doc_id"])
    return out.select("doc_id", *OUTPUT[:3], F.sha2("kept", 256).alias("kept_sha256"))
