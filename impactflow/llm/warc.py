"""WARC archives with segmented records, written and read by Spark.

Writing: one record for each row. Payloads that are equal are stored once; the others become revisit records. A block
longer than a segment is cut: the first segment is a ``response`` record with number 1, the others
are ``continuation`` records with the origin's identifier and their number, and the last one tells the
total length. Payloads are sent in chunked transfer framing, and a chunk ends inside each ``WARC/1.1`` of
a payload, so that line occurs nowhere but at the beginning of a record.

Reading: the files are split at these lines, by Spark's text source, so that a task holds a record at a time and any
file system that Spark knows will do. Continuation records are grouped by origin, ordered by
segment number and checked against the total length; then the chunked framing is decoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .common import materialise, read, ship

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
SEGMENT_BYTES, CHUNK_BYTES = 16 << 10, 4 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing; no chunk holds a whole version mark."""
    cuts = set(range(0, len(payload), size)) | {len(payload)}
    at = payload.find(VERSION)
    while at >= 0:
        cuts.add(at + 4)
        at = payload.find(VERSION, at + 1)
    ends = sorted(cuts)
    parts = [payload[a:b] for a, b in zip(ends, ends[1:], strict=False) if a < b]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        at = end + 2
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def record_id(key: object, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}:{digest.hex()}')}>"


def _field(value: object) -> str:
    """A header value on one line that holds no version mark: control characters, and the mark's last one, are percent-encoded."""
    plain = "".join(f"%{ord(c):02X}" if c < "!" or c == "\x7f" else c for c in str(value))
    mark = VERSION.decode()
    return plain.replace(mark, f"{mark[:-1]}%{ord(mark[-1]):02X}")


def _exact(name: str, value: object | None) -> list[tuple[str, str]]:
    """The header for a value, and where that is not the value itself, its bytes in base64, which has no dot and so no mark."""
    if value is None:
        return []
    safe = _field(value)
    bare = name.removeprefix("WARC-").removeprefix("X-")
    return [(name, safe)] + ([(f"X-{bare}-Base64", base64.b64encode(str(value).encode()).decode())] if safe != str(value) else [])


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"%b\r\n%bContent-Length: %d\r\n\r\n%b\r\n\r\n" % (VERSION, head.encode(), len(block), block)


def records(
    key: object, url: str | None, payload: bytes, digest: bytes, first: object, segment_bytes: int
) -> list[bytes]:
    """The records of one row: a revisit, a response, or a response and its continuations."""
    own = record_id(key, digest)
    shared = [
        ("WARC-Record-ID", own),
        ("WARC-Date", DATE),
        *_exact("WARC-Target-URI", url),
        ("WARC-Payload-Digest", "sha1:" + base32(digest)),
        *_exact("X-Record-Key", key),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None and first != key:
        fields = [
            ("WARC-Type", "revisit"),
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(first, digest)),
            *_exact("X-Refers-To-Key", first),
        ]
        return [_record([*fields, *shared], status + b"Content-Length: %d\r\n\r\n" % len(payload))]
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        return [_record([("WARC-Type", "response"), *shared], block)]
    out = []
    starts = range(0, len(block), segment_bytes)
    for number, at in enumerate(starts, 1):
        total = len(block) if number == len(starts) else None
        if number == 1:
            fields = [("WARC-Type", "response"), *shared, ("WARC-Segment-Number", 1)]
        else:
            fields = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}:{number}')}>"),
                ("WARC-Date", DATE),
                ("WARC-Segment-Origin-ID", own),
                ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", total),
            ]
        out.append(_record(fields, block[at : at + segment_bytes]))
    return out


def write_archives(
    df: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_from: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    compression: str = "gzip",
) -> None:
    """Write a record for each row to WARC files in ``path``.

    A string payload is stored in UTF-8, null as an empty one. Of rows with equal payloads of at least ``revisit_from`` bytes the
    smallest key is the response and the others revisit it; rows that repeat that key are responses too. Rows without a
    key revisit the smallest key, or are responses where their group has none. Urls and keys may hold anything, the version mark and line ends too,
    and are read back as they were. Other columns are not read, so their names cannot clash; an empty table gives an empty folder. A payload is held whole by
    one task, with its framed copy, so it must fit there a few times; long ones are cut into segments. A compressed file is one gzip
    member, as Spark's text sink writes it. Only keys and digests are grouped, with sums that combine before
    they move, and a payload that a third of all rows have is dealt over many tasks by the join.
    """
    ship(df.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    held = df.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload")
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    firsts = (
        held.where(F.octet_length("payload") >= revisit_from)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = held.join(materialise(firsts, "warc-firsts"), "digest", "left")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "url", "payload", "digest", "first")
        for batch in batches:
            out: list[bytes] = []
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                out += records(*row, segment_bytes)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[:-1] for r in out], pa.binary())], names=["value"])
                    out = []
            yield pa.RecordBatch.from_arrays([pa.array([r[:-1] for r in out], pa.binary())], names=["value"])

    # The text writer adds the last line feed of a record.
    joined.mapInArrow(make, "value binary").select(F.col("value").cast("string")).write.option(
        "lineSep", "\n"
    ).option("compression", compression).text(path)


_PARSED = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("total", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("block", T.BinaryType()),
    ]
)


def parse(raw: bytes) -> dict | None:
    """The fields of a record without its version line; None if it is cut off or no record."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = {}
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        length = int(fields["content-length"])
        segment = int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None
        total = int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None
    except (KeyError, ValueError):
        return None
    if len(rest) < length:
        return None

    def exact(name: str) -> str | None:
        coded = fields.get(f"x-{name.removeprefix('warc-').removeprefix('x-')}-base64")
        try:
            return fields.get(name) if coded is None else base64.b64decode(coded, validate=True).decode()
        except ValueError:
            return fields.get(name)

    return {
        "type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "origin": fields.get("warc-segment-origin-id", fields.get("warc-record-id")),
        "segment": segment,
        "total": total,
        "key": exact("x-record-key"),
        "uri": exact("warc-target-uri"),
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "refers_to": exact("x-refers-to-key"),
        "block": rest[:length],
    }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives; ``type`` is null for one that is cut off."""
    ship(spark)
    raw = spark.read.option("lineSep", (VERSION + b"\r\n").decode()).text(path)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = dict.fromkeys(_PARSED.names)
        schema = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in _PARSED])
        for batch in batches:
            found = [parse(x) or none for x in batch.column(0).to_pylist() if x]
            yield pa.RecordBatch.from_pylist(found, schema)

    return raw.select(F.col("value").cast("binary")).mapInArrow(split, _PARSED)


_ARROW = {"string": pa.string(), "integer": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def assemble(segments: list[dict]) -> bytes | None:
    """The block of a record from all its segments; None unless they are whole."""
    ordered = sorted(segments, key=lambda s: s["segment"])
    if [s["segment"] for s in ordered] != list(range(1, len(ordered) + 1)):
        return None
    block = b"".join(s["block"] for s in ordered)
    return block if ordered[-1]["total"] == len(block) else None


def message(block: bytes) -> tuple[bytes | None, int | None]:
    """Payload and its length of an HTTP message; a message without a body only tells the length."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, None
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip()
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        payload = unchunked(body)
        return payload, None if payload is None else len(payload)
    length = fields.get(b"content-length", b"")
    n = int(length) if length.isdigit() else len(body)
    return (body if len(body) == n else None), n


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(key, uri, record_type, payload, payload_bytes, payload_digest, refers_to, complete) of each record.

    The digest of a response is that of the payload read; a revisit has no payload, and its digest and length
    are those it states. A long payload is put together by one task, and archives without records give an empty result. ``complete`` is false, and what could not be read null, for a record that is
    cut off, lacks a segment, misses its total length, or does not match its own digest. Records that are stored more than once are
    returned as often. Only segmented records are moved.
    """
    found = read_records(spark, path)
    columns = ["type", "key", "uri", "digest", "refers_to", "block"]
    single = found.where("segment IS NULL").select(*columns, F.lit(1).cast("long").alias("copies"))
    # Equal records are held once, so a group is no larger than one record.
    groups = (
        found.where("segment IS NOT NULL")
        .groupBy("origin")
        .agg(
            F.collect_set(F.struct("segment", "total", *columns)).alias("segments"),
            F.greatest(F.count_if(F.col("segment") == 1), F.lit(1)).cast("long").alias("copies"),
        )
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*((c, pa.binary() if c == "block" else pa.string()) for c in columns), ("copies", pa.int64())])
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                first = min(x["segments"], key=lambda s: s["segment"])
                rows.append({c: first[c] for c in columns} | {"block": assemble(x["segments"]), "copies": x["copies"]})
            yield pa.RecordBatch.from_pylist(rows, schema)

    whole = single.unionByName(groups.mapInArrow(join, single.schema))
    out = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("uri", T.StringType()),
            T.StructField("record_type", T.StringType()),
            T.StructField("payload", T.BinaryType()),
            T.StructField("payload_bytes", T.LongType()),
            T.StructField("payload_digest", T.StringType()),
            T.StructField("refers_to", T.StringType()),
            T.StructField("complete", T.BooleanType()),
        ]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(f.name, pa.bool_() if f.name == "complete" else _ARROW[f.dataType.typeName()]) for f in out]
        )
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload, n = message(r["block"]) if r["block"] is not None else (None, None)
                digest = r["digest"]
                if r["type"] != "revisit":
                    digest = None if payload is None else base32(hashlib.sha1(payload).digest())
                complete = n is not None and digest is not None and digest == (r["digest"] or digest)
                row = {
                    "key": r["key"],
                    "uri": r["uri"],
                    "record_type": r["type"],
                    "payload": None if r["type"] == "revisit" else payload,
                    "payload_bytes": n,
                    "payload_digest": digest,
                    "refers_to": r["refers_to"],
                    "complete": complete,
                }
                rows += [row] * r["copies"]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return whole.mapInArrow(decode, out)


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_archives(read(spark, sf, "pages"), path)
    return read_archives(spark, path).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


OP2_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM p)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT)
                   >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
