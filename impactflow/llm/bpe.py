"""Byte-level BPE by overlapping chunks.

A text longer than ``chunk`` code points is cut into chunks that overlap by ``overlap`` code points
and are pre-tokenised in parallel, each from its own first code point. A chunk may begin in the
middle of a pre-token; but where two neighbours have a boundary at the same place they agree
from there on, as a match depends on nothing before it. There they are stitched, and each chunk
encodes the pre-tokens from its own stitch to the next one's. A text with an overlap in which the neighbours
never agree (a run of many thousand letters, say) is encoded as one piece, so the result is
always that of the whole text. Shorter texts are a single chunk and are not moved at all.

The rank file is read from a path that every executor has; the vocabulary is never trained here.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, frugal, materialise, read, ship, slices, without

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: A match of the pattern is settled once so many code points behind it are known.
LOOK = 8
#: A worker forgets its pre-tokens beyond so many; they are then encoded again.
REMEMBERED = 100_000
BATCH_BYTES = 4 << 20


class Codec(dict):
    """Pre-token to its ids (four bytes each, little-endian), filled as they occur."""

    def __init__(self, ranks: str, pattern: str) -> None:
        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self.find = regex.compile(pattern).findall
        self.merge = encoding._core_bpe.encode_single_piece
        self.bytes_of = {i: piece for piece, i in table.items()}

    def __missing__(self, piece: str) -> bytes:
        ids = np.asarray(self.merge(piece.encode()), "<u4").tobytes()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def starts(self, text: str) -> list[int]:
        """Where the pre-tokens of a text begin, and its end."""
        return list(accumulate(map(len, self.find(text)), initial=0))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(ranks: str, pattern: str) -> Codec:
    """The codec of this worker process."""
    if (ranks, pattern) not in _CODECS:
        _CODECS[ranks, pattern] = Codec(ranks, pattern)
    return _CODECS[ranks, pattern]


def stitch(tail: list[int], head: list[int]) -> int | None:
    """The first boundary, from the later chunk's beginning on, that both chunks have."""
    common = set(tail).intersection(head)
    return min(common) if common else None


def _add_ids(df: DataFrame, text: str, outs: list[str], ranks: str, pattern: str) -> DataFrame:
    """Replace the text column by its ids and, if ``outs`` names a second column, what they decode to."""

    @frugal
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in slices(batches, text, BATCH_BYTES):
            at = batch.schema.get_field_index(text)
            ids = [c.encode(t or "") for t in batch.column(at).to_pylist()]
            result = batch.remove_column(at).append_column(outs[0], binaries(ids))
            for out in outs[1:]:
                result = result.append_column(out, binaries([c.decode(x) for x in ids]))
            yield result

    fields = [f for f in df.schema.fields if f.name != text]
    return df.mapInArrow(
        encode, T.StructType([*fields, *(T.StructField(out, T.BinaryType()) for out in outs)])
    )


def _chunks(df: DataFrame, text: str, chunk: int, overlap: int) -> DataFrame:
    """(_row, _no, _rest, _text): the overlapping chunks of each text; _rest comes with the first."""
    rest = [c for c in df.columns if c not in (text, "_row")]
    packed = df.select("_row", F.struct(F.lit(0).alias("_"), *rest).alias("_rest"), F.col(text).alias("_text"))

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                t = batch.column("_text")[i].as_py()
                parts = [t[a : a + chunk + overlap] for a in range(0, len(t), chunk)]
                n = len(parts)
                rests = pa.concat_arrays(
                    [batch.column("_rest").slice(i, 1), pa.nulls(n - 1, batch.column("_rest").type)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("_row")[i].as_py()] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        rests,
                        pa.array(parts, pa.string()),
                    ],
                    names=["_row", "_no", "_rest", "_text"],
                )

    return packed.mapInArrow(
        cut,
        T.StructType(
            [
                T.StructField("_row", T.LongType()),
                T.StructField("_no", T.IntegerType()),
                T.StructField("_rest", packed.schema["_rest"].dataType),
                T.StructField("_text", T.StringType()),
            ]
        ),
    )


def _with_boundaries(chunks: DataFrame, chunk: int, overlap: int, ranks: str, pattern: str) -> DataFrame:
    """Add the boundaries in the part shared with the chunk before and with the chunk after."""

    @frugal
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            heads, tails = [], []
            for t in batch.column("_text").to_pylist():
                starts = c.starts(t)
                settled = len(t) - LOOK if len(t) > chunk else len(t)
                heads.append([p for p in starts if p < min(overlap, settled)])
                tails.append([p - chunk for p in starts if chunk <= p < settled])
            yield batch.append_column("_head", pa.array(heads, pa.list_(pa.int32()))).append_column(
                "_tail", pa.array(tails, pa.list_(pa.int32()))
            )

    ints = T.ArrayType(T.IntegerType())
    return chunks.mapInArrow(
        find,
        T.StructType([*chunks.schema.fields, T.StructField("_head", ints), T.StructField("_tail", ints)]),
    )


def _stitches(chunks: DataFrame) -> DataFrame:
    """(_row, _starts): where each chunk takes over; null if some neighbours never agree.

    One row of boundaries of the overlaps for each text: small beside the text itself.
    """
    lists = chunks.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("_no", "_head", "_tail"))).alias("_all")
    )

    @frugal
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for chain in batch.column("_all").to_pylist():
                at = [0] + [
                    stitch(a["_tail"], b["_head"]) for a, b in zip(chain, chain[1:], strict=False)
                ]
                found.append(None if None in at else at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(found, pa.list_(pa.int32()))], names=["_row", "_starts"]
            )

    return lists.mapInArrow(meet, "_row long, _starts array<int>")


def _encode_long(df: DataFrame, text: str, outs: list[str], chunk: int, overlap: int, ranks: str, pattern: str) -> DataFrame:
    cut = _chunks(df.withColumn("_row", F.monotonically_increasing_id()), text, chunk, overlap)
    spread = cut.repartition("_row", "_no")
    chunks = materialise(_with_boundaries(spread, chunk, overlap, ranks, pattern), "bpe-chunks")
    rest = chunks.where("_no = 0").select("_row", "_rest")
    # A text that could not be stitched becomes one segment, else every chunk is one.
    segments = (
        chunks.select("_row", "_no", "_text")
        .join(_stitches(chunks), "_row")
        .withColumn("_segment", F.when(F.col("_starts").isNull(), 0).otherwise(F.col("_no")))
        .groupBy("_row", "_segment")
        .agg(
            F.sort_array(F.collect_list(F.struct("_no", "_text"))).alias("_parts"),
            F.first(F.expr("get(_starts, _no)")).alias("_begin"),
            F.first(F.expr("get(_starts, _no + 1)")).alias("_end"),
        )
    )

    @frugal
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for parts, begin, end in zip(
                *(batch.column(x).to_pylist() for x in ("_parts", "_begin", "_end")), strict=True
            ):
                whole = "".join([p["_text"][:chunk] for p in parts[:-1]] + [parts[-1]["_text"]])
                texts.append(whole[begin or 0 : None if end is None else chunk + end])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_segment"), pa.array(texts, pa.string())],
                names=["_row", "_segment", "_text"],
            )

    pieces = _add_ids(
        segments.mapInArrow(join, "_row long, _segment int, _text string"), "_text", ["_ids"], ranks, pattern
    )
    lists = pieces.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_segment", "_ids"))).alias("_all"))

    @frugal
    def concat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            ids = [b"".join(p["_ids"] for p in x) for x in batch.column("_all").to_pylist()]
            more = [binaries([c.decode(x) for x in ids])] if len(outs) > 1 else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), binaries(ids), *more], names=["_row", "_ids", "_bytes"][: 2 + len(more)]
            )

    schema = "_row long, _ids binary, _bytes binary" if len(outs) > 1 else "_row long, _ids binary"
    whole = lists.mapInArrow(concat, schema).join(rest, "_row")
    names = [f.name for f in rest.schema["_rest"].dataType.fields if f.name != "_"]
    return whole.select(*(F.col("_rest")[n].alias(n) for n in names),
        *(F.col(c).alias(out) for c, out in zip(("_ids", "_bytes"), outs, strict=False)),
    )


def encode(
    df: DataFrame,
    text: str = "text",
    out: str = "token_ids",
    decoded: str | None = None,
    carry: list[str] | None = None,
    ranks: str = RANKS,
    pattern: str = PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The carried columns with the ids of each text: four bytes each, little-endian, unsigned.

    Null is encoded like the empty text, to no ids. ``carry`` names the columns to return (default: all; a
    column named like ``out`` is replaced). ``decoded`` adds a column of the bytes that the ids decode to, in the same pass. Repeated rows stay repeated; an empty table gives an empty result.
    """
    if overlap <= LOOK or chunk <= overlap:
        raise ValueError("chunk > overlap > LOOK")
    ship(df.sparkSession)
    outs = [out] if decoded is None else [out, decoded]
    df = without(df, outs)
    carry = [c for c in (df.columns if carry is None else carry) if c in df.columns]
    held = df.select(*carry, F.col(text).alias("_bpe_text"))
    is_long = F.coalesce(F.length("_bpe_text") > chunk, F.lit(False))
    short = _add_ids(held.where(~is_long), "_bpe_text", outs, ranks, pattern)
    long = _encode_long(held.where(is_long), "_bpe_text", outs, chunk, overlap, ranks, pattern)
    return short.select(*carry, *outs).union(long.select(*carry, *outs))


def decode(
    df: DataFrame,
    ids: str = "token_ids",
    out: str = "decoded",
    carry: list[str] | None = None,
    ranks: str = RANKS,
    pattern: str = PATTERN,
) -> DataFrame:
    """The carried columns with the bytes that the ids stand for; null ids give no bytes.

    An id that the vocabulary does not have is an error.
    """
    ship(df.sparkSession)
    df = without(df, [out])
    carry = [c for c in (df.columns if carry is None else carry) if c in df.columns]

    @frugal
    def bytes_for(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            texts = [c.decode(x or b"") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in carry), binaries(texts)], names=[*carry, out]
            )

    fields = [df.schema[c] for c in carry]
    return df.select(*dict.fromkeys([*carry, ids])).mapInArrow(
        bytes_for, T.StructType([*fields, T.StructField(out, T.BinaryType())])
    )


def token_digests(df: DataFrame, carry: list[str]) -> DataFrame:
    """Number of tokens, and digests of the ids and of what they decode to."""
    both = encode(df, decoded="decoded", carry=carry)
    return both.select(
        *carry,
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return token_digests(read(spark, sf, "documents"), ["doc_id"])
