"""Language identification by averaged hashed subword embeddings.

A text's features are the hashed 3- and 4-byte subwords inside its words, word ends included. Their embeddings
are averaged, and a linear softmax gives the languages. Embeddings and softmax are trained by
stochastic gradient descent in numpy, on a bounded sample of labelled rows that the caller sets. A temperature
calibrates the probabilities on a part of the sample that was not trained on, and texts below a probability
are rejected; that threshold keeps nearly all texts of the same part. As probabilities only tell languages from each
other, texts are also rejected whose subwords are rare in all of them: how familiar a text is, is the mean logarithm of
how much more frequent its subwords are in the learned texts than if all were alike.

The layers are linear up to the softmax, so for prediction they are multiplied into one table: one number for each
subword bucket and language, and a text's logits are the mean of its subwords' rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, frugal, lower_ascii, read, ship, slices, without

BUCKETS, DIM = 1 << 14, 16
SIZES = (3, 4)
#: At most about so many labelled rows of each language are drawn to fit the model.
SAMPLE_PER_LANGUAGE = 500
EPOCHS, BATCH, RATE, DECAY = 8, 16, 0.5, 1e-6
#: Of the calibration texts whose language is found, this share may fall below each threshold.
REJECTED = 0.001
#: Thresholds are so much of what those texts reach; familiarity counts from that of even subwords.
MARGIN = 0.9
SEED = 97
UNKNOWN = "und"
#: Bytes of text that are worked on at a time; a task's arrays take about a hundred times as many, and a worker keeps what it has once taken.
BATCH_BYTES = 512 << 10
OUTPUT = ("lang_pred", "score", "rejected")

# ASCII letters in lower case, bytes of other letters as they are, all else a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def subwords(data: np.ndarray, ends: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of the texts, and the number of the text it is in.

    A subword is 3 or 4 bytes that hold no space but at their ends; it never crosses texts.
    """
    n = len(ends) - 1
    # A space before each text and one behind the last keeps texts apart.
    lengths = np.diff(ends)
    starts = ends[:-1] + np.arange(n) + 1
    flat = np.full(len(data) + n + 1, 32, np.uint8)
    place = np.repeat(starts - ends[:-1], lengths) + np.arange(len(data))
    flat[place] = _FOLD[lower_ascii(data)]
    text = np.repeat(np.arange(n), lengths + 1)
    wide = flat.astype(np.uint32)
    space = flat == 32
    found, where = [], []
    for size in SIZES:
        m = len(flat) - size + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint32)
        inner = np.ones(m, bool)
        for j in range(size):
            code += wide[j : j + m] * _MIX[j]
            code ^= code >> np.uint32(15)
            if 0 < j < size - 1:
                inner &= ~space[j : j + m]
        at = np.flatnonzero(inner)
        code = code[at] * np.uint32(0x2C1B3C6D)
        found.append(((code ^ (code >> np.uint32(13))) & np.uint32(buckets - 1)).astype(np.int32))
        where.append(text[np.minimum(at, len(text) - 1)] if n else at)
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(where)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # buckets x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float
    lift: np.ndarray  # of each bucket: the logarithm of its frequency in the learned texts, over an even one
    floor: float  # texts that are less familiar are rejected

    def logits(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean row of each text's subwords, plus the bias; and how familiar the text is, their mean lift."""
        n = len(ends) - 1
        ids, text = subwords(data, ends, len(self.table))
        sums = np.stack(
            [np.bincount(text, self.table[ids, j], n) for j in range(len(self.languages))], axis=1
        )
        counts = np.maximum(np.bincount(text, minlength=n), 1)
        return sums / counts[:, None] + self.bias, np.bincount(text, self.lift[ids], n) / counts

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: tuple[str, ...], seed: int = SEED) -> Model:
    """Fit on (buckets, counts) of each text. Every tenth text is kept for the calibration."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    order = rng.permutation(len(labels))
    held, used = order[::10], order[np.arange(len(order)) % 10 > 0]
    if len(used) == 0:
        used = order
    emb = rng.uniform(-1, 1, (BUCKETS, DIM)) / DIM
    out, bias = np.zeros((DIM, k)), np.zeros(k)
    # Rare languages count as much as frequent ones.
    weight = 1 / np.maximum(np.bincount(labels[used], minlength=k), 1)
    weight = weight / weight[labels[used]].mean()
    step, steps = 0, EPOCHS * -(-len(used) // BATCH)
    for _ in range(EPOCHS):
        rng.shuffle(used)
        for at in range(0, len(used), BATCH):
            rows = used[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            means = np.stack([(c @ emb[b]) / max(c.sum(), 1) for b, c in (features[i] for i in rows)])
            grad = softmax(means @ out + bias)
            grad[np.arange(len(rows)), labels[rows]] -= 1
            grad *= weight[labels[rows]][:, None]
            back = grad @ out.T
            out -= rate * (means.T @ grad + DECAY * out)
            bias -= rate * grad.sum(axis=0) / 10
            for g, i in zip(back, rows, strict=True):
                b, c = features[i]
                emb[b] -= rate * 10 * np.outer(c / max(c.sum(), 1), g)
    table = (emb @ out).astype(np.float64)
    tested = held if len(held) else order
    logits = np.stack([(c @ table[b]) / max(c.sum(), 1) + bias for b, c in (features[i] for i in tested)])
    # Separable texts would ask for ever lower temperatures, which make any text certain.
    temperature = min(
        np.geomspace(1, 20, 60),
        key=lambda t: -np.log(softmax(logits / t)[np.arange(len(tested)), labels[tested]] + 1e-12).mean(),
    )
    found = softmax(logits / temperature)
    good = found.argmax(axis=1) == labels[tested]
    right = found.max(axis=1)[good]
    threshold = float(np.quantile(right, REJECTED)) * MARGIN if len(right) else 0.0
    seen = np.full((k, BUCKETS), 1.0)
    for i in used:
        b, c = features[i]
        seen[labels[i], b] += c
    # Every language counts alike.
    lift = np.log((seen / seen.sum(axis=1, keepdims=True)).mean(axis=0) * BUCKETS)
    familiar = np.array([(c @ lift[b]) / max(c.sum(), 1) for b, c in (features[i] for i in tested[good])])
    even = float(lift.mean())
    floor = even + MARGIN * (float(np.quantile(familiar, REJECTED)) - even) if len(familiar) else -np.inf
    return Model(languages, table, bias, float(temperature), threshold, lift, floor)


def fit(df: DataFrame, labelled: Column, text: str = "text", label: str = "lang", key: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Train on a sample of the rows where ``labelled`` holds and the label is known; None if there are none.

    The sample takes the rows whose seeded hash is below their language's share, about ``per_language`` rows of each.
    Their whole texts become bucket counts on the executors, at most BUCKETS pairs a text; only those reach the driver.
    """
    ship(df.sparkSession)
    known = df.where(labelled & F.col(label).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(label).count().collect()}
    if not counts:
        return None
    languages = tuple(sorted(counts))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), key), 11) / F.lit(float(1 << 53))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(label) == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    sample = known.where(unit < share).select(F.col(key).cast("string").alias("key"), F.col(label).alias("label"), F.col(text).alias("text"))

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            data, ends = bytes_of(batch.column("text"))
            ids, where = subwords(data, ends, BUCKETS)
            pairs, n = np.unique(where.astype(np.int64) * BUCKETS + ids, return_counts=True)
            cut = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * BUCKETS)
            lists = [pa.array((pairs % BUCKETS).astype(np.int32)), pa.array(n.astype(np.int32))]
            offsets = pa.array(cut.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), *(pa.ListArray.from_arrays(offsets, x) for x in lists)],
                names=["key", "label", "buckets", "counts"],
            )

    rows = sample.mapInArrow(count, "key string, label string, buckets array<int>, counts array<int>").toArrow()
    rows = rows.sort_by([("key", "ascending"), ("label", "ascending")]).to_pydict()
    features = [
        (np.asarray(b, np.int32), np.asarray(c, np.float64))
        for b, c in zip(rows["buckets"], rows["counts"], strict=True)
    ]
    if not features:
        return None
    at = {lang: i for i, lang in enumerate(languages)}
    return train(features, np.array([at[x] for x in rows["label"]]), languages)


def identify(df: DataFrame, model: Model | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with ``lang_pred``, ``score`` (probability, 0 to 1) and ``rejected``.

    Every byte of a text counts. A text that is null or has no letter is ``und`` with score 0 and rejected, and so is every
    text if there is no model. Rejected are texts below the model's probability or its familiarity. Nothing but the text is looked at. ``carry`` names the columns to return (default: all; a column
    named like an added one is replaced). Rows are neither moved nor dropped; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    df = without(df, [*OUTPUT, "_lettered", "_text"])
    carry = [c for c in (df.columns if carry is None else carry) if c in df.columns]
    # A carried text is read where it is, not sent twice.
    at = text if text in carry else "_text"
    held = df.select(
        *carry,
        *([] if text in carry else [F.col(text).alias(at)]),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_lettered"),
    )

    @frugal
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, BATCH_BYTES):
            lettered = batch.column("_lettered").to_numpy(zero_copy_only=False)
            if model is None:
                lettered = np.zeros(len(lettered), bool)
                best, score = np.zeros(len(lettered), int), np.zeros(len(lettered))
                names = (UNKNOWN,)
            else:
                logits, familiar = model.logits(*bytes_of(batch.column(at)))
                found = model.probabilities(logits)
                best, names = found.argmax(axis=1), model.languages
                score = np.where(lettered, found.max(axis=1), 0.0)
            rejected = ~lettered if model is None else ~lettered | (score < model.threshold) | (familiar < model.floor)
            langs = [names[b] if x else UNKNOWN for b, x in zip(best.tolist(), lettered.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)],
                names=[*carry, *OUTPUT],
            )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return held.mapInArrow(predict, T.StructType([*(df.schema[c] for c in carry), *added]))


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the identifier as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    model = fit(docs, ~held_out())
    out = identify(docs.select("doc_id", "text"), model, carry=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
