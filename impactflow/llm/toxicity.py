"""Toxicity by compression distance: two zstandard dictionaries, and what a window saves by the toxic one.

Both dictionaries have the same ordinary text in them, its most frequent words last, where references are cheapest; the toxic one
goes on with toxic text. So a window without toxic text compresses to the same length with either, and the
difference of the lengths is what the toxic text saves. Which strings are toxic text is learned from labelled documents as cover
dictionaries are: strings of GRAM bytes are counted, here once for each distinct pair of neighbouring words, so that copies of a passage count once,
and those are kept whose counts in toxic and ordinary documents differ by more than chance. Runs of kept strings are the segments.

A document's words are cut into overlapping windows. The gain of a window is its ordinary length less its toxic one; a window counts as
toxic from a gain that few windows of ordinary documents reach. A logistic function of mean gain, share of toxic windows
and greatest gain gives the score. Both thresholds are calibrated on documents that the dictionaries used for it have not seen: half of
the sample is scored with the dictionaries of the other half.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, read, ship, slices, without
from .lang_id import held_out

#: About so many labelled documents of each class are drawn to fit the model, none of them over SAMPLE_BYTES.
SAMPLE_PER_CLASS, SAMPLE_BYTES = 1000, 1 << 20
#: Words in a window, and from one window to the next; longer words are cut.
WORDS, STRIDE, LONGEST_WORD = 12, 6, 64
#: Bytes of a counted string; how often it must be seen in toxic text, its least test value (chi-squared, one degree) and ratio of frequencies.
GRAM, SEEN, DIFFERENT, RATIO = 6, 4, 15.0, 4.0
ORDINARY_BYTES, TOXIC_BYTES, LEVEL = 32 << 10, 4 << 10, 12
#: Of the windows of ordinary documents, this share may count as toxic.
FALSE_WINDOWS = 0.01
SEED = 131
SLICE_BYTES = 1 << 20
OUTPUT = ("score", "predicted")

# Lower-case ASCII letters and bytes of other letters; all else separates words.
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def normalised(text: bytes) -> bytes:
    """The words of a text in lower case, with one space around each."""
    words = text.translate(_FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(all texts end to end, (start, length) of each window, number of the text it is in); a text without words has none."""
    starts, lengths, owner, at = [], [], [], 0
    for i, text in enumerate(texts):
        if text:
            cuts = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
            if (np.diff(cuts) > LONGEST_WORD + 1).any():
                more = [np.arange(a + 1 + LONGEST_WORD, b, LONGEST_WORD) for a, b in zip(cuts, cuts[1:]) if b - a > LONGEST_WORD + 1]
                cuts = np.sort(np.concatenate([cuts, *more]))
            first = np.arange(0, max(1, len(cuts) - 1 - WORDS + STRIDE), STRIDE)
            last = np.minimum(first + WORDS, len(cuts) - 1)
            starts.append(at + cuts[first])
            lengths.append(cuts[last] + 1 - cuts[first])
            owner.append(np.full(len(first), i))
            at += len(text)
    if not starts:
        return b"", np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    return b"".join(texts), np.column_stack([np.concatenate(starts), np.concatenate(lengths)]), np.concatenate(owner)


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def gains(self, data: bytes, spans: np.ndarray) -> np.ndarray:
        """Compressed length of each window with the ordinary dictionary, less that with the toxic one."""
        if not len(spans):
            return np.zeros(0, np.int64)
        options = zstd.ZstdCompressionParameters.from_level(LEVEL, min_match=3, write_content_size=0, write_dict_id=0)
        found = []
        for content in (self.ordinary, self.ordinary + self.toxic):
            if not content:
                found.append(spans[:, 1])
                continue
            known = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            press = zstd.ZstdCompressor(compression_params=options, dict_data=known)
            out = press.multi_compress_to_buffer(zstd.BufferWithSegments(data, spans.astype(np.uint64).tobytes()))
            found.append(np.fromiter((len(x) for x in out), np.int64, len(spans)))
        return found[0] - found[1]


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    bar: int  # a window counts as toxic from this gain
    weights: np.ndarray  # of the three features, and the constant

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(features(self.dictionaries, self.bar, texts) @ self.weights)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _of_gains(gains: np.ndarray, owner: np.ndarray, n: int, bar: int) -> np.ndarray:
    count = np.maximum(np.bincount(owner, minlength=n), 1)
    mean = np.bincount(owner, np.maximum(gains, 0), n) / count
    share = np.bincount(owner, gains >= bar, n) / count
    most = np.zeros(n)
    np.maximum.at(most, owner, gains)
    return np.column_stack([np.sqrt(mean), np.sqrt(share), most / 8, np.ones(n)])


def features(known: Dictionaries, bar: int, texts: list[bytes]) -> np.ndarray:
    """Roots of mean gain and of the share of toxic windows, greatest gain, one; zeros for a text without words."""
    data, spans, owner = windows(texts)
    return _of_gains(known.gains(data, spans), owner, len(texts), bar)


def _contexts(texts: Iterable[bytes]) -> Counter[bytes]:
    """Each word, with its spaces, and the number of distinct pairs of neighbours it has."""
    seen: set[tuple[bytes, bytes, bytes]] = set()
    for text in texts:
        words = [b"", *text.split(), b""]
        seen.update(zip(words, words[1:], words[2:]))
    return Counter(b" " + w + b" " for _, w, _ in seen)


def _grams(word: bytes) -> set[bytes]:
    return {word[i : i + GRAM] for i in range(max(1, len(word) - GRAM + 1))}


def learn(toxic: list[bytes], ordinary: list[bytes]) -> Dictionaries:
    """Dictionaries from normalised texts."""
    words = [_contexts(ordinary), _contexts(toxic)]
    counts: list[Counter[bytes]] = [Counter(), Counter()]
    for w, n in words[1].items():
        for g in _grams(w):
            counts[1][g] += n
    often = {g for g, n in counts[1].items() if n >= SEEN}
    for w, n in words[0].items():
        for g in _grams(w) & often:
            counts[0][g] += n
    total = [max(1, sum(w.values())) for w in words]

    def telling(g: bytes) -> bool:
        a, b = counts[1][g], counts[0][g]
        expected = (a + b) * total[1] / sum(total)
        if a <= expected or a / total[1] < RATIO * (b + 0.5) / total[0]:
            return False
        return 2 * (a * np.log(a / expected) + (b * np.log(b / (a + b - expected)) if b else 0)) > DIFFERENT

    kept = {g for g in often if telling(g)}
    segments: Counter[bytes] = Counter()
    for w, n in words[1].items():
        inside = np.zeros(len(w) + 2, np.int8)
        for i in range(max(1, len(w) - GRAM + 1)):
            if w[i : i + GRAM] in kept:
                inside[1 + i : 1 + min(i + GRAM, len(w))] = 1
        turns = np.flatnonzero(np.diff(inside))
        for a, b in zip(turns[::2], turns[1::2]):
            segments[w[a:b]] += n
    plain = {w: n for w, n in words[0].items() if not _grams(w) & kept}

    def content(found: dict[bytes, int], most: int) -> bytes:
        joined = b"".join(s for s, _ in sorted(found.items(), key=lambda x: (x[1], x[0])))
        return joined[-most:]

    return Dictionaries(content(plain, ORDINARY_BYTES), content({s: n for s, n in segments.items() if n >= SEEN}, TOXIC_BYTES))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small penalty, by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([0.1] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(texts: list[bytes], labels: np.ndarray, share: float) -> Model:
    """Fit on normalised texts labelled 0 or 1, both there; ``share`` is that of label 1 among all labelled documents."""
    half = np.zeros(len(texts), int)
    for y in (0, 1):
        at = np.flatnonzero(labels == y)
        half[at] = np.arange(len(at)) % 2

    def learned(mask: np.ndarray) -> Dictionaries:
        return learn([texts[i] for i in np.flatnonzero(mask & (labels == 1))], [texts[i] for i in np.flatnonzero(mask & (labels == 0))])

    gains, owner = [], []
    for h in (0, 1):
        unseen = np.flatnonzero(half == h)
        data, spans, own = windows([texts[i] for i in unseen])
        gains.append(learned(half != h).gains(data, spans))
        owner.append(unseen[own])
    all_gains, all_owner = np.concatenate(gains), np.concatenate(owner)
    ordinary = all_gains[labels[all_owner] == 0]
    bar = max(1, int(np.quantile(ordinary, 1 - FALSE_WINDOWS)) + 1) if len(ordinary) else 1
    x = _of_gains(all_gains, all_owner, len(texts), bar)
    # The classes weigh what they do among all labelled documents, so that the score is a probability.
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    return Model(learned(np.ones(len(texts), bool)), bar, _logistic(x, labels, weight))


def fit(
    df: DataFrame, labels: DataFrame, learnable: Column, text: str = "text", label: str = "toxic", key: str = "doc_id",
    per_class: int = SAMPLE_PER_CLASS,
) -> Model | float:
    """Learn from a sample of the labelled rows of ``labels`` for which ``learnable`` holds.

    Labels other than 0 and 1 are left aside; an identifier with several labels counts as 1 if any is 1, and one with several rows gives its least text. About
    ``per_class`` identifiers of each class are drawn by a seeded hash; only they are joined to the texts, and only their texts reach the driver.
    If a class is missing, the share of label 1 is returned, 0 without any labels.
    """
    ship(df.sparkSession)
    known = (
        labels.where(learnable & F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "key"), 11) / F.lit(float(1 << 53))
    part = F.when(F.col("label") == 1, F.lit(min(1.0, per_class / max(1, counts.get(1, 0))))).otherwise(F.lit(min(1.0, per_class / max(1, counts.get(0, 0)))))
    drawn = known.where(unit < part)  # about 2 * per_class rows
    rows = (
        df.where(F.col(text).isNotNull() & (F.octet_length(text) <= SAMPLE_BYTES))
        .select(F.col(key).alias("key"), F.col(text).alias("text"))
        .join(F.broadcast(drawn), "key")
        .groupBy("key")
        .agg(F.min("text").alias("text"), F.max("label").alias("label"))
        .toArrow()
        .sort_by("key")
    )
    found = rows.column("label").to_numpy()
    if len(set(found.tolist())) < 2:
        return share
    return train([normalised(t.encode()) for t in rows.column("text").to_pylist()], found, share)


def judge(df: DataFrame, model: Model | float, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if score >= 0.5, else 0).

    Every word of a text is in a window, however long the text is. A text that is null, empty or without letters has no windows and gets the
    score of one without gains; with a number for the model, every text gets that number. Equal texts get equal scores. Nothing but the text is looked at.
    ``carry`` names the columns to return (default: all; a column named like an added one is replaced). Rows are neither
    moved nor dropped; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    df = without(df, [*OUTPUT, "_text"])
    carry = [c for c in (df.columns if carry is None else carry) if c in df.columns]
    held = df.select(*carry, F.col(text).alias("_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE_BYTES):
            if isinstance(model, Model):
                data, ends = bytes_of(batch.column("_text"))
                whole = data.tobytes()
                found = model.scores([normalised(whole[a:b]) for a, b in zip(ends, ends[1:])])
            else:
                found = np.full(batch.num_rows, float(model))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=[*carry, *OUTPUT]
            )

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return held.mapInArrow(score, T.StructType([*(held.schema[c] for c in carry), *added]))


def op13_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf, "labels").select("doc_id", "toxic"), ~held_out())
    return judge(docs, model, carry=["doc_id"]).select("doc_id", held_out().alias("held_out"), *OUTPUT)
