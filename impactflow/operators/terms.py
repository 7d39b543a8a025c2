"""Tokens, term frequencies and TF-IDF, exact by term and hashed by bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH
from .clean import filter_nonblank

MIN_TOKEN = 2
BUCKETS = 1 << 18
TERM_SALTS = 16


def tokenize(text: Column | str, min_length: int = MIN_TOKEN) -> Column:
    """Lower-case, split on non-word characters, keep tokens of ``min_length`` up."""
    parts = F.split(F.lower(text), r"\W+")
    return F.filter(parts, lambda t: F.length(t) >= min_length)


def remove_stopwords(tokens: Column | str, words: Sequence[str] = ENGLISH) -> Column:
    """Drop stop words, whatever their case."""
    lowered = [w.lower() for w in words]
    return F.filter(tokens, lambda t: ~F.lower(t).isin(lowered))


def term_frequency(
    df: DataFrame, id: str, text: str, stop_words: Sequence[str] = ENGLISH
) -> DataFrame:
    """(id, term, tf): one row per document and term.

    The tokens of a document sit in one task, so the map-side combine already
    yields one row per document and term before the shuffle. Short tokens and stop words are dropped
    after the explode, in generated code.
    """
    words = F.split(F.lower(text), r"\W+")
    term = F.col("term")
    keep = F.length(term) >= MIN_TOKEN
    if stop_words:
        keep = keep & ~term.isin([w.lower() for w in stop_words])
    terms = filter_nonblank(df.select(id, text), text).select(id, F.explode(words).alias("term"))
    return terms.where(keep).groupBy(id, "term").agg(F.count("*").alias("tf"))


def _salt(id: str, salts: int) -> Column:
    # Never NULL, and said so: a condition on it would keep its exchange from being reused.
    return F.coalesce(F.pmod(F.xxhash64(id), F.lit(salts)).cast("int"), F.lit(0))


def _counts_by_term(df: DataFrame, id: str, text: str, stop_words: Sequence[str], salts: int) -> DataFrame:
    """(id, term, _m, tf) with the marker '' (tf 0), dealt by term and the document's salt ``_m``.

    A text that starts with a blank always yields a leading '', the marker. The words of a row are sorted and counted as runs where they are, so only one row per text and term is moved, and once.
    """
    words = F.sort_array(F.split(F.concat(F.lit(" "), F.lower(text)), r"\W+"))
    # Unpacked from arrays, so that the lambdas below do not sort again for every word.
    rows = filter_nonblank(df.select(id, text), text).select(id, F.explode(F.array(words)).alias("_w"))
    ends = F.filter(
        F.sequence(F.lit(0), F.size("_w") - 1), lambda i: ~F.get("_w", i).eqNullSafe(F.get("_w", i + 1))
    )
    rows = rows.select(id, "_w", F.explode(F.array(ends)).alias("_e"))
    runs = F.transform(
        "_e",
        lambda e, i: F.struct(
            F.coalesce(F.get("_w", e), F.lit("")).alias("term"),
            (e - F.coalesce(F.get("_e", i - 1), F.lit(-1))).alias("_n"),
        ),
    )
    term = F.col("term")
    keep = F.length(term) >= MIN_TOKEN
    if stop_words:
        keep = keep & ~term.isin([w.lower() for w in stop_words])
    dealt = (
        rows.select(id, F.inline(runs))
        .where(keep | (term == ""))
        .withColumn("_m", _salt(id, salts))
        .repartition("term", "_m")
    )
    return dealt.groupBy(id, "term", "_m").agg(F.sum(F.when(term != "", F.col("_n")).otherwise(0)).alias("tf"))


def document_frequency(tf: DataFrame, id: str | None = None, salts: int = 1) -> DataFrame:
    """(term, df): in how many documents a term occurs. With ``id`` also ``_salts``, the bits of the documents' salts."""
    spread = [] if id is None else [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _salt(id, salts))).alias("_salts")]
    return tf.groupBy("term").agg(F.count_if(F.col("tf") >= 0).alias("df"), *spread)


def tfidf(
    df: DataFrame,
    id: str,
    text: str,
    stop_words: Sequence[str] = ENGLISH,
    salts: int = TERM_SALTS,
) -> DataFrame:
    """(id, term, tf, tfidf) with tfidf = tf * ln((N + 1) / (df + 1)).

    A marker term in every document makes N the highest document frequency.
    The term counts, the document frequencies and N then all come from the same
    shuffle (ReusedExchange): the texts are read and tokenised once. It deals the counts by term, as the
    join with the frequencies needs them, so they are moved once. A very
    common term is a hot key, so a term is dealt over up to ``salts`` tasks (62 at most) by its documents. The aggregate that counts
    a term's documents also notes their salts, and only those copies of the term are made: a term of one document has
    one, as most of a vocabulary. ``id`` is unique.
    """
    if not 1 <= salts <= 62:
        raise ValueError("there are 1 to 62 salts")
    tf = _counts_by_term(df, id, text, stop_words, salts)
    freq = document_frequency(tf, id, salts)
    # With the salts, so that N comes from the frequencies' shuffle too.
    n = freq.agg(F.max(F.struct("df", "_salts"))["df"]).scalar()
    dealt = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.getbit("_salts", i) == 1)
    copies = freq.select("term", "df", F.explode(dealt).alias("_m"))
    joined = tf.where("tf > 0").join(copies, ["term", "_m"])
    idf = F.log((n + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return joined.select(id, "term", "tf", (F.col("tf") * idf).alias("tfidf"))


def top_terms(weights: DataFrame, id: str, n: int) -> DataFrame:
    """The ``n`` heaviest terms per document, ties by term."""
    w = Window.partitionBy(id).orderBy(F.desc("tfidf"), F.asc("term"))
    return weights.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _hashing_stages(text: str, buckets: int) -> list:
    return [
        RegexTokenizer(
            inputCol=text, outputCol="tokens", pattern=r"\W+", gaps=True,
            minTokenLength=MIN_TOKEN, toLowercase=True,
        ),
        StopWordsRemover(inputCol="tokens", outputCol="terms"),
        HashingTF(inputCol="terms", outputCol="tf_vector", numFeatures=buckets),
    ]


def hashed_term_frequency(
    df: DataFrame, id: str, text: str, buckets: int = BUCKETS
) -> DataFrame:
    """(id, tf_vector): sparse vector of hashed term counts."""
    out = filter_nonblank(df.select(id, text), text)
    for stage in _hashing_stages(text, buckets):
        out = stage.transform(out)
    return out.select(id, "tf_vector")


def fit_hashed_tfidf(df: DataFrame, text: str, buckets: int = BUCKETS) -> PipelineModel:
    """Fit the hashed TF-IDF model; its state is one number per bucket."""
    idf = IDF(inputCol="tf_vector", outputCol="tfidf_vector")
    return Pipeline(stages=[*_hashing_stages(text, buckets), idf]).fit(
        filter_nonblank(df, text)
    )


def vector_parts(vector: str) -> Column:
    """A vector as struct: type (0: sparse), size, indices, values."""
    layout = f"`{vector}` struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    return F.from_json(F.to_json(F.struct(vector)), layout)[vector]


def hashed_tfidf(model: PipelineModel, df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, tfidf_vector) by a fitted model."""
    return model.transform(filter_nonblank(df.select(id, text), text)).select(
        id, "tfidf_vector"
    )
