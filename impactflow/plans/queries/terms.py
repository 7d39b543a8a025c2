"""Tokens and term weights of whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.columns import fold_text
from ...functions.stopwords import ENGLISH
from ...operators import terms as t
from .registry import documents, query

STOP_LIST_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
TOKENS_SQL = r"""tokens AS (
  SELECT doc_id, term, pos FROM (
    SELECT doc_id, unnest(parts) AS term, unnest(range(len(parts))) AS pos FROM (
      SELECT doc_id, string_split_regex(lower(text), '\W+') AS parts
      FROM documents WHERE length(trim(text)) > 0))
  WHERE length(term) >= 2)"""
WORDS_SQL = f"""{TOKENS_SQL},
words AS (SELECT * FROM tokens WHERE term NOT IN ({STOP_LIST_SQL}))"""
TF_SQL = f"""{WORDS_SQL},
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2)"""
TFIDF_SQL = f"""{TF_SQL},
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
weights AS (
  SELECT doc_id, term, tf, tf * ln((n + 1.0) / (df + 1.0)) AS tfidf FROM tf JOIN df USING (term)
  CROSS JOIN (SELECT count(*) AS n FROM documents WHERE length(trim(text)) > 0))"""


def _digested(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("tokens"),
        F.md5(F.concat_ws(" ", "tokens")).alias("digest"),
    )


TOKEN_LIST_SQL = r"""list_filter(string_split_regex(lower(text), '\W+'),
                       lambda x: length(x) >= 2)"""
DIGEST_SQL = "len(t) AS tokens, md5(array_to_string(t, ' ')) AS digest"


@query(
    "tokenize",
    f"SELECT doc_id, {DIGEST_SQL} FROM (SELECT doc_id, {TOKEN_LIST_SQL} AS t FROM documents)",
)
def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    return _digested(documents(spark, sf).select("doc_id", t.tokenize("text").alias("tokens")))


@query(
    "remove_stopwords",
    f"""SELECT doc_id, {DIGEST_SQL} FROM (
      SELECT doc_id, list_filter({TOKEN_LIST_SQL}, lambda x: x NOT IN ({STOP_LIST_SQL})) AS t
      FROM documents)""",
)
def remove_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    tokens = t.remove_stopwords(t.tokenize("text"))
    return _digested(documents(spark, sf).select("doc_id", tokens.alias("tokens")))


@query("term_frequency", f"WITH {TF_SQL} SELECT doc_id, term, tf FROM tf")
def term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return t.term_frequency(documents(spark, sf), "doc_id", "text")


@query(
    "term_frequency_hashed",
    f"""SELECT doc_id, CAST(len(list_filter({TOKEN_LIST_SQL}, lambda x: x NOT IN ({STOP_LIST_SQL})))
      AS DOUBLE) AS terms FROM documents WHERE length(trim(text)) > 0""",
)
def term_frequency_hashed(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed vectors, shown by the sum of their counts, which collisions keep."""
    vectors = t.hashed_term_frequency(documents(spark, sf), "doc_id", "text")
    total = F.aggregate(t.vector_parts("tf_vector")["values"], F.lit(0.0), lambda a, x: a + x)
    return vectors.select("doc_id", total.alias("terms"))


@query(
    "tfidf", f"WITH {TFIDF_SQL} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM weights"
)
def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    weights = t.tfidf(documents(spark, sf), "doc_id", "text")
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query(
    "tfidf_hashed",
    f"""SELECT doc_id, {t.BUCKETS} AS size,
      len(list_filter({TOKEN_LIST_SQL}, lambda x: x NOT IN ({STOP_LIST_SQL}))) > 0 AS has_terms,
      true AS sound FROM documents WHERE length(trim(text)) > 0""",
)
def tfidf_hashed(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed weights, shown by what collisions keep: the vector's size, whether it has terms, and that weights are
    neither negative nor fewer than their places."""
    texts = documents(spark, sf)
    model = t.fit_hashed_tfidf(texts, "text")
    vectors = t.hashed_tfidf(model, texts, "doc_id", "text")
    parts = vectors.select("doc_id", t.vector_parts("tfidf_vector").alias("v"))
    sound = F.forall("v.values", lambda x: x >= 0) & (F.size("v.values") == F.size("v.indices"))
    return parts.select(
        "doc_id", F.col("v.size").alias("size"), (F.size("v.indices") > 0).alias("has_terms"), sound.alias("sound")
    )


@query(
    "top_terms",
    f"""WITH {TFIDF_SQL} SELECT doc_id, term, tfidf, rank FROM (
      SELECT doc_id, term, tfidf,
             row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank
      FROM (SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM weights)) WHERE rank <= 5""",
)
def top_terms(spark: SparkSession, sf: str) -> DataFrame:
    weights = t.tfidf(documents(spark, sf), "doc_id", "text").withColumn(
        "tfidf", F.round("tfidf", 6)
    )
    return t.top_terms(weights, "doc_id", 5).select(
        "doc_id", "term", "tfidf", F.col("rank").cast("bigint").alias("rank")
    )


def _fold_sql(text: str) -> str:
    """Folding by DuckDB's own accents, and the letters that have no decomposition."""
    out = f"translate(strip_accents(lower({text})), 'ðđħıłŉøŧ', 'ddhilnot')"
    for letter, ascii_letters in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"), ("ĳ", "ij")):
        out = f"replace({out}, '{letter}', '{ascii_letters}')"
    return out


# The word pattern without Java's possessive quantifiers and class arithmetic;
# the texts have no Han or Hiragana signs.
WORD_SQL = r"(?:[\p{L}\p{M}]+(?:[.:''’·][\p{L}\p{M}]+)*|\p{N}+(?:[.,;''’]\p{N}+)*|_)+"


@query(
    "fold_text",
    f"""SELECT doc_id, len(words) AS tokens, md5(array_to_string(words, ' ')) AS digest FROM (
      SELECT doc_id, regexp_extract_all({_fold_sql("text")}, '{WORD_SQL}') AS words
      FROM documents)""",
)
def fold_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _digested(documents(spark, sf).select("doc_id", fold_text("text").alias("tokens")))
