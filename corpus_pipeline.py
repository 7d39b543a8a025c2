"""A corpus pipeline from the operators in ``impactflow.llm``.

Language ID drops texts that are in no language it knows, exact dedup keeps one row of equal texts,
the Jaccard join keeps one document of each group of near duplicates, mixing repeats or drops documents to meet the
sources' targets, and the rest is tokenised. Each stage reads what the one before has written.

The two kinds of dedup give their decisions by the rows' names only; the rows that go are then taken out of the scan, so the
texts of those that stay are neither written for that nor moved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impactflow.llm.bpe import token_digests
from impactflow.llm.common import materialise
from impactflow.llm.exact_dedup import exact_dedup
from impactflow.llm.jaccard_join import jaccard_join
from impactflow.llm.lang_id import fit, held_out, identify
from impactflow.llm.listed import without_listed
from impactflow.llm.mixing import mix, word_count


#: The columns that the operators read; all others are carried under names that nothing else has.
READ = ("doc_id", "text", "lang", "source")
#: What tells a row from those with another identifier or another text.
NAME = ["doc_id", "_text_hash"]


def _shielded(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The documents with their other columns renamed, and what gives the documents' columns back."""
    names = [c if c in READ else f"_document_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda df: df.select(*names).toDF(*docs.columns)


def _named(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The same with the columns of NAME, as identifiers may be repeated or null."""
    held, restored = _shielded(docs)
    return held.withColumn("_text_hash", F.xxhash64("text")), restored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; null, empty and letterless texts go, and those the model rejects.

    The model learns from labelled rows outside the held-out fold.
    """
    held, restored = _shielded(docs)
    return restored(identify(held, fit(held, ~held_out())).where("NOT rejected"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the smallest doc_id."""
    held, restored = _named(docs)
    # Of a group the row that stays is not listed, unless there are others of its name: rows repeated with their identifier.
    groups = exact_dedup(held, carry=NAME).where("group_size > 1")
    rows = groups.groupBy(*NAME).agg(F.bool_or("kept").alias("one_stays"), F.count("*").alias("n"))
    listed = materialise(rows.where("n > 1 OR NOT one_stays").drop("n"), "pipeline-exact-copies")
    return restored(without_listed(held, listed, NAME))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id; rows without an id stay."""
    held, restored = _named(docs)
    # Rows of one name have one text, so they are in one component: all of them go, or none.
    near = jaccard_join(held, carry=NAME).where("component_id <> doc_id").select(*NAME).distinct()
    listed = materialise(near.withColumn("one_stays", F.lit(False)), "pipeline-near-copies")
    return restored(without_listed(held, listed, NAME))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most three times, or not at all."""
    held, restored = _named(docs)
    mixed = mix(held, word_count(), NAME)
    return restored(mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, number of tokens and digests of the ids and of what they decode to, for each row of the mix."""
    return token_digests(docs, ["doc_id", "source"])


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", tokenise),
]

#: The model's decisions and the selection of the mix cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
