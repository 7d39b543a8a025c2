"""Linking papers, citation records and posts on normalised identifiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.bucketed import KEY
from .joins import spread_nulls

KeyPair = tuple[Column, Column]


def match_by_key(
    left: DataFrame, right: DataFrame, keys: KeyPair, left_id: str, right_id: str
) -> DataFrame:
    """Pairs (left_id, right_id) with equal, non-NULL keys.

    Either side may have any number of rows per key. Both go into the join as they are, so
    Spark splits the partitions of hot keys by the sizes it finds.
    """
    lk, rk = keys
    one = left.select(lk.alias("_k"), F.col(left_id)).where("_k IS NOT NULL")
    many = right.select(rk.alias("_k"), F.col(right_id)).where("_k IS NOT NULL")
    return many.join(one, "_k").select(left_id, right_id)


def match_stored(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """``match_by_key`` over two key tables (``sinks.bucketed``), joined bucket by bucket as they lie.

    Spark would broadcast a small side; the hint keeps both where they are, whatever their sizes.
    """
    key = F.col(KEY)
    return match_by_key(left.hint("merge"), right.hint("merge"), (key, key), left_id, right_id)


def _without(rows: DataFrame, key: Column, taken: DataFrame) -> DataFrame:
    """Rows whose key is not among ``taken`` (_k). Rows without a key stay; they are dealt over many tasks, and
    Spark splits hot keys of the many side of an anti join."""
    keyed = rows.withColumn("_k", key)
    keyed = keyed.withColumn("_s", spread_nulls(F.col("_k"), F.spark_partition_id()))
    return keyed.join(taken.withColumn("_s", F.lit(0)), ["_k", "_s"], "left_anti").drop("_k", "_s")


def unmatched(right: DataFrame, pairs: DataFrame, right_id: str) -> DataFrame:
    """Rows of ``right`` whose id is in no pair."""
    return _without(right, F.col(right_id), pairs.select(F.col(right_id).alias("_k")))


def without_key(rows: DataFrame, key: Column, others: DataFrame, other_key: Column) -> DataFrame:
    """Rows whose key no row of ``others`` has; rows without a key stay.

    Works on the keys alone, so nothing waits for the pairs to be formed.
    """
    return _without(rows, key, others.select(other_key.alias("_k")).where("_k IS NOT NULL"))


def match_cascade(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[KeyPair],
    left_id: str,
    right_id: str,
    *,
    one_to_one: bool = False,
    unique_right: bool = True,
) -> DataFrame:
    """Distinct pairs from an ordered list of keys.

    A right row matched by an earlier key takes no part in later ones; a left
    row may match again unless ``one_to_one`` removes it as well. Where several
    right rows share an id (``unique_right=False``), a match of one of them
    takes out all.
    """
    stages: list[DataFrame] = []
    for i, (lk, rk) in enumerate(keys):
        stages.append(match_by_key(left, right, (lk, rk), left_id, right_id))
        if i + 1 == len(keys):
            break
        left_before = left
        if one_to_one:
            left = without_key(left, lk, right, rk)
        if unique_right:
            right = without_key(right, rk, left_before, lk)
        else:
            right = unmatched(right, stages[-1], right_id)
    return reduce(DataFrame.unionByName, stages).dropDuplicates([left_id, right_id])


def match_url_join(
    posts: DataFrame,
    papers: DataFrame,
    post_key: Column,
    paper_key: Column,
    *,
    post_id: str,
    paper_id: str,
    post_columns: Sequence[str] = (),
) -> DataFrame:
    """Posts joined to the papers they link to: one row per post and paper."""
    many = posts.select(post_key.alias("_k"), post_id, *post_columns)
    one = papers.select(paper_key.alias("_k"), paper_id)
    return (
        many.where("_k IS NOT NULL")
        .join(one.where("_k IS NOT NULL"), "_k")
        .select(post_id, paper_id, *post_columns)
    )


def three_way_match(
    pairs: DataFrame, post_matches: DataFrame, paper_id: str, post_id: str
) -> DataFrame:
    """Citation pairs joined with post matches: one row per paper, citation and post.

    Each side is made distinct before they meet, so the joined rows are, and nothing has to hold or move them
    afterwards; Spark splits the partitions of papers with many posts. Attributes of a post depend on its id.
    """
    posts = post_matches.dropDuplicates([paper_id, post_id])
    return pairs.dropDuplicates().join(posts, paper_id)


def match_coverage(
    left: DataFrame, right: DataFrame, pairs: DataFrame, left_id: str, right_id: str
) -> DataFrame:
    """One row: totals, distinct matched ids and percentages of both sides.

    The pairs are counted by each id; no row is copied. Empty sides give NULL percentages.
    """

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    def pct(part: str, whole: str) -> Column:
        return F.round(F.try_divide(F.col(part) * F.lit(100.0), F.col(whole)), 4)

    def by(id: str) -> DataFrame:
        return pairs.where(F.col(id).isNotNull()).groupBy(id).agg(F.count("*").alias("_n"))

    return (
        by(left_id)
        .agg(F.count("*").alias("left_matched"))
        .withColumn("pairs", rows(pairs))
        .withColumn("right_matched", rows(by(right_id)))
        .withColumn("left_rows", rows(left))
        .withColumn("right_rows", rows(right))
        .withColumn("left_pct", pct("left_matched", "left_rows"))
        .withColumn("right_pct", pct("right_matched", "right_rows"))
    )
