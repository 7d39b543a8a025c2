"""Rows of a large table taken out or picked by a list, while all others stay in the scan.

A join with a list too large to be broadcast moves every row, whole texts included, to drop or find a few. Here the list is
turned into a filter of bits, which is small and is broadcast, and only the rows that the filter lets pass are moved to meet the list. The filter
lets pass every row that is listed and a few others, about which the list itself decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filter's words of 64 bits. With longer lists it lets more rows pass, which are then moved; the result is the same.
WORDS = 1 << 18
#: Listed rows that share a word, where there are words enough, and bits that each of them sets.
SHARE, BITS = 4, 3


def _place(by: list[str], words: int) -> tuple[Column, Column]:
    """A row's word in the filter, and the bits it sets there; both from one hash, the word from its low bits."""
    h = F.xxhash64(*by)
    bits = (F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 40 + 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS))
    return h.bitwiseAND(F.lit(words - 1)), reduce(Column.bitwiseOR, bits)


def _by_filter(df: DataFrame, listed: DataFrame, by: list[str], size: int) -> tuple[DataFrame, DataFrame]:
    """The rows that the filter of ``listed`` lets pass, and the others."""
    words = 1
    while words * SHARE < size and words < WORDS:
        words *= 2
    word, mask = _place(by, words)
    bits = listed.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    marked = df.withColumns({"_word": word, "_mask": mask}).join(F.broadcast(bits), "_word", "left")
    passes = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return marked.where(passes).select(*df.columns), marked.where(~passes).select(*df.columns)


def _named(passed: DataFrame, listed: DataFrame, by: list[str], how: str) -> DataFrame:
    other = listed.select(*by).toDF(*(f"_listed_{i}" for i in range(len(by))))
    pairs = zip(by, other.columns, strict=True)
    return passed.join(other, reduce(Column.__and__, (passed[c].eqNullSafe(other[n]) for c, n in pairs)), how)


def only_listed(df: DataFrame, listed: DataFrame, by: list[str]) -> DataFrame:
    """The rows of ``df`` that ``listed`` names by the columns ``by``, of which null is a value like any other. Both are read more than once."""
    passed, _ = _by_filter(df, listed, by, listed.count())
    return _named(passed, listed, by, "left_semi")


def without_listed(df: DataFrame, listed: DataFrame, by: list[str]) -> DataFrame:
    """``df`` without the rows that ``listed`` names by the columns ``by``, of which null is a value like any other.

    ``listed`` has these columns, of the same types, and a boolean ``one_stays``, once for each of their values: where it is true, one of the rows of
    that name is left. It is read several times, as ``df`` is, so both should be tables.
    """
    size, ones = listed.agg(F.count("*"), F.count_if("one_stays")).first()
    passed, others = _by_filter(df, listed, by, size)
    out = others.union(_named(passed, listed, by, "left_anti"))
    if ones:
        any_of = Window.partitionBy(*by).orderBy(F.lit(0))
        again = _named(passed, listed.where("one_stays"), by, "left_semi").withColumn("_k", F.row_number().over(any_of))
        out = out.union(again.where("_k = 1").select(*df.columns))
    return out
