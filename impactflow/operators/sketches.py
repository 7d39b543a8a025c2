"""Quantiles and distinct counts from mergeable sketches, stored by batch and united when read.

A sketch has a fixed size, so it is kept by day and group, and any union of batches costs their sketches, not their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import WEIGHTS

#: Of a quantile sketch: its accuracy parameter, and an error of rank that nearly all of its answers keep.
KLL_K, RANK_ERROR = 400, 0.01
#: Of a distinct sketch: log2 of its registers or entries, and a relative error that nearly all of its answers keep.
LG_K, DISTINCT_ERROR = 16, 0.02


def quantile_sketches(df: DataFrame, by: Sequence[Column | str], value: str) -> DataFrame:
    """``by`` and a ``sketch`` of the values of each group; NULLs do not count."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("sketch"))


def united_edges(sketches: DataFrame, parts: int, by: Sequence[Column | str] = ()) -> DataFrame:
    """``by`` and ``edges``: the values that cut the united groups into equal ``parts``, by any number of sketches."""
    ranks = F.array(*(F.lit(i / parts) for i in range(1, parts)))
    one = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_s"))
    return one.withColumn("edges", F.kll_sketch_get_quantile_double("_s", ranks)).drop("_s")


def exact_edges(df: DataFrame, value: str, parts: int) -> DataFrame:
    """One row: the same ``edges``, exact. Distinct values are counted first, and a task then holds all of them."""
    ranks = [i / parts for i in range(1, parts)]
    counted = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    return counted.agg(F.percentile("v", ranks, F.col("n")).alias("edges"))


def part_of(value: Column, edges: Column) -> Column:
    """Number of the part, from 0, that a value is in: as many edges lie below it."""
    return F.size(F.filter(edges, lambda e: e < value))


def rank_check(df: DataFrame, value: str, edges: DataFrame) -> DataFrame:
    """(part, edge, rank, wanted, within): the true rank of each edge, and whether it keeps RANK_ERROR.

    An edge that many rows share has all ranks from those below it to those up to it. One pass, no sort.
    """
    cuts = edges.select(F.posexplode("edges").alias("part", "edge"), (F.size("edges") + 1).alias("parts"))
    values = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    # One row of edges, so the array travels with the rows as a scalar.
    e = F.col("_edges")
    places = values.withColumn("_edges", edges.select("edges").scalar()).select(
        F.size(F.filter(e, lambda x: x < F.col("v"))).alias("below"), F.size(F.filter(e, lambda x: x <= F.col("v"))).alias("upto")
    )
    sums = places.groupBy("below", "upto").agg(F.count("*").alias("n"))
    total = sums.agg(F.sum("n")).scalar()
    # A value has the edge i at or above it if at most i edges lie below it.
    met = sums.join(cuts, F.lit(True)).groupBy("part", "edge", "parts").agg(
        F.sum(F.when(F.col("upto") <= F.col("part"), F.col("n")).otherwise(0)).alias("less"),
        F.sum(F.when(F.col("below") <= F.col("part"), F.col("n")).otherwise(0)).alias("most"),
    )
    wanted = (F.col("part") + 1) / F.col("parts")
    return met.select(
        "part", "edge", (F.col("most") / total).alias("rank"), wanted.alias("wanted"),
        ((F.col("less") / total <= wanted + RANK_ERROR) & (F.col("most") / total >= wanted - RANK_ERROR)).alias("within"),
    )


def part_profile(scored: DataFrame, by: str, edges: DataFrame) -> DataFrame:
    """Mean signals and score in each part of one signal that the edges cut."""
    cut = scored.withColumn("_edges", edges.select("edges").scalar())
    return cut.groupBy(part_of(F.col(by), F.col("_edges")).alias("part")).agg(
        F.count("*").alias("papers"),
        *[F.avg(f"{s}_norm").alias(f"mean_{s}") for s in WEIGHTS],
        F.avg("impact_score").alias("mean_score"),
    )


def distinct_sketches(df: DataFrame, by: Sequence[Column | str], key: str) -> DataFrame:
    """``by`` with an ``hll`` sketch for unions and a ``theta`` sketch for all set operations of the group's keys."""
    return df.groupBy(*by).agg(
        F.hll_sketch_agg(key, F.lit(LG_K)).alias("hll"), F.theta_sketch_agg(key, F.lit(LG_K)).alias("theta")
    )


def united_distinct(sketches: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """``by`` and ``estimate``: the distinct keys of all batches of a group together."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("estimate"))


def set_estimates(one: DataFrame, two: DataFrame) -> DataFrame:
    """One row: estimates of the keys that both sides have, either has, and only the first has, from all batches of each."""
    a, b = (s.agg(F.theta_union_agg("theta", F.lit(LG_K)).alias("t")).select("t").scalar() for s in (one, two))
    return one.sparkSession.range(1).select(
        F.theta_sketch_estimate(F.theta_intersection(a, b)).alias("both"),
        F.theta_sketch_estimate(F.theta_union(a, b, F.lit(LG_K))).alias("either"),
        F.theta_sketch_estimate(F.theta_difference(a, b)).alias("only_first"),
    )


def close(estimate: Column, exact: Column) -> Column:
    """Does an estimate keep DISTINCT_ERROR (or one key, for small counts)?"""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * DISTINCT_ERROR)
