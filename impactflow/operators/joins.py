"""Equi-joins with a stated strategy, and a join that survives hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SALTS = 1_024


def broadcast_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join with a small ``right``: Spark broadcasts it below its own threshold, by estimate or by the
    size found at run time, and falls back to a shuffled join beyond."""
    return left.join(right, list(on), how)


def sort_merge_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Sort-merge join asked for by hint, so no session setting changes."""
    return left.join(right.hint("merge"), list(on), how)


def left_join_fill(
    left: DataFrame, right: DataFrame, on: Sequence[str], fill: Mapping[str, object]
) -> DataFrame:
    """Optional side: left join, missing measures replaced by ``fill``."""
    return left.join(right, list(on), "left").fillna(dict(fill))


def spread_nulls(key: Column, spread: Column) -> Column:
    """A second join key: 0, or one of ``NULL_SALTS`` values where ``key`` is NULL.

    NULL keys match nothing, but outer and anti joins still shuffle their rows;
    with this they do not all land in one task.
    """
    return F.when(key.isNull(), F.pmod(spread, F.lit(NULL_SALTS)).cast("int")).otherwise(0)


def salted_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    salts: int,
    one_salts: int = 1,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Inner or left join that deals every key of ``many`` over ``salts`` tasks.

    For joins whose keys are known to be hot and whose plan keeps Spark from splitting them itself
    (a side that is an aggregate by the key). Each row of ``one`` is copied ``salts`` times, so ``one`` should be the far
    smaller side; ``one_salts`` deals its keys out as well, in inner joins. The salt comes from ``row_id``, columns that tell the rows of a
    key apart, or else from the number of the input partition; both are the same when a task is run again. The
    plan is the same at every size.
    """
    if how not in ("inner", "left") or (one_salts > 1 and how == "left"):
        raise ValueError(f"this salted join cannot be {how}")
    on = list(on)

    def salt(n: int) -> Column:
        source = F.xxhash64(*row_id) if row_id else F.spark_partition_id()
        return F.pmod(source, F.lit(n)).cast("int")

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)

    left = many.withColumn("_m", salt(salts)).withColumn("_o", copies(one_salts))
    right = one.withColumn("_o", F.pmod(F.spark_partition_id(), F.lit(one_salts)).cast("int"))
    right = right.withColumn("_m", copies(salts))
    return left.join(right, [*on, "_m", "_o"], how).drop("_m", "_o")
