"""Looking at physical plans and comparing join strategies."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The plan as Spark explains it in a mode (simple, extended, formatted, ...)."""
    java = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(java.fromString(mode))


def join_operators(df: DataFrame) -> list[str]:
    """Physical join operators of a plan, outermost first."""
    return re.findall(r"\b(\w+Join)\b", plan_text(df))


def content_hash(df: DataFrame) -> DataFrame:
    """One row: row count and a hash of the rows that ignores their order."""
    row = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("content_hash"),
    )


def join_strategy_report(variants: Mapping[str, DataFrame]) -> DataFrame:
    """(strategy, operator, rows, content_hash): same rows under every strategy?"""
    report = None
    for name, df in variants.items():
        operators = ",".join(join_operators(df))
        row = content_hash(df).select(
            F.lit(name).alias("strategy"),
            F.lit(operators).alias("operator"),
            "rows",
            "content_hash",
        )
        report = row if report is None else report.unionByName(row)
    return report
