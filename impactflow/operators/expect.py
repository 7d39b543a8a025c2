"""Declarative data-quality rules, evaluated over whole tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import salted_join

# Rule names as written in suite files.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
OF_TYPE = "expect_column_values_to_be_of_type"
DATE_FORMAT = "expect_column_values_to_match_strftime_format"

_TYPES = {
    "int64": "bigint", "int32": "int", "float64": "double", "object": "string",
    "str": "string", "bool": "boolean",
}


KEY_SALTS = 16
RECORDS = "expect_lines_to_be_records"


@dataclass(frozen=True)
class Rule:
    """One expectation on one column."""

    kind: str
    column: str
    kwargs: Mapping[str, object] = field(default_factory=dict)


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column)


def unique(column: str) -> Rule:
    return Rule(UNIQUE, column)


def between(column: str, low: float | None = None, high: float | None = None) -> Rule:
    bounds = {"min_value": low, "max_value": high}
    return Rule(BETWEEN, column, {k: v for k, v in bounds.items() if v is not None})


def in_set(column: str, values: Sequence[object]) -> Rule:
    return Rule(IN_SET, column, {"value_set": list(values)})


def of_type(column: str, type_: str) -> Rule:
    return Rule(OF_TYPE, column, {"type_": type_})


def date_format(column: str, strftime: str = "%Y-%m-%d") -> Rule:
    return Rule(DATE_FORMAT, column, {"strftime_format": strftime})


def suite_to_json(name: str, rules: Sequence[Rule]) -> str:
    """The suite as a JSON document."""
    return json.dumps(
        {
            "expectation_suite_name": name,
            "expectations": [
                {"expectation_type": r.kind, "kwargs": {"column": r.column, **r.kwargs}}
                for r in rules
            ],
        },
        indent=2,
    )


def load_suite(document: str) -> tuple[str, list[Rule]]:
    """(name, rules) from a JSON document."""
    spec = json.loads(document)
    rules = []
    for e in spec["expectations"]:
        kwargs = dict(e["kwargs"])
        rules.append(Rule(e["expectation_type"], kwargs.pop("column"), kwargs))
    return spec["expectation_suite_name"], rules


def paper_rules() -> list[Rule]:
    return [
        not_null("id"), unique("id"), not_null("title"), not_null("abstract"),
        not_null("categories"), not_null("update_date"), date_format("update_date"),
    ]


def citation_rules(first_year: int = 1984, last_year: int = 2026) -> list[Rule]:
    return [
        not_null("id"), unique("id"), not_null("cited_by_count"),
        between("cited_by_count", 0), not_null("publication_year"),
        between("publication_year", first_year, last_year),
    ]


def post_rules() -> list[Rule]:
    return [
        not_null("id"), of_type("id", "int64"), not_null("title"), not_null("time"),
        of_type("time", "int64"), not_null("type"), in_set("type", ["story"]),
        not_null("by"), not_null("score"),
    ]


def valid_date(c: Column, strftime: str = "%Y-%m-%d") -> Column:
    """Does the text parse as year-month-day (leading zeros optional)?"""
    if strftime != "%Y-%m-%d":
        raise ValueError(f"unsupported date format {strftime}")
    shape = c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & ~c.startswith("0000")
    return F.coalesce(shape & F.try_to_date(c, "yyyy-M-d").isNotNull(), F.lit(False))


def missing(c: Column, dtype: str) -> Column:
    """NULL, which for raw JSON values includes the JSON null."""
    return c.isNull() | F.is_variant_null(c) if dtype == "variant" else c.isNull()


def violation(rule: Rule, dtypes: Mapping[str, str]) -> Column:
    """Is a row unexpected under a row-level rule? Never NULL; NULL values pass
    all rules but not_null. A missing column fails every row."""
    if rule.column not in dtypes:
        return F.lit(True)
    c = F.col(f"`{rule.column}`")
    if rule.kind == NOT_NULL:
        return missing(c, dtypes[rule.column])
    if rule.kind == OF_TYPE:
        wanted = _TYPES.get(rule.kwargs["type_"], rule.kwargs["type_"])
        found = dtypes[rule.column]
        if found == "variant":
            return ~missing(c, found) & (F.schema_of_variant(c) != wanted.upper())
        return F.lit(found != wanted)
    if rule.kind == BETWEEN:
        low, high = rule.kwargs.get("min_value"), rule.kwargs.get("max_value")
        bad = F.lit(False)
        if low is not None:
            bad = bad | (c < F.lit(low))
        if high is not None:
            bad = bad | (c > F.lit(high))
    elif rule.kind == IN_SET:
        bad = ~c.isin(list(rule.kwargs["value_set"]))
    elif rule.kind == DATE_FORMAT:
        bad = ~valid_date(c, rule.kwargs["strftime_format"])
    else:
        raise ValueError(f"not a row-level rule: {rule.kind}")
    return c.isNotNull() & bad


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(position, rule, column, rows, nulls, unexpected, success), one row per rule.

    All rules share one pass: counts of the row-level rules are taken per value of the uniqueness
    rule's column and then summed, so the input is read once. Every row of a repeated value is
    unexpected. Uniqueness of further columns takes one more grouped count each.
    """
    dtypes = dict(df.dtypes)
    counts: list[Column] = []
    uniques: dict[str, str] = {}
    for i, rule in enumerate(rules):
        known = rule.column in dtypes
        nulls = (
            missing(F.col(f"`{rule.column}`"), dtypes[rule.column]) if known else F.lit(True)
        )
        counts.append(F.count_if(nulls).alias(f"n{i}"))
        if rule.kind == UNIQUE and known:
            uniques[f"u{i}"] = rule.column
        else:
            checked = Rule(NOT_NULL, rule.column) if rule.kind == UNIQUE else rule
            counts.append(F.count_if(violation(checked, dtypes)).alias(f"u{i}"))
    repeated = F.when((F.col("rows") > 1) & F.col("_k").isNotNull(), F.col("rows")).otherwise(0)
    columns = list(dict.fromkeys(uniques.values()))

    def total(name: Column | str, alias: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(alias)

    if columns:
        by = df.withColumn("_k", F.col(f"`{columns[0]}`")).groupBy("_k")
        names = [f"n{i}" for i in range(len(rules))]
        names += [f"u{i}" for i in range(len(rules)) if f"u{i}" not in uniques]
        wide = by.agg(F.count("*").alias("rows"), *counts).agg(
            *[total(n, n) for n in ["rows", *names]],
            *[total(repeated, u) for u, c in uniques.items() if c == columns[0]],
        )
        for other in columns[1:]:
            groups = df.groupBy(F.col(f"`{other}`").alias("_k")).agg(F.count("*").alias("rows"))
            value = groups.agg(total(repeated, "v")).scalar()
            wide = wide.withColumns({u: value for u, c in uniques.items() if c == other})
    else:
        wide = df.agg(F.count("*").alias("rows"), *counts)
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(rule.kind).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.col(f"n{i}").alias("nulls"),
            F.col(f"u{i}").alias("unexpected"),
        )
        for i, rule in enumerate(rules)
    ]
    return wide.select("rows", F.inline(F.array(*entries))).select(
        "position", "rule", "column", "rows", "nulls", "unexpected",
        (F.col("unexpected") == 0).alias("success"),
    )


def line_rule(position: int, lines: int, invalid: int, allowed: int = 0) -> tuple:
    """Result row of the rule on raw lines: at most ``allowed`` of them are no records."""
    return (position, RECORDS, "<line>", lines, 0, invalid, invalid <= allowed)


def suite_summary(results: DataFrame) -> DataFrame:
    """One row: evaluated, successful, unsuccessful, success_pct, success."""
    good = F.count_if("success")
    return results.agg(
        F.count("*").alias("evaluated"),
        good.alias("successful"),
        (F.count("*") - good).alias("unsuccessful"),
        F.round(F.try_divide(good * F.lit(100.0), F.count("*")), 2).alias("success_pct"),
        F.every("success").alias("success"),
    )


def store_validation(
    results: DataFrame, path: str, *, suite: str, run_id: str, run_at: str
) -> None:
    """Keep a run's results under its suite and run id; a rerun replaces its own."""
    results.withColumn("run_at", F.lit(run_at).cast("timestamp")).write.mode(
        "overwrite"
    ).parquet(f"{path.rstrip('/')}/suite={suite}/run_id={run_id}")


def quality_gate(df: DataFrame, rules: Sequence[Rule], salts: int = KEY_SALTS) -> DataFrame:
    """``df`` with ``failed_rules``, empty for a good row; callers split by it.

    Repeated values of a uniqueness rule's column are dealt over ``salts`` tasks.
    """
    dtypes = dict(df.dtypes)
    flagged = df
    flags: list[Column] = []
    for i, rule in enumerate(rules):
        label = F.lit(f"{rule.kind}:{rule.column}")
        if rule.kind == UNIQUE and rule.column in dtypes:
            repeated = (
                df.where(F.col(f"`{rule.column}`").isNotNull())
                .groupBy(rule.column)
                .agg(F.count("*").alias("_n"))
                .where("_n > 1")
                .select(rule.column, F.lit(True).alias(f"_repeated{i}"))
            )
            flagged = salted_join(flagged, repeated, [rule.column], "left", salts=salts)
            flags.append(F.when(F.col(f"_repeated{i}"), label))
        else:
            checked = Rule(NOT_NULL, rule.column) if rule.kind == UNIQUE else rule
            flags.append(F.when(violation(checked, dtypes), label))
    return flagged.select(*df.columns, F.array_compact(F.array(*flags)).alias("failed_rules"))


def require_success(results: DataFrame) -> None:
    """Stop the job if a rule failed (brings the failed rules to the driver)."""
    failed = results.where(~F.col("success")).orderBy("position").collect()
    if failed:
        lines = [f"{r['rule']}({r['column']}): {r['unexpected']} unexpected" for r in failed]
        raise ValueError("failed rules: " + "; ".join(lines))


def all_pass(rules: Sequence[Rule], dtypes: Mapping[str, str]) -> Column:
    """Row-level rules as one predicate, for use in a stream filter."""
    return reduce(
        lambda a, b: a & b,
        [~violation(r, dtypes) for r in rules if r.kind != UNIQUE],
        F.lit(True),
    )
