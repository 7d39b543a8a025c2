"""Whole-table profiles: missing values, types, duplicates, frequencies, domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import SPACES, strip
from ..sources.jsonl import flag_records, with_last_entries

# What counts as missing: NULL or an empty value; NULL or ''; NULL or blank.
EMPTY, NULL_OR_EMPTY_STRING, BLANK = "empty", "null_or_empty_string", "blank"


def _missing(df: DataFrame, name: str, policy: str) -> Column:
    col, dtype = F.col(f"`{name}`"), dict(df.dtypes)[name]
    missing = col.isNull()
    if dtype == "string":
        return missing | ((strip(col) if policy == BLANK else col) == "")
    if policy == EMPTY and dtype.startswith(("array", "map")):
        return missing | (F.size(col) == 0)
    return missing


def null_profile(
    df: DataFrame, cols: Sequence[str] | None = None, policy: str = EMPTY
) -> DataFrame:
    """(field, rows, missing, missing_pct): all columns in one aggregate."""
    cols = list(cols or df.columns)
    wide = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(_missing(df, n, policy)).alias(f"m{i}") for i, n in enumerate(cols)],
    )
    return wide.select(
        "rows",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("field"), F.col(f"m{i}").alias("missing"))
                    for i, n in enumerate(cols)
                ]
            )
        ),
    ).select(
        "field",
        "rows",
        "missing",
        F.round(F.try_divide(F.col("missing") * F.lit(100.0), F.col("rows")), 2).alias(
            "missing_pct"
        ),
    )


def coverage_pct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(field, rows, present, coverage_pct): share of non-NULL values."""
    return null_profile(df, cols, NULL_OR_EMPTY_STRING).select(
        "field",
        "rows",
        (F.col("rows") - F.col("missing")).alias("present"),
        F.round(
            F.try_divide((F.col("rows") - F.col("missing")) * F.lit(100.0), F.col("rows")), 2
        ).alias("coverage_pct"),
    )


def json_field_profile(lines: DataFrame, column: str = "value") -> DataFrame:
    """Fields of raw JSON records, whatever they are.

    (field, present, empty, null_or_empty_string, absent, kinds): in how many
    records a field occurs, how often its value is NULL, '', [] or {}, how often
    it is NULL or '', in how many records it is absent, and the kinds of value
    seen (BIGINT, STRING, ARRAY, OBJECT, VOID for null, ...). A nameless entry
    per record makes the number of records the highest count, so the lines are
    parsed once for both (ReusedExchange).
    """
    parsed = flag_records(lines.select(column), "_record", column, "_text").where("_record")
    parsed = with_last_entries(parsed, "_entries", "_text")
    fields = F.coalesce("_entries", F.array())
    record = F.struct(
        F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value")
    )
    entries = parsed.select(
        F.inline(F.concat(F.array(record), fields)).alias("field", "_value")
    ).select(
        "field",
        F.to_json("_value").alias("text"),
        F.regexp_extract(F.schema_of_variant("_value"), r"^([A-Z]+)", 1).alias("kind"),
    )
    counts = entries.groupBy("field").agg(
        F.count("*").alias("present"),
        F.count_if(F.col("text").isin("null", '""', "[]", "{}")).alias("empty"),
        F.count_if(F.col("text").isin("null", '""')).alias("null_or_empty_string"),
        F.array_sort(F.collect_set("kind")).alias("kinds"),
    )
    most = counts.agg(F.max(F.struct(*[c for c in counts.columns if c != "field"])).alias("m"))
    return counts.where(F.size("kinds") > 0).withColumn(
        "absent", most.select("m.present").scalar() - F.col("present")
    )


def value_frequencies(
    df: DataFrame,
    value: Column,
    *,
    top: int | None = None,
    missing: str | None = None,
) -> DataFrame:
    """(value, n), most frequent first with ties by value when ``top`` is given.

    ``missing`` names the NULLs; without it they are left out.
    """
    values = df.select(value.alias("value"))
    values = (
        values.where("value IS NOT NULL") if missing is None else values.fillna(missing)
    )
    counts = values.groupBy("value").agg(F.count("*").alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), "value").limit(top)


def token_frequencies(df: DataFrame, text: Column, top: int | None = None) -> DataFrame:
    """Frequencies of whitespace-separated tokens."""
    tokens = df.select(F.explode(F.split(text, SPACES)).alias("token"))
    return value_frequencies(tokens.where("token <> ''"), F.col("token"), top=top)


def duplicate_rows(df: DataFrame, key: Column) -> DataFrame:
    """One row: rows with a key, distinct keys, excess rows."""
    return df.agg(
        F.count(key).alias("keyed_rows"), F.count_distinct(key).alias("distinct_keys")
    ).withColumn("excess_rows", F.col("keyed_rows") - F.col("distinct_keys"))


def duplicate_keys(df: DataFrame, key: Column) -> DataFrame:
    """One row: how many non-NULL keys occur more than once."""
    return (
        df.select(key.alias("_k"))
        .where("_k IS NOT NULL")
        .groupBy("_k")
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("repeated_keys"))
    )


def distinct_key_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_distinct(key).alias("distinct_keys"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def domain_profile(
    df: DataFrame,
    *,
    required: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    integer: Sequence[str] = (),
) -> DataFrame:
    """One row: missing_<c>, negative_<c>, non_integer_<c>, min_<c>, max_<c>.

    ``integer`` columns may be text or numbers; min and max cover the integers.
    """
    text = {c for c, t in df.dtypes if t == "string"}

    def whole(c: str) -> Column:
        number = F.col(c).try_cast("bigint")
        if c in text:
            return number
        return F.when(number.cast("double") == F.col(c).cast("double"), number)

    return df.agg(
        F.count("*").alias("rows"),
        *[
            F.count_if(_missing(df, c, BLANK)).alias(f"missing_{c}")
            for c in required
        ],
        *[
            F.count_if(F.col(c).try_cast("double") < 0).alias(f"negative_{c}")
            for c in non_negative
        ],
        *[
            agg
            for c in integer
            for agg in (
                F.count_if(F.col(c).isNotNull() & whole(c).isNull()).alias(f"non_integer_{c}"),
                F.min(whole(c)).alias(f"min_{c}"),
                F.max(whole(c)).alias(f"max_{c}"),
            )
        ],
    )
