"""Schema contracts: strict field lists for tables and JSON records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.jsonl import flag_records, with_last_entries

# The strict document layouts of the two published indexes.
PAPER_DOCUMENT = {
    "id": "string",
    "title": "string",
    "abstract": "string",
    "authors": "string",
    "categories": "array<string>",
    "update_date": "string",
    "doi": "string",
    "journal-ref": "string",
    "comments": "string",
    "license": "string",
}
MONITORING_DOCUMENT = {
    "timestamp": "timestamp",
    "source": "string",
    "layer": "string",
    "object_count": "int",
    "size_bytes": "bigint",
    "size_mb": "double",
    "size_gb": "double",
    "ge_evaluated": "int",
    "ge_successful": "int",
    "ge_failed": "int",
    "ge_success_rate": "double",
    "ge_error_rate": "double",
    "freshness_timestamp": "timestamp",
}
# Longest keyword kept per field (for title and authors, in a side field).
PAPER_KEYWORD_LIMITS = {"title": 512, "authors": 512, "doi": 512, "license": 1024}


def schema_differences(
    spark: SparkSession, schema: StructType, contract: Mapping[str, str]
) -> DataFrame:
    """One row per problem: column, expected, found, problem. Reads no data."""
    found = {f.name: f.dataType.simpleString() for f in schema.fields}
    rows = [
        (name, contract.get(name), found.get(name), problem)
        for name in sorted({*found, *contract})
        if (
            problem := "unexpected column"
            if name not in contract
            else "missing column"
            if name not in found
            else "wrong type"
            if found[name] != contract[name]
            else None
        )
    ]
    return spark.createDataFrame(
        rows, "column string, expected string, found string, problem string"
    )


def _kinds(dtype: str) -> list[str]:
    """JSON kinds (as named by schema_of_variant, without a decimal's digits) that a contract type takes."""
    if dtype == "array<string>":
        return ["ARRAY<STRING>", "ARRAY<VOID>"]
    if dtype in ("int", "bigint"):
        return ["BIGINT"]
    if dtype == "double":
        return ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]
    if dtype in ("string", "timestamp"):
        return ["STRING"]
    raise ValueError(f"no such type in a contract: {dtype}")


def check_records(
    lines: DataFrame, contract: Mapping[str, str], column: str = "value"
) -> DataFrame:
    """Strict check of JSON lines: ``lines`` with ``record`` and ``bad_fields``.

    A field that the contract does not know, or whose value (elements included) is of another kind or does not fit the
    type, is bad; a JSON null and a missing field are fine and read as NULL. A record conforms if it has no
    bad field, and then ``record`` has all its values: both come from the same parse. Of a line that is no
    object ``bad_fields`` says so, and ``record`` is NULL.
    """
    flagged = flag_records(lines, "_record", column, "_text")
    parsed = with_last_entries(flagged, "_entries", "_text").withColumn("_map", F.map_from_entries("_entries")).drop("_text")

    # Each step is unpacked from an array, so that the next one does not take it again for every use.
    def step(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.select("*", F.explode(F.array(value)).alias(name))

    names = list(contract)
    found = [F.col(f"_found.`{n}`") for n in names]
    typed = [F.col(f"_typed.`{n}`") for n in names]
    parsed = step(parsed, "_found", F.struct(*[F.try_element_at("_map", F.lit(n)).alias(n) for n in names])).drop("_map")
    casts = [F.try_variant_get(v, "$", contract[n]).alias(n) for n, v in zip(names, found)]
    parsed = step(parsed, "_typed", F.struct(*casts))
    bad = []
    for name, value, cast in zip(names, found, typed):
        kind = F.regexp_replace(F.schema_of_variant(value), r"\(.*\)", "")
        wrong = F.coalesce(~kind.isin(_kinds(contract[name])) | cast.isNull(), F.lit(True))
        given = value.isNotNull() & ~F.is_variant_null(value)
        bad.append(F.when(given & wrong, F.lit(name)))
    parsed = step(parsed, "_bad", F.array(*bad))
    unknown = F.transform(
        F.filter("_entries", lambda e: ~e["key"].isin(list(contract))), lambda e: e["key"]
    )
    readable = F.col("_record") & F.col("_entries").isNotNull()
    fields = F.array_sort(F.array_compact(F.concat("_bad", unknown)))
    return parsed.select(
        *lines.columns,
        F.when(readable, F.col("_typed")).alias("record"),
        F.when(readable, fields).otherwise(F.array(F.lit("<not an object>"))).alias("bad_fields"),
    )
