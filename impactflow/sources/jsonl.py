"""JSON Lines scans, tolerant and strict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARRIVAL = "arrival"

# Fixed values, record layouts: field -> type read from the raw JSON. Scalars that need
# tolerant conversion are read as strings and converted by the cleaners.
PAPER_FIELDS = {
    "id": "string",
    "title": "string",
    "abstract": "string",
    "authors": "string",
    "categories": "string",
    "update_date": "string",
    "doi": "string",
    "journal-ref": "string",
    "comments": "string",
    "license": "string",
    "versions": "array<struct<version:string,created:string>>",
}
POST_FIELDS = {
    "id": "bigint",
    "by": "string",
    "time": "string",
    "type": "string",
    "title": "string",
    "url": "string",
    "score": "string",
    "descendants": "string",
    "text": "string",
    "kids": "array<bigint>",
}
CITATION_FIELDS = {
    "id": "string",
    "doi": "string",
    "title": "string",
    "publication_year": "bigint",
    "publication_date": "string",
    "cited_by_count": "string",
    "counts_by_year": "array<struct<year:bigint,cited_by_count:bigint>>",
    "referenced_works_count": "string",
    "type": "string",
    "primary_location": "struct<id:string>",
}


@dataclass(frozen=True)
class JsonlScan:
    """Parsed records, the lines that did not parse, and the counts of both."""

    records: DataFrame
    rejects: DataFrame
    report: DataFrame


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw lines with ``arrival``, a sortable (file, offset, line) position.

    File paths sort in landing order, so a later micro-batch arrives later. The
    last part grows along a split, and splits of one file sort by their offset.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias(ARRIVAL),
    )


# What the VARIANT parser refuses, or not, by a session setting: a field that is there twice
# (its last value counts), NaN and infinite numbers.
_LENIENT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}


def _bracketed(line: Column) -> Column:
    """The line as first element of a JSON array that ends in a 0."""
    return F.concat(F.lit("["), line, F.lit(",0]"))


def _parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines with ``_line``, the bracketed parse, and ``_spare``, the same by the JSON reader for lines
    that VARIANT does not take. Unpacking each from an array keeps what follows from parsing the line
    again; the second one reads the first, as both in one array would parse every line twice."""
    bracketed = _bracketed(F.col(column))
    parsed = lines.select("*", F.explode(F.array(F.try_parse_json(bracketed))).alias("_line"))
    spare = F.when(F.col("_line").isNull(), F.from_json(bracketed, "array<string>", _LENIENT))
    return parsed.select("*", F.explode(F.array(spare)).alias("_spare"))


def _is_record(line: Column) -> Column:
    """Is the line one JSON object and nothing else?

    The parser stops after a value and ignores what follows. In a bracketed line
    anything that follows breaks the array or moves its last element.
    """
    blank = F.lit(" \t\r\n")
    variant, spare = F.col("_line"), F.col("_spare")
    # As numbers the object is NULL. A path to what is not there would cost more than the parse.
    one = F.try_variant_get(variant, "$", "array<bigint>") == F.array(F.lit(None).cast("bigint"), F.lit(0).cast("bigint"))
    return F.coalesce(
        F.startswith(F.ltrim(line, blank), F.lit("{"))
        & F.endswith(F.rtrim(line, blank), F.lit("}"))
        & F.when(variant.isNotNull(), one).otherwise(
            (F.size(spare) == 2) & (F.try_element_at(spare, F.lit(2)) == "0")
        ),
        F.lit(False),
    )


def flag_records(
    lines: DataFrame, flag: str, column: str = "value", text: str | None = None
) -> DataFrame:
    """Add ``flag``: is the line a JSON object? ``text`` adds it as JSON that needs no leniency but for
    repeated fields."""
    parsed = _parsed(lines, column).withColumn(flag, _is_record(F.col(column)))
    if text:
        strict = F.when(F.col("_line").isNull(), F.get("_spare", 0)).otherwise(F.col(column))
        parsed = parsed.withColumn(text, strict)
    return parsed.drop("_line", "_spare")


def with_last_entries(df: DataFrame, name: str, text: str) -> DataFrame:
    """Add ``name``: fields of the JSON object ``text`` as entries (key, value: VARIANT), each name once, with its
    last value. The object is unpacked from an array, so that no use of it parses the text again; so are the entries."""
    parsed = df.select("*", F.explode(F.array(F.from_json(text, "map<string,variant>"))).alias("_object"))
    entries = F.map_entries("_object")
    names = F.map_keys("_object")
    backwards = F.reverse(names)
    once = F.when(F.size(F.array_distinct(names)) == F.size(names), entries).otherwise(
        F.filter(entries, lambda e, i: F.array_position(backwards, e["key"]) == F.size(names) - i)
    )
    return parsed.select(*df.columns, F.explode(F.array(once)).alias(name))


def _record(fields: Mapping[str, str]) -> Column:
    """The line's fields as one struct, taken in one pass over the parsed object; NULL if there is none."""
    layout = ", ".join(f"`{name}` {dtype}" for name, dtype in fields.items())
    spare = F.from_json(F.get("_spare", 0), layout, _LENIENT)
    whole = F.try_variant_get("_line", "$[0]", f"struct<{layout}>")
    return F.when(F.col("_line").isNotNull(), whole).otherwise(spare)


def _unpacked(parsed: DataFrame, record: Column, rest: Sequence[str]) -> DataFrame:
    """The fields of each record as columns, and the columns in ``rest``. Conditions on the fields that
    follow do not take the record once more, as it is unpacked from an array."""
    return parsed.select(F.inline(F.array(record)), *rest)


def parse_lines(lines: DataFrame, fields: Mapping[str, str]) -> JsonlScan:
    """Split lines into records and rejects; only JSON objects are records.

    Each line is parsed once, then all fields are taken, each with its own cast, so a
    mistyped value nulls that field and nothing else. The result does not depend on
    session settings.
    """
    good = _is_record(F.col("value"))
    parsed = _parsed(lines)
    rest = [c for c in lines.columns if c != "value"]
    return JsonlScan(
        records=_unpacked(parsed.where(good), _record(fields), rest),
        rejects=parsed.where(~good).select(*lines.columns),
        report=parsed.agg(
            F.count("*").alias("lines"),
            F.count_if(good).alias("records"),
            F.count_if(~good).alias("invalid_lines"),
        ),
    )


def stage_lines(lines: DataFrame, **layouts: Mapping[str, str]) -> DataFrame:
    """Every line once: ``is_record``, ``reject`` (the line, where it is none), a struct of fields for each
    layout, and the lines' other columns. Written as a table it saves each later use another parse."""
    good = _is_record(F.col("value"))
    return _parsed(lines).select(
        good.alias("is_record"),
        F.when(~good, F.col("value")).alias("reject"),
        *[_record(fields).alias(name) for name, fields in layouts.items()],
        *[c for c in lines.columns if c != "value"],
    )


def parse_lines_strict(lines: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Records of lines that must all be JSON objects; the first other line fails
    the job."""
    shown = F.concat(F.lit("not a JSON record: "), F.substring("value", 1, 200))
    checked = F.when(_is_record(F.col("value")), _record(fields)).otherwise(F.raise_error(shown))
    rest = [c for c in lines.columns if c != "value"]
    return _unpacked(_parsed(lines), checked, rest)


def scan_jsonl(
    spark: SparkSession, paths: str | Sequence[str], fields: Mapping[str, str]
) -> JsonlScan:
    """Tolerant scan: bad lines are set aside and counted, not fatal."""
    return parse_lines(read_lines(spark, paths), fields)


def scan_jsonl_strict(
    spark: SparkSession, paths: str | Sequence[str], fields: Mapping[str, str]
) -> DataFrame:
    """Strict scan: the first line that is no JSON object, a blank one included, fails the job."""
    return parse_lines_strict(read_lines(spark, paths), fields)


def scan_microbatches(
    spark: SparkSession, folder: str, fields: Mapping[str, str], glob: str = "*"
) -> JsonlScan:
    """All micro-batch files of a folder as one scan, ordered by ``arrival``."""
    return scan_jsonl(spark, f"{folder.rstrip('/')}/{glob}", fields)
