"""Quality rules over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import expect as e
from ...operators import profile as p
from ...session import scratch_dir
from ...sinks.contract import PAPER_DOCUMENT, schema_differences
from .registry import query, table


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Events with faults: NULL titles, repeated keys, odd dates, an unknown type."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind != "error", kind).alias("title"),
        F.when(kind != "view", F.col("user_id")).alias("key"),
        kind.alias("type"),
        "value",
        F.when(kind == "click", "2024-02-30")
        .when(kind == "signup", "2024-2-3")
        .when(kind != "view", F.date_format("ts", "yyyy-MM-dd"))
        .alias("day"),
    )


def _rule_sql(name: str, column: str, nulls: str, unexpected: str, position: int = 1) -> str:
    return f"""SELECT {position} AS position, '{name}' AS rule, '{column}' AS "column",
      (SELECT count(*) FROM events) AS rows, CAST(({nulls}) AS BIGINT) AS nulls,
      CAST(({unexpected}) AS BIGINT) AS unexpected, ({unexpected}) = 0 AS success"""


def _count(where: str) -> str:
    return f"SELECT count(*) FROM events WHERE {where}"


REPEATED_KEYS = """SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM events
  WHERE event_type <> 'view' GROUP BY user_id HAVING count(*) > 1)"""
RULES = {
    "expect_not_null": (
        e.not_null("title"), _count("event_type = 'error'"), _count("event_type = 'error'")),
    "expect_unique": (e.unique("key"), _count("event_type = 'view'"), REPEATED_KEYS),
    "expect_between": (
        e.between("value", 0, 300), _count("value IS NULL"),
        _count("value < 0 OR value > 300")),
    "expect_in_set": (
        e.in_set("title", ["view", "click"]), _count("event_type = 'error'"),
        _count("event_type IN ('purchase', 'signup')")),
    "expect_type": (e.of_type("value", "int64"), _count("false"), _count("true")),
    "expect_date_format": (
        e.date_format("day"), _count("event_type = 'view'"), _count("event_type = 'click'")),
}


def _register_rule(name: str) -> None:
    rule, nulls, unexpected = RULES[name]

    @query(name, _rule_sql(rule.kind, rule.column, nulls, unexpected))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return e.run_suite(records(spark, sf), [rule])


for _name in RULES:
    _register_rule(_name)

SUITE = [rule for rule, _, _ in RULES.values()] + [e.unique("event_id"), e.not_null("absent")]
SUITE_SQL = " UNION ALL ".join(
    _rule_sql(rule.kind, rule.column, nulls, unexpected, i + 1)
    for i, (rule, nulls, unexpected) in enumerate(
        [*RULES.values(),
         (SUITE[-2], _count("false"), "SELECT count(*) - count(DISTINCT event_id) FROM events"),
         (SUITE[-1], _count("true"), _count("true"))]
    )
)


@query("run_suite", SUITE_SQL)
def run_suite(spark: SparkSession, sf: str) -> DataFrame:
    return e.run_suite(records(spark, sf), SUITE)


@query(
    "suite_summary",
    f"""SELECT count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
    count(*) FILTER (WHERE NOT success) AS unsuccessful,
    round(100.0 * count(*) FILTER (WHERE success) / count(*), 2) AS success_pct,
    bool_and(success) AS success FROM ({SUITE_SQL})""",
)
def suite_summary(spark: SparkSession, sf: str) -> DataFrame:
    return e.suite_summary(run_suite(spark, sf))


@query("load_suite", SUITE_SQL)
def load_suite(spark: SparkSession, sf: str) -> DataFrame:
    """The suite written as JSON, read back and run."""
    _, rules = e.load_suite(e.suite_to_json("events", SUITE))
    return e.run_suite(records(spark, sf), rules)


@query(
    "store_validation",
    f"""SELECT suite, run_id, position, unexpected, success FROM ({SUITE_SQL}),
    (VALUES ('events', 'run-1'), ('events', 'run-2')) v(suite, run_id)""",
)
def store_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Results of two runs, the second stored twice."""
    folder = scratch_dir(spark, "validations")
    results = run_suite(spark, sf)
    for run in ("run-1", "run-2", "run-2"):
        e.store_validation(results, folder, suite="events", run_id=run, run_at="2024-01-01")
    stored = spark.read.parquet(folder)
    return stored.select("suite", "run_id", "position", "unexpected", "success")


@query(
    "quality_gate",
    """WITH r AS (SELECT event_id, event_type, value,
             CASE WHEN event_type <> 'view' THEN count(*) FILTER (WHERE event_type <> 'view')
               OVER (PARTITION BY user_id) ELSE 1 END AS copies FROM events),
    f AS (SELECT event_id,
      CASE WHEN event_type = 'error'
        THEN ',expect_column_values_to_not_be_null:title' ELSE '' END
      || CASE WHEN value < 0 OR value > 300
        THEN ',expect_column_values_to_be_between:value' ELSE '' END
      || CASE WHEN copies > 1 THEN ',expect_column_values_to_be_unique:key' ELSE '' END
      AS failed FROM r)
    SELECT event_id, CASE WHEN failed = '' THEN 'good' ELSE 'quarantine' END AS part,
           substr(failed, 2) AS failed_rules FROM f""",
)
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    rules = [e.not_null("title"), e.between("value", 0, 300), e.unique("key")]
    part = F.when(F.size("failed_rules") == 0, "good").otherwise("quarantine")
    return e.quality_gate(records(spark, sf), rules).select(
        "event_id", part.alias("part"), F.concat_ws(",", "failed_rules").alias("failed_rules")
    )


MISSING_FIELDS = (
    "abstract", "authors", "categories", "comments", "doi", "id", "journal-ref", "license",
    "update_date",
)
EXTRA_COUNTS = {
    "day": "event_type <> 'view'", "key": "event_type <> 'view'", "type": "true", "value": "true",
}


@query(
    "schema_differences",
    " UNION ALL ".join(
        [
            *[
                f"""SELECT '{n}' AS "column", 'missing column' AS problem, 0 AS values"""
                for n in MISSING_FIELDS
            ],
            *[
                f"""SELECT '{n}', 'unexpected column', ({_count(where)})"""
                for n, where in EXTRA_COUNTS.items()
            ],
        ]
    ),
)
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that break the paper layout, with the values each would lose."""
    found = records(spark, sf).drop("event_id")
    problems = schema_differences(spark, found.schema, PAPER_DOCUMENT)
    present = p.coverage_pct(found, found.columns).select(
        F.col("field").alias("column"), "present"
    )
    return problems.join(present, "column", "left").select(
        "column", "problem", F.coalesce("present", F.lit(0)).alias("values")
    )
