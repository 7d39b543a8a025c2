"""Rules, suites, gates, profiles and term weights."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from impactflow.operators import expect as e
from impactflow.operators import profile as p
from impactflow.operators import terms as t
from impactflow.plans.inspect import plan_text

RULES = {
    "not_null": (e.not_null("c"), "string", ["a"], ["a", None], 1),
    "unique": (e.unique("c"), "string", ["a", "b", None, None], ["a", "a", "a", "b"], 3),
    "at least": (e.between("c", 0), "bigint", [0, 5, None], [-1, 0], 1),
    "range": (e.between("c", 1984, 2026), "bigint", [1984, 2026], [1983, 2027, 2000], 2),
    "in_set": (e.in_set("c", ["story"]), "string", ["story", None], ["job", "story"], 1),
    "date": (
        e.date_format("c"), "string", ["2007-04-02", "2007-4-2", None],
        ["2007-02-30", "2007/04/02", "x", "20070402"], 4),
}


@pytest.mark.parametrize("name", RULES)
def test_rule(spark, name):
    rule, dtype, good, bad, unexpected = RULES[name]
    for values, n in ((good, 0), (bad, unexpected)):
        df = spark.createDataFrame([(v,) for v in values], f"c {dtype}")
        row = e.run_suite(df, [rule]).first()
        assert (row["unexpected"], row["success"]) == (n, n == 0)


def test_type_rule(spark):
    assert e.run_suite(spark.range(2), [e.of_type("id", "int64")]).first()["success"]
    df = spark.createDataFrame([("1",)], "id string")
    assert not e.run_suite(df, [e.of_type("id", "int64")]).first()["success"]
    raw = spark.createDataFrame([("1",), ('"x"',), ("null",)], "j string")
    raw = raw.select(F.parse_json("j").alias("id"))
    assert e.run_suite(raw, [e.of_type("id", "int64")]).first()["unexpected"] == 1


def test_missing_column_fails_instead_of_raising(spark):
    row = e.run_suite(spark.range(3), [e.unique("absent")]).first()
    assert (row["unexpected"], row["success"]) == (3, False)


@pytest.mark.parametrize(
    "rules, n", [(e.paper_rules(), 7), (e.citation_rules(), 6), (e.post_rules(), 9)]
)
def test_suites_survive_json(rules, n):
    assert len(rules) == n
    assert e.load_suite(e.suite_to_json("s", rules)) == ("s", rules)


def test_suite_is_one_scan_plus_one_per_uniqueness_rule(spark, tmp_path):
    from impactflow.plans.inspect import plan_text

    path = str(tmp_path / "t")
    spark.createDataFrame([("1", 5, 2000)], "id string, cited_by_count long, publication_year long"
                          ).write.parquet(path)
    plan = plan_text(e.run_suite(spark.read.parquet(path), e.citation_rules()))
    assert plan.count("FileScan") == 1


def test_gate_quarantines_rows_with_their_reasons(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (2, "a", 5), (3, None, 5), (4, "b", -1), (5, "c", 1)], "i int, k string, n int"
    )
    flagged = e.quality_gate(df, [e.unique("k"), e.not_null("k"), e.between("n", 0)])
    found = {r["i"]: len(r["failed_rules"]) for r in flagged.collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 5: 0}
    assert flagged.columns == [*df.columns, "failed_rules"]


def test_suite_of_several_unique_columns_and_of_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, None)], "i int, k string")
    rules = [e.unique("i"), e.unique("k"), e.not_null("i")]
    rows = e.run_suite(df, rules).orderBy("position").collect()
    assert [(r["rows"], r["nulls"], r["unexpected"]) for r in rows] == [(4, 2, 2), (4, 1, 2), (4, 2, 2)]
    rows = e.run_suite(df.where("false"), rules).orderBy("position").collect()
    assert [(r["rows"], r["nulls"], r["unexpected"]) for r in rows] == [(0, 0, 0)] * 3


def test_require_success(spark):
    results = e.run_suite(spark.range(2), [e.not_null("id"), e.between("id", 1)])
    with pytest.raises(ValueError, match="between"):
        e.require_success(results)
    summary = e.suite_summary(results).first()
    assert tuple(summary) == (2, 1, 1, 50.0, False)


def test_all_pass_is_a_stream_filter(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, None)], "n int, s string")
    rules = [e.not_null("n"), e.in_set("s", ["a"])]
    assert df.where(e.all_pass(rules, dict(df.dtypes))).count() == 2


def test_three_meanings_of_missing(spark):
    df = spark.createDataFrame([("", []), (" ", [1]), (None, None), ("x", [2])], "s string, a array<int>")

    def missing(policy):
        return [r["missing"] for r in p.null_profile(df, ["s", "a"], policy).collect()]

    assert missing(p.EMPTY) == [2, 2]
    assert missing(p.NULL_OR_EMPTY_STRING) == [2, 1]
    assert missing(p.BLANK) == [3, 1]


def test_profile_of_an_empty_table(spark):
    row = p.null_profile(spark.range(0)).first()
    assert (row["rows"], row["missing"], row["missing_pct"]) == (0, 0, None)


def test_json_field_profile(spark):
    lines = spark.createDataFrame(
        [('{"id": 1, "k": []}',), ('{"id": "a", "k": null}',), ('{"id": ""}',), ("bad",), ("[1]",)],
        "value string",
    )
    got = {r["field"]: r.asDict() for r in p.json_field_profile(lines).collect()}
    assert got["id"] == {
        "field": "id", "present": 3, "empty": 1, "null_or_empty_string": 1,
        "kinds": ["BIGINT", "STRING"], "absent": 0,
    }
    assert got["k"] == {
        "field": "k", "present": 2, "empty": 2, "null_or_empty_string": 1,
        "kinds": ["ARRAY", "VOID"], "absent": 1,
    }


def test_duplicates_are_counted_two_ways(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "k string")
    assert tuple(p.duplicate_rows(df, F.col("k")).first()) == (6, 3, 3)
    assert p.duplicate_keys(df, F.col("k")).first()[0] == 2


def test_frequencies(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    top = p.value_frequencies(df, F.col("v"), top=1).collect()
    assert [tuple(r) for r in top] == [("a", 2)]
    labelled = {r[0]: r[1] for r in p.value_frequencies(df, F.col("v"), missing="missing").collect()}
    assert labelled == {"a": 2, "b": 2, "missing": 1}


def test_domain_profile(spark):
    df = spark.createDataFrame([("2000", -1.0), ("x", 2.0), (None, None), ("1990", 0.0)], "y string, n double")
    row = p.domain_profile(df, required=["y"], non_negative=["n"], integer=["y"]).first()
    assert row.asDict() == {
        "rows": 4, "missing_y": 1, "negative_n": 1, "non_integer_y": 1, "min_y": 1990, "max_y": 2000,
    }


DOCS = [
    (1, "The cat and the Cat sat"), (2, "cat dog dog"), (3, "   "), (4, None),
    (5, "I a x"), (6, "café 42 dog"),
]


def brute_tfidf():
    import re

    from impactflow.functions.stopwords import ENGLISH

    docs = {
        i: [w for w in re.split(r"\W+", s.lower(), flags=re.ASCII) if len(w) > 1 and w not in ENGLISH]
        for i, s in DOCS
        if s and s.strip(" ")
    }
    df = Counter(w for words in docs.values() for w in set(words))
    return {
        (i, w): (n, round(n * math.log((len(docs) + 1) / (df[w] + 1)), 9))
        for i, words in docs.items()
        for w, n in Counter(words).items()
    }


@pytest.mark.parametrize("options", [{}, {"salts": 1}, {"salts": 5}])
def test_tfidf_equals_brute_force(spark, options):
    df = spark.createDataFrame(DOCS, "id int, text string").repartition(3)
    got = {
        (r["id"], r["term"]): (r["tf"], round(r["tfidf"], 9))
        for r in t.tfidf(df, "id", "text", **options).collect()
    }
    assert got == brute_tfidf()


def test_hashed_tfidf_agrees_with_exact_weights(spark):
    df = spark.createDataFrame(DOCS, "id int, text string")
    model = t.fit_hashed_tfidf(df, "text")
    hashed = {r["id"]: r["tfidf_vector"] for r in t.hashed_tfidf(model, df, "id", "text").collect()}
    exact: dict[int, list[float]] = {}
    for (i, _), (_, w) in brute_tfidf().items():
        exact.setdefault(i, []).append(w)
    for i, vector in hashed.items():
        assert sorted(vector.values) == pytest.approx(sorted(exact.get(i, [])))


def test_top_terms(spark):
    w = spark.createDataFrame([(1, "b", 1.0), (1, "a", 1.0), (1, "c", 0.5)], "id int, term string, tfidf double")
    assert [r["term"] for r in t.top_terms(w, "id", 2).orderBy("rank").collect()] == ["a", "b"]


def test_tfidf_moves_its_counts_once(spark):
    """The texts' counts were shuffled for the frequencies, again for the weights, and a third time for the join."""
    docs = spark.createDataFrame([(1, "b a b, a c"), (2, "xx yy xx"), (None, "xx"), (2, "yy zz"), (3, " ")], "id bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weights = t.tfidf(docs, "id", "text", stop_words=())
        got = {(r["id"], r["term"]): r["tf"] for r in weights.collect()}
        lines = plan_text(weights).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(2, "xx"): 2, (2, "yy"): 2, (2, "zz"): 1, (None, "xx"): 1}
    made = [x for before, x in zip(lines, lines[1:]) if "ShuffleQueryStage" in before and "ReusedExchange" not in x]
    assert sum("REPARTITION_BY_COL" in x for x in made) == 1
    assert not any("hashpartitioning(id" in x for x in made)
