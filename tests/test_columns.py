"""Expressions on literal rows, edge cases first."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from impactflow.functions import columns as c
from impactflow.functions.stopwords import ENGLISH

D = datetime.date


def evaluate(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


CASES = {
    "clean_text": (
        c.clean_text,
        ["\t Hello \n", None, "", "\x1c\xa0　a b \x85", "   "],
        ["Hello", "", "", "a b", ""],
    ),
    "split_categories": (
        c.split_categories,
        ["  cs.AI   cs.LG ", "", None, "a\tb c"],
        [["cs.AI", "cs.LG"], [], [], ["a", "b", "c"]],
    ),
    "parse_rfc_date": (
        c.parse_rfc_date,
        [
            "Mon, 2 Apr 2007 19:18:42 GMT",
            "Sat, 31 Mar 2007 23:30:00 -0500",
            "12 Apr 2007 00:00:00 GMT",
            "garbage",
            "",
            None,
        ],
        [D(2007, 4, 2), D(2007, 4, 1), D(2007, 4, 12), None, None, None],
    ),
    "parse_iso_date": (
        c.parse_iso_date,
        ["2024-02-29", "2023-02-29", "not a date", None],
        [D(2024, 2, 29), None, None, None],
    ),
    "epoch_to_iso": (
        c.epoch_to_iso,
        ["1720000000", "0", "-1", "1720000000.9", "x", None, "99999999999999"],
        [
            "2024-07-03T09:46:40Z",
            "1970-01-01T00:00:00Z",
            "1969-12-31T23:59:59Z",
            "2024-07-03T09:46:40Z",
            None,
            None,
            None,
        ],
    ),
    "to_number": (
        c.to_number,
        ["1.5", "x", None, "NaN", "-3", ""],
        [1.5, 0.0, 0.0, 0.0, -3.0, 0.0],
    ),
    "to_count": (
        c.to_count,
        ["7", "abc", None, "1.9", "9007199254740993"],
        [7, 0, 0, 1, 9007199254740993],
    ),
    "normalize_doi": (
        c.normalize_doi,
        [
            "https://doi.org/10.1234/ABC",
            "http://doi.org/10.1234/ABC",
            "doi:10.1234/ABC",
            "HTTPS://DX.DOI.ORG/10.1/X",
            " 10.1/y ",
            "   ",
            "doi: ",
            None,
        ],
        ["10.1234/abc", "10.1234/abc", "10.1234/abc", "10.1/x", "10.1/y", None, None, None],
    ),
    "id_from_location": (
        c.id_from_location,
        [
            "pmh:oai:arXiv.org:2308.10620",
            "pmh:oai:arXiv.org:2308.10620v2",
            "pmh:oai:arXiv.org:cs/0112017",
            "pmh:oai:arXiv.org: ",
            "pmh:other",
            None,
        ],
        ["2308.10620", "2308.10620", "cs/0112017", None, None, None],
    ),
    "id_from_url": (
        c.id_from_url,
        [
            "https://arxiv.org/abs/2301.10226",
            "https://arxiv.org/pdf/2301.10226.pdf",
            "https://arxiv.org/pdf/2301.10226v2.pdf?x=1#p",
            "http://arxiv.org/abs/CS/0112017",
            "https://arxiv.org/abs/2301.10226/",
            "https://example.com/x",
            "",
            None,
        ],
        ["2301.10226"] * 3 + ["cs/0112017", "2301.10226/", None, None, None],
    ),
    "normalize_key": (c.normalize_key, [" AbC ", None], ["abc", None]),
    "fill_default": (
        lambda v: c.fill_default(v, "unknown"), [None, "article"], ["unknown", "article"]),
    "ignore_above": (lambda v: c.ignore_above(v, 3), ["abc", "abcd", None], ["abc", None, None]),
    "fold_text": (
        c.fold_text,
        [
            "Élève Straße œuvre Łódź",
            "don't e.g. 3.14 1,000 a.b a1.b2 x_y",
            "naïve—co-op (test).",
            "漢字 ひら x",
            None,
        ],
        [
            ["eleve", "strasse", "oeuvre", "lodz"],
            ["don't", "e.g", "3.14", "1,000", "a.b", "a1", "b2", "x_y"],
            ["naive", "co", "op", "test"],
            ["漢", "字", "ひ", "ら", "x"],
            [],
        ],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_expression(spark, name):
    expr, values, expected = CASES[name]
    assert evaluate(spark, expr, values) == expected


def test_url_without_trailing_slash(spark):
    urls = ["https://arxiv.org/abs/2301.10226/", "http://arxiv.org/abs/cs/0112017"]
    got = evaluate(spark, lambda v: c.id_from_url(v, strip_slash=True), urls)
    assert got == ["2301.10226", "cs/0112017"]


def test_first_version(spark):
    dtype = "array<struct<version:string,created:string>>"
    values = [[("v1", "a"), ("v2", "b")], [], None]
    assert evaluate(spark, c.first_version_created, values, dtype) == ["a", None, None]


def test_default_empty_array(spark):
    assert evaluate(spark, c.default_empty_array, [[1], None], "array<bigint>") == [[1], []]


def test_null_normalize(spark):
    got = evaluate(spark, c.null_normalize, [1.0, float("nan"), None], "double")
    assert got == [1.0, None, None]


def test_iso_time_does_not_depend_on_session_zone(spark):
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert evaluate(spark, c.epoch_to_iso, ["1720000000"]) == ["2024-07-03T09:46:40Z"]
        rfc = ["Mon, 2 Apr 2007 23:18:42 GMT"]
        assert evaluate(spark, c.parse_rfc_date, rfc) == [D(2007, 4, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_long_runs_do_not_overflow_the_matcher(spark):
    runs = ["a" * 200_000, "1.2." * 50_000, "a.b." * 50_000, "a1" * 100_000]
    assert all(len(tokens) >= 1 for tokens in evaluate(spark, c.fold_text, runs))


def test_whitespace_is_what_python_strips():
    assert set(c.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_stop_words_are_the_default_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")
