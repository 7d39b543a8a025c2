from __future__ import annotations

import random
from collections import Counter

import pytest

from impactflow.llm import listed as L

SCHEMA = "a long, b string, text string"


def taken_out(rows, names):
    """What is left, by the names alone: rows that are not listed, and one of each name that has one_stays."""
    want = Counter((a, b) for a, b, _ in rows if (a, b) not in names)
    want.update({name: 1 for name, one in names.items() if one and any((a, b) == name for a, b, _ in rows)})
    return want


@pytest.mark.parametrize("most", [1, 2, 1 << 18])
def test_against_plain_python(spark, monkeypatch, most):
    """With one word nearly all rows pass the filter, with enough words few do; the result is the same."""
    monkeypatch.setattr(L, "WORDS", most)
    rnd = random.Random(3)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, "", "x", "y"]), f"t{i}") for i in range(400)]
    names = {(a, b): rnd.random() < 0.4 for a, b, _ in rnd.sample(rows, 60)}
    names |= {(999, "x"): True, (None, None): True, (None, "x"): False}
    df = spark.createDataFrame(rows, SCHEMA)
    listed = spark.createDataFrame([(*k, v) for k, v in names.items()], "a long, b string, one_stays boolean")
    out = L.without_listed(df, listed, ["a", "b"])
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    assert not Counter(got) - Counter(rows)
    assert Counter((a, b) for a, b, _ in got) == taken_out(rows, names)
    picked = L.only_listed(df, listed, ["a", "b"]).collect()
    assert Counter(map(tuple, picked)) == Counter(r for r in rows if r[:2] in names)


def test_empty(spark):
    df = spark.createDataFrame([(1, "x", "t"), (None, None, None)], SCHEMA)
    listed = spark.createDataFrame([], "a long, b string, one_stays boolean")
    assert Counter(map(tuple, L.without_listed(df, listed, ["a", "b"]).collect())) == {(1, "x", "t"): 1, (None, None, None): 1}
    some = spark.createDataFrame([(1, "x", True)], "a long, b string, one_stays boolean")
    assert L.without_listed(df.limit(0), some, ["a", "b"]).collect() == []
