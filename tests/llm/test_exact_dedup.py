from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from impactflow.llm.exact_dedup import exact_dedup


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    pick = max if largest else min
    return {
        (i, pick(groups[low(t)]), len(groups[low(t)]), i == pick(groups[low(t)]),
         hashlib.sha256(low(t).encode()).hexdigest())
        for i, t in rows
    }


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("parts", [1, 7])
def test_groups_that_cross_partitions(docs_of, keep, parts):
    rnd = random.Random(parts)
    long = "x" * 100
    pool = ["", None, "Ab", "aB", "ÉA", "éa", long, long + "1", long.upper(), "z" * 300_000]
    rows = [(i, rnd.choice(pool) if i % 3 else "hot") for i in range(600)]
    rnd.shuffle(rows)
    out = exact_dedup(docs_of(rows), keep=keep, carry=["doc_id"], partitions=parts)
    got = {tuple(r) for r in out.collect()}
    assert got == brute(rows, keep == "largest")


def test_repeats_nulls_and_clashes(docs_of):
    rows = [(1, "a", 5, 9), (1, "A", 6, 9), (None, "a", 7, 9), (None, "q", 8, 9), (2, None, 1, 9), (3, "", 2, 9)]
    df = docs_of(rows, "doc_id long, text string, KEEP_ID long, other long")
    out = exact_dedup(df, partitions=3).collect()
    assert len(out) == 6 and set(out[0].asDict()) == {
        "doc_id", "text", "other", "keep_id", "group_size", "kept", "text_sha256"}
    kept = [(r.doc_id, low(r.text)) for r in out if r.kept]
    assert sorted(kept, key=str) == sorted([(1, "a"), (None, "q"), (2, "")], key=str)
    assert {r.group_size for r in out if low(r.text) == "a"} == {3}


def test_empty_table(docs_of):
    assert exact_dedup(docs_of([])).collect() == []
