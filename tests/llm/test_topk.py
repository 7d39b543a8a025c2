from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from impactflow.llm import topk
from impactflow.plans.inspect import plan_text
from impactflow.llm.topk import maxscore, top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    out = set()
    vecs = [
        (i, np.floor(1024 * np.asarray(v, np.float32).astype(float)).astype(int))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = max((len(v) for _, v in vecs), default=0)
    vecs = [(i, np.pad(v, (0, width - len(v)))) for i, v in vecs]
    for i, q in vecs:
        if i % every == 0:
            best = sorted((-int(q @ v), j) for j, v in vecs if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


def test_against_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 37)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(20)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 20) for i in range(60)]  # ties
    rows += [(2000, None), (2010, [1.0, None]), (2020, [float("nan")]), (2030, [float("inf")]), (2040, []), (2050, [1.0]), (None, [1.0])]
    rnd.shuffle(rows)
    got = {tuple(r) for r in top_k(docs_of(rows, SCHEMA), F.col("vec_id") % 10 == 0).collect()}
    assert got == brute(rows, 10, 10)


def test_few_rows_repeats_and_none(docs_of):
    rows = [(0, [1.0]), (1, [1.0]), (1, [1.0])]
    got = top_k(docs_of(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1 << 20), (0, 2, 1, 1 << 20)]
    assert top_k(docs_of([], SCHEMA), F.col("vec_id") == 0).collect() == []
    assert top_k(docs_of([(5, [1.0])], SCHEMA), F.col("vec_id") == 0).collect() == []


def test_maxscore_is_exact():
    rng = np.random.default_rng(4)
    table = rng.integers(-50, 50, (500, 16))
    table[100:140] = table[100]
    ids = rng.permutation(500)
    for _ in range(50):
        q = rng.integers(-50, 50, 16)
        i, s = maxscore(q, 3, ids, table, table.min(0), table.max(0), 10)
        want = sorted((-int(v @ q), int(j)) for j, v in zip(ids, table, strict=True) if j != 3)[:10]
        assert [(-int(b), int(a)) for a, b in zip(i, s, strict=True)] == want


def test_components_beyond_32_bits(docs_of):
    rows = [(i, [(-1.0) ** i * 3e6 * (i + 1) if i % 10 else i + 1.0, 0.5]) for i in range(30)]
    schema = "vec_id long, embedding array<double>"
    got = {tuple(r) for r in top_k(docs_of(rows, schema), F.col("vec_id") % 10 == 0).collect()}
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = set()
    for i, q in whole:
        if i % 10 == 0:
            best = sorted((-(q[0] * v[0] + q[1] * v[1]), j) for j, v in whole if j != i)[:10]
            want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert got == want


def test_a_bar_leaves_out_only_what_is_below():
    rng = np.random.default_rng(5)
    table = rng.integers(-9, 9, (300, 8)).astype(np.int32)
    ids = np.arange(300)
    for bar in (-50, 40, 120, 10_000):
        q = rng.integers(-9, 9, 8)
        i, s = maxscore(q, -1, ids, table, table.min(0).astype(int), table.max(0).astype(int), 10, bar)
        every = sorted((-int(v.astype(int) @ q), int(j)) for j, v in zip(ids, table, strict=True))[:10]
        assert [(-int(b), int(a)) for a, b in zip(i, s, strict=True) if b >= bar] == [e for e in every if -e[0] >= bar]


def test_vectors_are_not_copied_for_blocks_of_queries(docs_of, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rows = [(i, [float(i), 1.0]) for i in range(200)]
    df = docs_of(rows, SCHEMA).withColumns({"block": F.lit("x"), "shard_group": F.lit(0), "rank": F.lit(1)})
    out = top_k(df, F.col("vec_id") % 5 == 0)
    text = plan_text(out, "formatted")
    assert text.count("+- Generate") + text.count("* Generate") <= 1  # query blocks only
    assert {tuple(r) for r in out.collect()} == brute(rows, 5, 10)
