from __future__ import annotations

import itertools
import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from impactflow.llm import mixing
from impactflow.llm.mixing import allot, fit, knapsack, mix, nearest, op3_mixing, targets, word_count
from impactflow.plans.inspect import plan_text

SF = "/root/testdata/sf0.001"


def water(sizes, weights, most=3.0):
    """Targets by bisection on the level."""
    low, high = 0.0, 1e18
    for _ in range(300):
        mid = (low + high) / 2
        if sum(min(mid * w, most * s) for w, s in zip(weights, sizes, strict=True)) < sum(sizes):
            low = mid
        else:
            high = mid
    return [min(high * w, most * s) for w, s in zip(weights, sizes, strict=True)]


def test_targets_share_all_and_stop():
    rnd = random.Random(1)
    for _ in range(200):
        sizes = [rnd.choice([0, 1, 10, 1000, 50_000]) for _ in range(rnd.randint(1, 9))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        got = targets(sizes, weights)
        assert np.allclose(got, water(sizes, weights), rtol=1e-6, atol=1e-3)
        assert abs(sum(got) - sum(sizes)) < 1e-6 * (1 + sum(sizes))
    assert targets([], []) == []


def test_knapsack_against_all_subsets():
    rnd = random.Random(2)
    for _ in range(100):
        n = rnd.randint(1, 4)
        lengths = np.array(rnd.sample(range(1, 12), n))
        counts = np.array([rnd.randint(0, 4) for _ in range(n)])
        budget = rnd.randint(0, 60)
        sums = [int(np.dot(c, lengths)) for c in itertools.product(*(range(k + 1) for k in counts))]
        take = knapsack(lengths, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        assert abs(int(take @ lengths) - budget) == min(abs(s - budget) for s in sums)


def test_fit_of_large_budgets():
    rng = np.random.default_rng(3)
    lengths, counts = np.unique(rng.lognormal(6, 1, 20_000).astype(int), return_counts=True)
    total = int(lengths @ counts)
    for budget in (0, 1, 999, total // 3, total - 5, total, total + 9):
        take = fit(lengths, counts, budget, window=5000)
        assert (take <= counts).all() and (take >= 0).all()
        assert abs(min(budget, total) - int(take @ lengths)) <= 4


def test_few_very_long_documents():
    # One document of 200,000 words and a target of 380,000: two copies, as with 20,000 and 38,000.
    for size in (20_000, 200_000, 2_000_000):
        passes, chosen = allot(np.array([size]), np.array([1]), size * 19 // 10, size, 3)
        assert passes + chosen.tolist()[0] == 2
    rnd = random.Random(6)
    for _ in range(150):  # all numbers of copies, from 0 to 3 of each; nothing is taken as a share in any pass
        n = rnd.randint(1, 4)
        lengths = np.array(sorted(rnd.sample(range(66_000, 400_000), n)))
        counts = np.ones(n, np.int64)
        whole = int(lengths.sum())
        target = rnd.randint(1, 3 * whole)
        passes, chosen = allot(lengths, counts, target, whole, 3)
        copies = passes + chosen
        assert (copies >= 0).all() and (copies <= 3).all()
        sums = [int(np.dot(c, lengths)) for c in itertools.product(range(4), repeat=n)]
        assert abs(int(copies @ lengths) - target) == min(abs(s - target) for s in sums)


def test_greedy_filling_is_not_in_the_way():
    lengths, counts = np.array([150_000, 200_000]), np.array([2, 1])
    # Shares of 0 and 0: the longest first would leave 100,000 words that nothing fits.
    assert fit(lengths, counts, 300_000, window=1000).tolist() == [2, 0]
    # A budget above every window, documents longer than what is left.
    assert fit(np.array([140_000]), np.array([2]), 139_000).tolist() == [1]


def test_thousands_of_long_lengths_in_bounded_time():
    rng = np.random.default_rng(7)
    for n, step in ((800, 1), (10_000, 1), (10_000, 1000)):
        lengths = np.sort(rng.choice(np.arange(100_000 // step, (1_000_000 if step == 1 else 20_000_000) // step), n, False)) * step
        if step > 1:
            lengths[n // 2] += 1  # one length keeps the divisor at 1
        counts = np.ones(n, np.int64)
        whole = int(lengths.sum())
        for target in (whole // 3 + 1, whole * 19 // 10):
            tracemalloc.start()
            start = time.time()
            passes, chosen = allot(lengths, counts, target, whole, 3)
            took, (_, peak) = time.time() - start, tracemalloc.get_traced_memory()
            tracemalloc.stop()
            assert took < 60 and peak < 1 << 30, (n, step, took, peak)
            copies = passes + chosen
            assert (copies >= 0).all() and (copies <= 3).all()
            assert abs(int(copies @ lengths) - target) <= (0 if step == 1 else step)


def test_open_documents_come_as_near_as_all(monkeypatch):
    rnd = random.Random(8)
    monkeypatch.setattr(mixing, "OPEN", 2)
    for trial in range(200):
        n = rnd.randint(1, 6)
        lengths = np.array(rnd.sample(range(1, 60), n))
        counts = np.array([rnd.randint(0, 3) for _ in range(n)])
        budget = rnd.randint(0, 200)
        sums = [int(np.dot(c, lengths)) for c in itertools.product(*(range(k + 1) for k in counts))]
        off = min(abs(s - budget) for s in sums)
        take = nearest(lengths, counts, budget)
        assert abs(int(take @ lengths) - budget) == off
        if trial % 2:  # all the way up from few open ones to all
            with monkeypatch.context() as m:
                real = mixing._cost
                m.setattr(mixing, "_cost", lambda a, c, b, counts=counts: 2.0 if (c == counts).all() and b == budget else real(a, c, b))
                take = nearest(lengths, counts, budget)
            assert (take <= counts).all() and (take >= 0).all()


def check(rows, out, most=3):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["words"]
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    want = dict(zip(order, water([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True))
    taken = defaultdict(int)
    for r in out:
        assert r.taken <= most * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
        taken[r.source] += r.taken
    return taken, want


def test_small_tables(docs_of):
    rnd = random.Random(4)
    rows = [
        dict(doc_id=i, source=rnd.choice(["a", "b", "É", "", None]), words=rnd.choice([0, 1, 7, 30, 30, 90]), SIZE="x")
        for i in range(400)
    ] + [dict(doc_id=1000 + i, source="hot", words=30, SIZE="x") for i in range(900)]
    rows += [dict(doc_id=None, source="hot", words=30, SIZE="y")] * 20
    df = docs_of([tuple(r.values()) for r in rows], "doc_id long, source string, words long, SIZE string")
    out = mix(df, F.col("words"), ["doc_id"]).collect()
    assert Counter((r.doc_id, r.source) for r in out) == Counter((r["doc_id"], r["source"]) for r in rows)
    taken, want = check(rows, out)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 30, (s, taken[s], t)
    again = mix(df.repartition(3), F.col("words"), ["doc_id"]).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))
    none = docs_of([], "doc_id long, source string, words long")
    assert mix(none, F.col("words"), ["doc_id"]).collect() == []
    empty = docs_of([(1, "a", 0)], "doc_id long, source string, words long")
    assert [(r.target, r.taken) for r in mix(empty, F.col("words"), ["doc_id"]).collect()] == [(0.0, 0)]


def test_word_count(docs_of):
    texts = ["", None, " a\tb\x0bc\x0cd\r\ne ", "\x1c x", "a b  ", "\x00", "z " * 50_000]
    df = docs_of(list(enumerate(texts)))
    got = {r.doc_id: r.n for r in df.select("doc_id", word_count().alias("n")).collect()}
    assert got == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [dict(source=r.source, words=len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs]
    by_id = {r.doc_id: (r.source, w["words"]) for r, w in zip(docs, rows, strict=True)}
    out = op3_mixing(spark, SF)
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = out.collect()
    assert {r.doc_id: r.size for r in got} == {i: w for i, (_, w) in by_id.items()}
    sums, target = defaultdict(int), {}
    for r in got:
        sums[by_id[r.doc_id][0]] += r.taken
        target[by_id[r.doc_id][0]] = r.target
    want = water(*zip(*[(sum(w["words"] for w in rows if w["source"] == s), (5, 2, 1)[i % 3]) for i, s in enumerate(sorted(target))], strict=True))
    for s, t in zip(sorted(target), want, strict=True):
        assert abs(target[s] - t) < 1e-3 and abs(sums[s] - t) <= 10


def test_the_sources_table_needs_no_python_workers(spark):
    """A list of rows would come as an RDD, which each executor pickles in a second kind of Python workers."""
    docs = spark.range(0, 200).selectExpr("id AS doc_id", "if(id % 4 = 3, NULL, concat('s', id % 4)) AS source", "id % 7 AS words")
    mixed = mix(docs, F.col("words"), ["doc_id"])
    plan = plan_text(mixed)
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan
    sums = mixed.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("n")).collect()
    assert len(sums) == 4 and all(abs(r.t - r.n) < 1 for r in sums)
