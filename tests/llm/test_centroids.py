from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from impactflow.llm import centroids
from impactflow.llm.centroids import Bisectors, cluster
from impactflow.llm.vectors import LARGEST

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, width, k, rounds=5):
    """Plain Lloyd with all distances in Python numbers; rows as sorted text, as identifiers may be null."""
    kept = [
        (i, [max(-LARGEST, min(LARGEST, int(np.floor(256 * float(np.float32(x)))))) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        members = [[] for _ in cents]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else c for c, m in zip(cents, members, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    own = {}
    for _, d, c in found:
        own[c] = own.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(str((i, c, d, own[c], sum(own.values()), digest[c])) for i, d, c in found)


def got(df, **options):
    return sorted(str(tuple(r)) for r in cluster(df, **options).collect())


def test_against_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 50)
    rnd = random.Random(8)
    rows = [(i, [rnd.gauss(0, 0.4) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(200)] + rows[:30]
    rows += [(2000, None), (2001, [1.0] * 5), (2002, [1.0] * 7), (2003, []), (2004, [None] + [1.0] * 5), (2005, [float("nan")] * 6), (2006, [float("-inf")] * 6), (None, [0.1] * 6), (None, [0.1] * 6)]
    rnd.shuffle(rows)
    assert got(docs_of(rows, SCHEMA).repartition(3), width=6, k=12) == brute(rows, 6, 12)


def test_ties_empty_clusters_and_huge_components(docs_of):
    rows = [(i, [float(i % 2), 0.0]) for i in range(12)]  # equal first centroids: all but two clusters stay empty
    assert got(docs_of(rows, SCHEMA), width=2, k=8) == brute(rows, 2, 8)
    rows = [(1, [1e30, -1e30]), (2, [3e5, 1.0]), (3, [0.0, 0.0]), (4, [-3e5, 2.0])]
    assert got(docs_of(rows, SCHEMA), width=2, k=3) == brute(rows, 2, 3)


def test_few_none_and_clashing_columns(docs_of):
    assert got(docs_of([(5, [0.5] * 64)], SCHEMA)) == brute([(5, [0.5] * 64)], 64, 40)
    for none in ([], [(1, None), (2, [1.0])]):
        out = cluster(docs_of(none, SCHEMA))
        assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    rows = [(i, [i / 4.0, 1.0]) for i in range(30)]
    df = docs_of(rows, SCHEMA)
    for name in ("cluster", "distance", "id", "v", "inertia"):
        df = df.withColumn(name, F.lit("x"))
    assert got(df, width=2, k=4) == brute(rows, 2, 4)
    with pytest.raises(ValueError, match="64 components"):
        cluster(df, width=65)


@pytest.mark.parametrize("size", [5, 1 << 26])
def test_tournament_is_exact(size):
    rng = np.random.default_rng(size)
    x = rng.integers(-size, size, (300, 7))
    c = rng.integers(-size, size, (11, 7))
    c[7], c[9] = c[2], -c[2]
    winner, away = Bisectors(c).nearest(x)
    for v, w, d in zip(x.tolist(), winner, away, strict=True):
        assert (int(d), int(w)) == min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), j) for j, e in enumerate(c.tolist()))
