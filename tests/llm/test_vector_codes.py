from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from impactflow.llm import vector_codes
from impactflow.llm.vector_codes import _CENTRE, _CHILD, _HI, _KIDS, _LO, _RADIUS, _SUMS, compress, cover_tree, decompress, train, walk
from impactflow.llm.vectors import LARGEST

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, k=16, rounds=6):
    """Plain Lloyd with all distances in Python numbers."""
    kept = [
        (i, [max(-LARGEST, min(LARGEST, int(np.floor(4096 * float(np.float32(x)))))) for x in v], z)
        for i, v, z in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    each = width // parts
    kept = [(i, v + [0] * (width - len(v)), z) for i, v, z in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[r[1][p * each : (p + 1) * each] for r in order[:k]] for p in range(parts)]

    def nearest(p, v):
        own = v[p * each : (p + 1) * each]
        return min((sum((a - b) ** 2 for a, b in zip(own, e, strict=True)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for _, v, _ in kept:
                members[nearest(p, v)[1]].append(v[p * each : (p + 1) * each])
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e for e, m in zip(books[p], members, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, z in kept:
        found = [nearest(p, v) for p in range(parts)]
        out.append((i, z, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    totals = {}
    for _, z, _, d in out:
        totals[z] = totals.get(z, 0) + d
    return sorted((i, z, code, d, totals[z], digest) for i, z, code, d in out if i is not None), [r for r in out if r[0] is None]


def got(df, **options):
    rows = [tuple(r) for r in compress(df, **options).collect()]
    return sorted(r for r in rows if r[0] is not None), [r[:4] for r in rows if r[0] is None]


def test_against_brute_force(docs_of, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 70)
    monkeypatch.setattr(vector_codes, "LEAF", 3)
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 0.3) for _ in range(16)] for _ in range(12)]
    rows = [(i, [c + rnd.gauss(0, 0.05) for c in rnd.choice(centres)], rnd.choice([None, 1, 2])) for i in range(300)]
    rows += [(1000 + i, [0.25] * 16, 7) for i in range(150)]  # one vector many times
    rows += rows[:20]  # repeated rows
    rows += [(2000, None, 1), (2001, [1.0, None] * 8, 1), (2002, [float("nan")] * 16, 1), (2003, [float("inf")] + [0.0] * 15, 1)]
    rnd.shuffle(rows)
    assert got(docs_of(rows, SCHEMA).repartition(3)) == brute(rows)


def test_ragged_huge_and_null_identifiers(docs_of):
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(rnd.randrange(0, 10))], i % 2) for i in range(40)]
    rows += [(50, [1e30] * 9, 0), (51, [-1e30, 1e30] + [0.0] * 7, 0), (None, [0.5] * 9, None), (50, [0.1], 3)]
    assert got(docs_of(rows, SCHEMA)) == brute(rows)


def test_fewer_vectors_than_entries_ties_and_empty(docs_of):
    rows = [(3, [0.5] * 8, 1), (1, [0.5] * 8, 1), (2, [-0.5] * 8, None)]
    assert got(docs_of(rows, SCHEMA)) == brute(rows)
    assert {r["code"] for r in compress(docs_of(rows, SCHEMA)).collect()} == {"00" * 8, "01" * 8}
    for none in ([], [(1, None, 1), (2, [None], 2)]):
        out = compress(docs_of(none, SCHEMA))
        assert out.collect() == [] and out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_clashing_columns_and_doubles(docs_of):
    df = docs_of([(i, [i / 8.0] * 8, i % 2) for i in range(20)], "vec_id long, embedding array<double>, label int")
    df = df.withColumn("code", F.lit("x")).withColumn("error", F.lit(1)).withColumn("id", F.lit(2)).withColumn("v", F.lit(3)).withColumn("of", F.lit(4))
    assert got(df) == brute([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])


def test_decompress_gives_the_entries(docs_of):
    rows = [(i, [0.25 * (i % 4)] * 16, 0) for i in range(30)]
    df = docs_of(rows, SCHEMA)
    books, _ = train(df)
    back = {r["vec_id"]: r for r in decompress(compress(df), books).collect()}
    for i, v, _ in rows:
        assert back[i]["decoded"] == v and back[i]["error"] == 0


def test_cover_tree_and_walk():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(-400, 400, (700, 5)), np.full((200, 5), 17), rng.integers(-3, 3, (100, 5))])
    order, nodes = cover_tree(points)
    assert sorted(order) == list(range(len(points)))
    settled = 0
    for n in nodes:
        own = points[order[n[_LO] : n[_HI]]]
        radius = n[_RADIUS : _RADIUS + 1].copy().view(float)[0]
        assert (n[_SUMS:] == own.sum(axis=0)).all()
        assert np.sqrt(((own - points[n[_CENTRE]]) ** 2).sum(axis=1)).max() <= radius + 1e-9
        if n[_KIDS]:
            below = nodes[n[_CHILD] : n[_CHILD] + n[_KIDS]]
            assert below[0][_LO] == n[_LO] and below[-1][_HI] == n[_HI] and (below[1:, _LO] == below[:-1, _HI]).all()
            assert (below[:, _RADIUS].copy().view(float) <= radius / 2).all()
            centres = points[below[:, _CENTRE]].astype(float)
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2)) + 1e9 * np.eye(len(centres))
            assert (apart > radius / 2).all()
    entries = np.concatenate([rng.integers(-400, 400, (14, 5)), np.full((2, 5), 17)])
    want = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    found = np.full(len(points), -1)
    for which, entry, subtrees in walk(points, order, nodes, entries):
        for w, e in zip(which, entry, strict=True):
            members = order[nodes[w, _LO] : nodes[w, _HI]] if subtrees else [w]
            assert (found[members] == -1).all()
            found[members] = e
            settled += len(members) > 1
    assert (found == want).all() and settled > 0
