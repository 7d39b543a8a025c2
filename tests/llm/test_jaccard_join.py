from __future__ import annotations

import random

import numpy as np
import pytest

from impactflow.llm import jaccard_join as J
from tests.llm.test_shingles import brute as shingles
from tests.llm.test_shingles import thue_morse

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Components by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 0.8 <= len(x) / len(y) <= 1.25:
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    r, s = sorted((find(a), find(b)))
                    parent[s] = r
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rnd, words, rate):
    return [w if rnd.random() > rate else rnd.choice(["new", "x%d" % rnd.randint(0, 99)]) for w in words]


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    passage = rnd.choices(vocabulary, k=40)
    rows = []
    for _ in range(60):
        base = rnd.choices(vocabulary, k=rnd.choice([3, 5, 6, 8, 9, 12, 20, 60, 200, 700]))
        if rnd.random() < 0.5:
            at = rnd.randint(0, len(base))
            base[at:at] = passage
        for _ in range(rnd.choice([1, 1, 2, 5])):
            rate = rnd.choice([0, 0.002, 0.01, 0.03, 0.05])
            rows.append(" ".join(edited(rnd, base, rate)))
            if rnd.random() < 0.3:  # near the threshold by length
                rows.append(" ".join(base[: int(len(base) * rnd.uniform(0.75, 0.9))]))
    chain = rnd.choices(vocabulary, k=104)
    for i in range(12):  # neighbours are similar, the ends are not
        rows.append(" ".join(chain[i * 4 :]) + " " + " ".join(vocabulary[: i * 4]))
    hot = rnd.choices(vocabulary, k=150)
    rows += [" ".join(edited(rnd, hot, rnd.choice([0.005, 0.02, 0.04, 0.06]))) for _ in range(60)]
    # Copies of copies: linked to each other, not to the first.
    for _ in range(4):
        branch = edited(rnd, hot, 0.05)
        rows += [" ".join(edited(rnd, branch, 0.01)) for _ in range(9)]
    rows += ["a b c d e f"] * 3 + ["A b c d e f g"] * 2 + ["", None, " \t", "one", "One", "a b c", "w " * 9000]
    rnd.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def test_differences_of_mixed_sizes(spark):
    """Every similar pair of a hot group is found, whichever of the two need not share any by its own count."""
    rnd = random.Random(12)
    reference = list(range(72))
    sets = [set(reference)]
    # 73 shingles with 17 differences, 74 with 4, of which 3 are common; another set makes the group's top 90.
    common = [1000, 1001, 1002]
    sets.append(set(reference[8:]) | set(common) | set(range(2000, 2006)))
    sets.append(set(reference[1:]) | set(common))
    sets.append(set(reference) | set(range(3000, 3018)))
    for _ in range(120):
        out, new = rnd.randint(0, 9), rnd.randint(0, 18)
        extra = rnd.sample(range(1000, 1030), new) if new else []
        sets.append(set(rnd.sample(reference, 72 - out)) | set(extra))
    assert [len(s) for s in sets[:4]] == [72, 73, 74, 90]
    rows = [(0, i, 72, len(s), sorted(sets[0] ^ s)) for i, s in enumerate(sets) if i]
    differences = spark.createDataFrame(rows, "r long, x long, n_r long, n long, d array<long>")
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    # The members that are similar to the reference are in its component.
    labels = [(i, 0) for i, s in enumerate(sets) if near(sets[0], s)]
    with_reference = {i for i, _ in labels}
    found = J._by_differences(differences, spark.createDataFrame(labels, "node long, label long"), 80).collect()
    want = {
        (a, b)
        for b in range(1, len(sets))
        for a in range(1, b)
        if near(sets[a], sets[b]) and not {a, b} <= with_reference
    }
    assert (1, 2) in want
    assert {(r.a, r.b) for r in found} == want


@pytest.mark.parametrize("seed,hot", [(1, 32), (2, 3)])
def test_against_all_pairs(docs_of, monkeypatch, seed, hot):
    rows = corpus(seed)
    monkeypatch.setattr(J, "SLICE_BYTES", 20_000)
    df = docs_of(rows).repartition(5)
    labels = {r.node: r.label for r in J.linked_components(df, hot=hot).collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(df).collect()}
    want = brute(rows)
    assert got == want
    assert all(label == want[node][1] for node, label in labels.items())


def test_nulls_repeats_and_clashes(docs_of):
    rows = [(5, "a b c d e f", 1), (5, "a b c d e f", 2), (3, "A B c d e f", 3), (None, "a b c d e f", 4), (9, None, 5), (None, None, 6)]
    df = docs_of(rows, "doc_id long, text string, Component_ID long")
    out = J.jaccard_join(df).collect()
    assert sorted(((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out)) == sorted(
        [("5", 2, "3"), ("5", 2, "3"), ("3", 2, "3"), ("None", 2, "None"), ("9", 0, "9"), ("None", 0, "None")])
    assert J.jaccard_join(docs_of([])).collect() == []


def test_every_pair_shares_an_entry():
    """The pigeonhole for both allocations: similar sets meet in the band of the smaller one."""
    rng = np.random.default_rng(7)
    for trial in range(1500):
        n = int(rng.choice([1, 2, 3, 4, 5, 6, 8, 12, 18, 30, 70, 300]))
        common = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        x = y = common
        for _ in range(200):
            extra = rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 2)), np.uint64)
            cut = int(rng.integers(0, len(extra) + 1))
            a, b = np.unique(np.append(common, extra[:cut])), np.unique(np.append(common, extra[cut:]))
            if 100 * len(common) >= 80 * (len(a) + len(b) - len(common)):
                x, y = a, b
                break
        number = J.band_of(min(len(x), len(y)))
        assert number in J.bands_for(len(x)) and number in J.bands_for(len(y))
        for sets in (0, 10**12):
            band = J.allocate(number, sets)
            (e, f), (g, h) = J.entries_of(x, band), J.entries_of(y, band)
            shared = len(np.intersect1d(e, g))
            assert shared >= max(1, max(f, h) - J.most_different(len(x), len(y))), (trial, band)


def test_both_allocations_occur():
    assert any(J.allocate(b, 10**9).deletions for b in range(12))
    assert not any(J.allocate(b, 100).deletions for b in range(8, 30))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.op9_jaccard_join(spark, SF).collect()}
    assert got == brute([tuple(r) for r in docs])


def test_complementary_words_are_not_linked(docs_of):
    a, b = thue_morse(10)
    rows = [(1, a), (2, b), (3, f"{a} x y z w"), (4, f"{b} x y z w"), (5, a)]
    got = {r.doc_id: r.component_id for r in J.jaccard_join(docs_of(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_hot_groups_of_mixed_sizes(docs_of):
    """One passage in texts of many sizes, copies of it, and copies of copies beyond the threshold from it."""
    rnd = random.Random(21)
    passage = ["p%d" % i for i in range(60)]
    rows = []
    for _ in range(150):
        own = ["o%d" % rnd.randint(0, 10**6) for _ in range(rnd.choice([0, 0, 3, 8, 14, 20, 40]))]
        at = rnd.randint(0, len(own))
        rows.append(own[:at] + edited(rnd, passage, rnd.choice([0, 0.01, 0.03])) + own[at:])
    for _ in range(6):
        branch = edited(rnd, passage, 0.08)
        rows += [edited(rnd, branch, 0.01) for _ in range(8)]
    docs = [(i, " ".join(r)) for i, r in enumerate(rows)]
    rnd.shuffle(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(docs_of(docs)).collect()} == brute(docs)


def test_a_member_deals_out_its_differences_once_for_its_family(docs_of, monkeypatch):
    """Copies of one text are in many hot groups; the pairs with references must not grow with the number of these."""
    rnd = random.Random(31)
    base = ["b%d" % i for i in range(120)]
    docs = [(i, " ".join(edited(rnd, base, rnd.choice([0.02, 0.05, 0.08, 0.1])))) for i in range(240)]
    seen = []
    by_differences = J._by_differences

    def counted(differences, labels, percent):
        seen.append((differences.count(), differences.select("x").distinct().count()))
        return by_differences(differences, labels, percent)

    monkeypatch.setattr(J, "_by_differences", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(docs_of(docs)).collect()}
    assert got == brute(docs)
    ((pairs, members),) = seen
    assert members > 50 and pairs <= 1.5 * members


def test_texts_of_candidates_only_are_moved(docs_of, spark, monkeypatch, tmp_path):
    """The texts that are compared are picked in the scan: with lists too large to be broadcast no other text is moved."""
    from tests.llm.test_pipeline import moved_bytes

    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(200)]
    docs_of([*enumerate(texts), *((1000 + i, texts[i] + " end") for i in range(5))]).write.parquet(f"{tmp_path}/docs")
    moved = {}

    def materialise(df, purpose, made=J.materialise):
        if purpose == "jaccard-texts":
            moved[purpose] = moved_bytes(df)
        return made(df, purpose)

    monkeypatch.setattr(J, "materialise", materialise)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        out = J.jaccard_join(spark.read.parquet(f"{tmp_path}/docs"), carry=["doc_id"]).collect()
    finally:
        spark.conf.set(name, before)
    assert {r.doc_id: r.component_id for r in out} == {i: i % 1000 for i in [*range(200), *range(1000, 1005)]}
    assert moved["jaccard-texts"] < sum(map(len, texts)) / 4
