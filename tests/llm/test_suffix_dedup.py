from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from impactflow.llm import suffix_dedup as S
from impactflow.llm.common import bytes_of

SF = "/root/testdata/sf0.001"


def brute(rows, length=50):
    """(n_bytes, n_removed, n_spans, kept) of each row, from a table of all strings."""
    first = {}
    for i, t in rows:
        order = (i is None, i or 0)
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            if s not in first or order < first[s]:
                first[s] = order
    out = []
    for i, t in rows:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < (i is None, i or 0):
                gone[p + 1 : p + 1 + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)
        out.append((i, len(t), int(gone.sum()), runs, kept))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(60)] + ["é", "日本", "a", "the", "of the"]

    def prose(n):
        return " ".join(rnd.choices(words, k=n))

    passages = [prose(rnd.randint(8, 60)) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            p = rnd.choice(passages)
            if rnd.random() < 0.5:
                a = rnd.randint(0, len(p) - 1)
                p = p[a : a + rnd.randint(20, 120)]
            parts += [prose(rnd.randint(0, 12)), p]
        texts.append("".join(parts))
    texts += [texts[3]] * 6 + ["a" * n for n in (49, 50, 51, 300)] + ["ab" * 100, "", None, "\x00" * 120, "\x00" * 60]
    texts += [texts[5] + texts[5], "x" * 49 + texts[7]]
    rnd.shuffle(texts)
    return [(i * 2 + 1, t) for i, t in enumerate(texts)]


def collected(out):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed,batch", [(1, 1 << 17), (2, 300)])
def test_against_all_strings(docs_of, monkeypatch, seed, batch):
    rows = corpus(seed)
    monkeypatch.setattr(S, "SLICE_BYTES", 3000)
    monkeypatch.setattr(S, "ENTRIES", 500 if seed == 2 else 1 << 20)
    monkeypatch.setattr(S, "FRAGMENTS", 200 if seed == 2 else 1 << 17)
    out = S.remove_repeats(docs_of(rows).repartition(4), batch=batch)
    assert collected(out) == brute([(i, (t or "").encode()) for i, t in rows])
    for r in out.collect():
        body = (r.text or "").encode()
        gone = sum(s.end - s.start for s in r.spans)
        assert gone == r.n_removed and len(r.spans) == r.n_spans and len(body) - gone == len(r.kept)


def test_repeats_nulls_and_clashes(docs_of):
    p = "".join(random.Random(1).choices("abcdefgh ", k=80))
    rows = [(2, p, 1), (2, p, 2), (2, "x" + p, 3), (None, p + "y", 4), (None, "q" * 60 + p, 5), (1, p[:49], 6), (7, p, 7)]
    df = docs_of(rows, "doc_id long, text string, Kept int")
    assert collected(S.remove_repeats(df)) == brute([(i, t.encode()) for i, t, _ in rows])
    assert S.remove_repeats(docs_of([])).collect() == []
    assert [r.n_removed for r in S.remove_repeats(docs_of([(1, None), (2, "")])).collect()] == [0, 0]


def test_fragments_cover_every_string_once(monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 700)
    texts = [t for _, t in corpus(3)]
    data, ends = bytes_of(pa.array(texts))
    first, last, key = S.fragments(data, ends)
    covered = [p for a, b in zip(first.tolist(), last.tolist(), strict=True) for p in range(a, b + 1)]
    want = [p for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True) for p in range(a, b - 49)]
    assert covered == want
    by = {}  # equal strings have equal anchors
    whole = data.tobytes()
    for a, b, k in zip(first.tolist(), last.tolist(), key.tolist(), strict=True):
        for p in range(a, b + 1):
            assert by.setdefault(whole[p : p + 50], k) == k


def test_family_levels():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 2, (4000, 4), np.uint8).repeat(2, axis=1).copy()
    doc = np.sort(rng.integers(0, 3000, 4000))
    strings = rows.view("V8").ravel()
    first = {}
    family, got = S.Family(), []
    for a in range(0, 4000, 250):
        got.append(family.add(strings[a : a + 250], doc[a : a + 250]))
        assert len(family.levels) == bin(a // 250 + 1).count("1")
    want = [first.setdefault(bytes(s), d) < d for s, d in zip(strings, doc, strict=True)]
    assert np.concatenate(got).tolist() == want


def test_strings_that_fill_the_batches(docs_of):
    rnd = random.Random(9)
    p = "".join(rnd.choices("abcdefgh", k=90))
    rows = [(i, "%s%s%s" % (chr(105 + i), p, chr(115 + i))) for i in range(5)]
    want = brute([(i, t.encode()) for i, t in rows])
    # Whatever number of strings a bucket has, batches of one string end with its last one.
    for batch in (1, 2, 3):
        assert collected(S.remove_repeats(docs_of(rows).repartition(2), batch=batch)) == want


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {i: (n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in brute([(i, (t or "").encode()) for i, t in docs])}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.op8_suffix_dedup(spark, SF).collect()}
    assert got == want and any(r for _, r, _, _ in want.values())
