from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken

import corpus_pipeline as P
from impactflow.llm.bpe import PATTERN, RANKS
from tests.llm.test_exact_dedup import low
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_mixing import water

SF = "/root/testdata/sf0.001"


def words(text):
    return len([w for w in (text or "").encode().split() if w])


def run_stages(spark, docs, folder):
    outs = []
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        outs.append(docs)
    return outs


def check_stages(docs, outs):
    rows = [r.asDict() for r in docs.collect()]
    known, exact, near, mixed = ([r.asDict() for r in x.collect()] for x in outs[:4])
    key = lambda r: tuple(map(str, r.values()))
    for out in outs[:4]:
        assert out.columns == docs.columns
    # Language: what is left is a part of the input and has letters.
    assert not Counter(map(key, known)) - Counter(map(key, rows))
    assert all(any(c.isalpha() for c in r["text"] or "") for r in known)
    # Exact copies: the smallest identifier of each text.
    groups = defaultdict(list)
    for r in known:
        groups[low(r["text"])].append(r["doc_id"])
    want = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert {low(r["text"]): r["doc_id"] for r in exact} == want and len(exact) == len(want)
    # Near copies: the smallest identifier of each component.
    comps = components([(r["doc_id"], r["text"]) for r in exact])
    assert sorted(str(r["doc_id"]) for r in near) == sorted(
        str(r["doc_id"]) for r in exact if r["doc_id"] is None or comps[r["doc_id"]][1] == r["doc_id"])
    # The mix: whole documents, at most three times, near the targets.
    count = Counter(map(key, mixed))
    assert set(count) <= set(map(key, near)) and max(count.values(), default=0) <= 3
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in near:
        sizes[r["source"]] += words(r["text"])
    for r in mixed:
        taken[r["source"]] += words(r["text"])
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    for s, t in zip(order, water([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True):
        assert abs(taken[s] - t) <= max(10, 0.02 * t), s
    # Tokens: the library's, and back to the text.
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in mixed:
        ids = np.asarray(library.encode_ordinary(r["text"]), "<u4")
        want[r["doc_id"], r["source"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
             hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in outs[4].collect()) == want
    return known


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs = run_stages(spark, docs, tmp_path)
    known = check_stages(docs, outs)
    assert len(known) >= 0.98 * docs.count()  # clean documents stay
    last = Counter(map(tuple, outs[4].collect()))
    assert Counter(map(tuple, P.run(spark, SF).collect())) == last


def test_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, SIZE string"
    rows = [(i, f"the cat and the dog {i} sat on mat {i}", "en", "s%d" % (i % 2), 9, "x") for i in range(30)]
    rows += [(100 + i, f"der hund und die katze {i} ist da {i}", "de", None, None, None) for i in range(30)]
    rows += [(200, None, "en", "s0", 0, "x"), (201, "", None, None, 0, "x"), (202, "%% 12", "en", "s0", 0, "x")]
    rows += [(1, rows[1][1], "en", "s1", 9, "x"), (None, "THE cat and the dog 1 sat on mat 1", None, "s0", 1, "x")]
    rows += [(None, "the dog and a cat are not here today", "en", None, 1, "x"), (300, "the cat " * 40_000, "en", "s0", 1, "x")]
    docs = spark.createDataFrame(rows, schema)
    check_stages(docs, run_stages(spark, docs, tmp_path))


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert [x.count() for x in run_stages(spark, docs, tmp_path)] == [0] * 5


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_names(name):
    assert name.isidentifier()


def moved_bytes(df):
    """Bytes that the last job of a table moves between its stages."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
            continue
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("dataSize").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("stage", [P.drop_exact_copies, P.drop_near_copies])
def test_dedup_moves_only_what_goes(spark, tmp_path, stage):
    """The texts that stay are not moved to be joined with the decisions, and not written to scratch either."""
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(300)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, (texts[i] + " end").upper() if stage is P.drop_near_copies else texts[i].upper(), "en", "s", 1) for i in range(6)]
    rows += [(7, texts[7], "en", "s", 2)] * 2 + [(None, texts[8], "en", "s", 1), (8000, None, None, "s", 0), (8001, "", None, "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # as at size, where no list of decisions is small enough
    try:
        out = stage(spark, docs, SF)
        got = Counter(r.doc_id for r in out.collect())
        moved = moved_bytes(out)
    finally:
        spark.conf.set(name, before)
    want = Counter(range(300)) + (Counter([8000]) if stage is P.drop_exact_copies else Counter([7, 7, None, 8000, 8001]))
    assert got == want
    assert moved < sum(len(t) for t in texts) / 4
