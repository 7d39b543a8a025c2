from __future__ import annotations

import base64
import random

import numpy as np
import pytest
import tiktoken

from impactflow.llm.bpe import PATTERN, RANKS, decode, encode, op7_byte_bpe, token_digests

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(5)
    words = ["it's", "they'll", "  ", " ", "\n\n", "日本語", "é", "12345", "!!", "a" * 40, "\t", "'", "ll", "🙂"]
    yield from (None, "", " ", "x" * 5000, " " * 3000, "'" * 700, "<|endoftext|> a")
    for n in (1, 30, 300, 1500):
        yield "".join(rnd.choice(words) + rnd.choice(["", " "]) for _ in range(n))


@pytest.mark.parametrize("chunk,overlap", [(64, 40), (200, 50), (1 << 16, 1 << 10)])
def test_same_as_the_library_and_back(docs_of, reference, chunk, overlap):
    rows = list(enumerate(texts()))
    out = decode(encode(docs_of(rows), decoded="again", chunk=chunk, overlap=overlap)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert np.frombuffer(r.token_ids, "<u4").tolist() == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "") and r.again == r.decoded


def test_clashes_repeats_and_nulls(docs_of):
    rows = [(1, "a b", 3, None), (1, "a b", 3, None), (None, "x" * 300, 4, None), (2, None, 5, None)]
    df = docs_of(rows, "doc_id long, text string, Token_Ids int, n string")
    out = encode(df, chunk=100, overlap=20)
    assert out.columns == ["doc_id", "text", "n", "token_ids"]
    assert sorted((str(r.doc_id), r.text or "") for r in out.collect()) == sorted(
        [("1", "a b"), ("1", "a b"), ("None", "x" * 300), ("2", "")])
    assert token_digests(docs_of([]), ["doc_id"]).collect() == []


def test_query_against_the_library(spark, reference):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op7_byte_bpe(spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = np.asarray(reference.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
