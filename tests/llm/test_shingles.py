from __future__ import annotations

import random
import re

import pyarrow as pa

from impactflow.llm.common import bytes_of
from impactflow.llm import shingles
from impactflow.llm.shingles import same_shingles, shingle_sets


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_same_equalities_as_the_words():
    rnd = random.Random(3)
    texts = [None, "", " \t", "a", "A", "a b", "b a", "a b c d", "é É", "a b c d e", "a b c d e f"]
    texts += [" ".join(rnd.choices(["a", "B", "cc", "Ccc", "é"], k=rnd.randint(1, 40))) for _ in range(300)]
    texts += ["x y \x1cz", "ab", "a  b\nc\td\x0be\x0cf", "w " * 5000]
    tokens, at = shingle_sets(*bytes_of(pa.array(texts)))
    for i, t in enumerate(texts):
        got, want = tokens[at[i] : at[i + 1]].tolist(), brute(t)
        assert len(got) == len(set(got)) == len(want) and got == sorted(got)
        for other in range(0, i, 7):
            mine = set(tokens[at[other] : at[other + 1]].tolist())
            assert len(mine & set(got)) == len(brute(texts[other]) & want)
    assert [len(x) for x in shingle_sets(*bytes_of(pa.array([], pa.string())))] == [0, 1]


def thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_complementary_words_are_different():
    for bits in (3, 8, 10, 12, 17):
        a, b = thue_morse(bits)
        tokens, at = shingle_sets(*bytes_of(pa.array([a, b, a])))
        assert at.tolist() == [0, 1, 2, 3] and tokens[0] == tokens[2] != tokens[1]


def test_words_over_several_blocks(monkeypatch):
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choices("abC", k=rnd.choice([1, 3, 40, 200]))) for _ in range(rnd.randint(0, 90))) for _ in range(20)]
    whole = shingle_sets(*bytes_of(pa.array(texts)))
    monkeypatch.setattr(shingles, "BLOCK", 64)
    parts = shingle_sets(*bytes_of(pa.array(texts)))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_counts_on_words():
    rnd = random.Random(5)
    for _ in range(200):
        a, b = (" ".join(rnd.choices(["x", "Y", "\x1c", "é"], k=rnd.randint(0, 30))) for _ in range(2))
        assert same_shingles(a.encode(), b.encode()) == (len(brute(a)), len(brute(b)), len(brute(a) & brute(b)))
