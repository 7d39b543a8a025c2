from __future__ import annotations

import random

import numpy as np
import pytest
import zstandard as zstd
from pyspark.sql import functions as F

from impactflow.llm import toxicity
from impactflow.llm.lang_id import held_out
from impactflow.llm.toxicity import Dictionaries, Model, fit, judge, learn, normalised, train, windows

RND = random.Random(4)
SYLLABLES = ["ka", "lo", "mi", "ner", "tu", "shi", "ra", "bel", "dor", "an", "is", "ou"]
BAD = ["grubnak", "vextroll", "zumpfark"]


def prose(n, bad=0, rnd=RND):
    words = ["".join(rnd.choice(SYLLABLES) for _ in range(rnd.randrange(1, 4))) for _ in range(n)]
    for _ in range(bad):
        words.insert(rnd.randrange(len(words) + 1), rnd.choice(BAD))
    return " ".join(words)


def plain_score(model: Model, text: str | None) -> float:
    """The score of one text, window by window."""
    words = []
    for w in normalised((text or "").encode()).split():
        words += [w[i : i + 64] for i in range(0, len(w), 64)] if len(w) > 65 else [w]
    gains = []
    for at in range(0, max(1, len(words) - 12 + 6), 6) if words else ():
        window = b" " + b" ".join(words[at : at + 12]) + b" "
        sizes = []
        for content in (model.dictionaries.ordinary, model.dictionaries.ordinary + model.dictionaries.toxic):
            options = zstd.ZstdCompressionParameters.from_level(toxicity.LEVEL, min_match=3, write_content_size=0, write_dict_id=0)
            known = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            sizes.append(len(zstd.ZstdCompressor(compression_params=options, dict_data=known).compress(window)))
        gains.append(sizes[0] - sizes[1])
    n = max(1, len(gains))
    x = [
        (sum(max(0, g) for g in gains) / n) ** 0.5,
        (sum(g >= model.bar for g in gains) / n) ** 0.5,
        max([0, *gains]) / 8,
        1,
    ]
    return float(1 / (1 + np.exp(-np.dot(x, model.weights))))


@pytest.fixture(scope="module")
def model():
    texts = [prose(120) for _ in range(120)] + [prose(120, 4) for _ in range(60)]
    return train([normalised(t.encode()) for t in texts], np.array([0] * 120 + [1] * 60), 1 / 3)


def test_against_plain_version(docs_of, model):
    rows = [(i, prose(RND.randrange(1, 300), i % 3)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "12 !? 34"), (103, "grubnak"), (104, "Ünï vextroll\nzumpfark"), (105, prose(30_000, 900)), (1, prose(9)), (None, "x")]
    got = judge(docs_of(rows).repartition(3), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(plain_score(model, r["text"]), abs=1e-12)
        assert r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1


def test_every_word_is_in_a_window(model):
    texts = [normalised(prose(n).encode()) for n in (1, 2, 11, 12, 13, 18, 19, 400)] + [b"", normalised(b"y" * 1000 + b" z")]
    data, spans, owner = windows(texts)
    covered = np.zeros(len(data), bool)
    for a, n in spans:
        covered[a : a + n] = True
    assert covered.all() and set(owner) == {0, 1, 2, 3, 4, 5, 6, 7, 9}
    assert max(n for (_, n), o in zip(spans, owner, strict=True) if o == 9) <= 12 * 65


def test_toxic_words_are_found_and_clean_texts_left_alone(model):
    toxic = [normalised(prose(100, 3).encode()) for _ in range(60)]
    clean = [normalised(prose(100).encode()) for _ in range(60)]
    assert (model.scores(toxic) >= 0.5).mean() > 0.95 and (model.scores(clean) >= 0.5).mean() < 0.05
    for w in BAD:
        assert w.encode()[:5] in model.dictionaries.toxic and w.encode() not in model.dictionaries.ordinary


def test_copies_of_a_passage_are_not_toxic_text():
    passage = " ".join("".join(RND.choice("bcdfghjklmnpqrstvwxyz") for _ in range(8)) for _ in range(30))
    known = learn([normalised(f"{prose(40)} {passage} {prose(40)}".encode()) for _ in range(40)], [normalised(prose(100).encode()) for _ in range(80)])
    middle = passage.split()[5:25]
    assert not any(f" {w} ".encode() in known.toxic for w in middle)


def test_fit_looks_at_no_held_out_label(docs_of):
    rows = [(i, prose(60, 3 * (i % 2))) for i in range(300)]
    docs = docs_of(rows)
    labels = docs_of([(i, i % 2) for i in range(300)], "doc_id long, toxic int").withColumn("extra", F.lit(1))
    wrong = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (fit(docs, x, ~held_out()) for x in (labels, wrong))
    assert one.dictionaries == two.dictionaries and one.bar == two.bar and (one.weights == two.weights).all()
    found = {r["doc_id"]: r["predicted"] for r in judge(docs, one).where(held_out()).collect()}
    assert np.mean([found[i] == i % 2 for i in found]) > 0.95


def test_odd_labels_and_missing_classes(docs_of):
    docs = docs_of([(1, "a b"), (2, None), (3, "c"), (3, "b"), (None, "d")])
    schema = "doc_id long, toxic int"
    assert fit(docs, docs_of([], schema), ~held_out()) == 0
    assert fit(docs, docs_of([(1, 1), (3, 1), (None, 0), (2, None), (2, 7)], schema), F.lit(True)) == 1
    assert fit(docs, docs_of([(1, 1), (9, 0)], schema), F.lit(True)) == 0.5  # the text of class 0 is missing
    assert isinstance(fit(docs, docs_of([(1, 1), (1, 0), (3, 0), (3, 0)], schema), F.lit(True)), Model)
    got = judge(docs, 0.5).collect()
    assert [(r["score"], r["predicted"]) for r in got] == [(0.5, 1)] * 5


def test_carried_and_clashing_columns_and_empty_table(docs_of, model):
    docs = docs_of([(1, "a b", 7, "x", 3)], "doc_id long, text string, score int, _text string, more int")
    got = judge(docs, model)
    assert got.columns == ["doc_id", "text", "more", "score", "predicted"] and got.first()["more"] == 3
    assert judge(docs_of([]), model).collect() == []
    assert judge(docs, Model(Dictionaries(b"", b""), 1, np.zeros(4))).first()["score"] == 0.5
