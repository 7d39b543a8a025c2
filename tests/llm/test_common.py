from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from impactflow.llm.bpe import encode
from impactflow.llm.common import frugal
from impactflow.llm.exact_dedup import exact_dedup
from impactflow.llm.jaccard_join import describe
from impactflow.llm.lang_id import identify

PIECE, PIECES = 8 << 10, 2_000


def held_mb() -> int:
    """What this process has of memory that is no file's."""
    rollup = Path("/proc/self/smaps_rollup").read_text()
    return int(re.search(r"\nAnonymous:\s+(\d+)", rollup)[1]) >> 10


def test_a_worker_gives_back_what_a_task_has_freed():
    last = []

    def work(batches):
        for batch in batches:
            pieces = [np.ones(PIECE) for _ in range(PIECES)]
            last.append(np.ones(PIECE))  # above the pieces, so nothing below it goes by itself
            assert sum(len(p) for p in pieces) == PIECE * PIECES
            yield batch

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3])], names=["x"])
    before = held_mb()
    out = list(work(iter([batch])))
    kept = held_mb() - before
    assert kept > 100 and list(frugal(work)(iter([batch]))) == out
    assert held_mb() - before < kept - 100


def test_tasks_of_the_pipeline_give_back(spark, docs_of, monkeypatch):
    docs = docs_of([(1, "the cat and the dog sat"), (2, None)])
    kind, works = type(docs), []
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, work, *a, **k: (works.append(work), plain(self, work, *a, **k))[1])
    for step in (identify(docs, None), exact_dedup(docs), describe(docs, "text", ["doc_id"]), encode(docs)):
        assert step.columns
    assert len(works) >= 5 and all(hasattr(w, "__wrapped__") for w in works)
