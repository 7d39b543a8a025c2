from __future__ import annotations

import base64
import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest

from impactflow.llm.warc import assemble, chunked, parse, read_archives, records, unchunked, write_archives

SCHEMA = "page_id long, url string, html string"


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.mark.parametrize("segment_bytes", [90, 1 << 14])
def test_round_trip(spark, docs_of, tmp_path, segment_bytes):
    rnd = random.Random(2)
    pool = [None, "", "é日本" * 200, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9, "\r\n\r\n", "a" * 70_000, "WARC/1.1"]
    rows = [(i, rnd.choice(["http://x/é\r\n y", None]), rnd.choice(pool)) for i in range(60)]
    rows += [(100 + i, "u", "".join(rnd.choices("ab \r\nWARC/1.", k=300))) for i in range(40)]
    write_archives(docs_of(rows, SCHEMA), f"{tmp_path}/w", segment_bytes=segment_bytes)
    got = read_archives(spark, f"{tmp_path}/w").collect()
    first = {}
    for i, _, t in rows:
        first.setdefault(t or "", i)
    want = {}
    for i, _, t in rows:
        t = t or ""
        lead = first[t] == i
        want[str(i)] = ("response" if lead else "revisit", len(t.encode()), sha(t), None if lead else str(first[t]),
                        t.encode() if lead else None, True)
    assert {
        r.key: (r.record_type, r.payload_bytes, r.payload_digest, r.refers_to,
                None if r.payload is None else bytes(r.payload), r.complete) for r in got} == want
    # The files are plain WARC: every record begins with the version line.
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/w").glob("part-*"))
    assert raw.count(b"WARC/1.1\r\n") >= len(rows) and raw.endswith(b"\r\n\r\n")


def test_repeats_nulls_threshold_and_empty(spark, docs_of, tmp_path):
    rows = [(1, "u", "x" * 500), (1, "u", "x" * 500), (2, "u", "x" * 500), (None, "u", "x" * 500), (None, "u", "q"), (None, "u", "q"), (3, "u", "ab"), (4, "u", "ab")]
    write_archives(docs_of(rows, SCHEMA + ""), f"{tmp_path}/a", segment_bytes=100, revisit_from=3)
    got = read_archives(spark, f"{tmp_path}/a").collect()
    assert Counter((r.key, r.record_type, r.refers_to, r.complete) for r in got) == Counter(
        [("1", "response", None, True)] * 2
        + [("2", "revisit", "1", True), (None, "revisit", "1", True)]
        + [(None, "response", None, True)] * 2
        + [("3", "response", None, True), ("4", "response", None, True)]
    )
    write_archives(docs_of([], SCHEMA), f"{tmp_path}/b")
    assert read_archives(spark, f"{tmp_path}/b").collect() == []


def test_damaged_archives(spark, tmp_path):
    digest = hashlib.sha1(b"p" * 300).digest()
    whole = records(7, "u", b"p" * 300, digest, None, 100)
    other = records(8, "u", b"short", hashlib.sha1(b"short").digest(), None, 1000)
    (tmp_path / "x.warc").write_bytes(b"".join([whole[0], *whole[2:], *other])[:-20])
    got = {r.key: r.complete for r in read_archives(spark, f"{tmp_path}/x.warc").collect()}
    assert got == {"7": False, None: False}


def test_framing():
    for payload in (b"", b"a", b"WARC/1.1" * 3, bytes(range(256)) * 40):
        assert unchunked(chunked(payload, 7)) == payload and b"WARC/1.1" not in chunked(payload, 4096)
    assert unchunked(b"5\r\nab") is None and unchunked(b"zz\r\n") is None and unchunked(b"") is None
    segments = [parse(r.partition(b"\r\n")[2]) for r in records(1, None, b"q" * 900, b"d" * 20, None, 200)]
    random.Random(1).shuffle(segments)
    assert b"q" * 100 in assemble(segments) and assemble(segments[1:]) is None


def test_any_url_and_key_comes_back(spark, docs_of, tmp_path):
    mark = "WARC/1.1"
    urls = [f"http://a.org/{mark}", mark, mark * 3, f"{mark}\r\n{mark}\r\n", f"x {mark}", "http://a/%20b%31", f"é {mark}", " lead and trail ", "a\x85b\u2028", "", None, "WARC/1.%31"]
    keys = [f"k{i}-{u}" for i, u in enumerate(urls)]
    rows = [(k, u, f"text {i % 9}", 1, "x") for i, (k, u) in enumerate(zip(keys, urls, strict=True))]
    df = docs_of(rows, "page_id string, url string, html string, digest int, first string")
    write_archives(df, f"{tmp_path}/w", segment_bytes=60)
    got = read_archives(spark, f"{tmp_path}/w").collect()
    assert len(got) == len(rows) and all(r["complete"] for r in got)
    assert {r["key"]: r["uri"] for r in got} == dict(zip(keys, urls, strict=True))
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {min(k for j, k in enumerate(keys) if j % 9 == i) for i in range(3)}
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/w").glob("part-*"))
    assert all(x.startswith(b"WARC-Type") or x.startswith(b"WARC-") for x in raw.split(b"WARC/1.1\r\n")[1:])


def test_a_long_payload_in_many_segments(spark, docs_of, tmp_path):
    text = "long text WARC/1.1 " * 300_000
    write_archives(docs_of([(1, "u", text), (2, "u", text), (3, "u", "short")], SCHEMA), f"{tmp_path}/w")
    got = {r["key"]: r for r in read_archives(spark, f"{tmp_path}/w").collect()}
    assert got["1"]["payload_digest"] == got["2"]["payload_digest"] == sha(text) and got["2"]["refers_to"] == "1"
    assert bytes(got["1"]["payload"]) == text.encode()
