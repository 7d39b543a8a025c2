"""URL filter with a weighted vocabulary.

An Aho-Corasick automaton finds all strict and soft terms of an address in one pass. A hit
counts only between word boundaries. One strict term, or ``soft_limit`` distinct soft terms, reject an
address. Rules on host and path come first: the longest that fits decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, ship, without

STRICT = ("porn", "xxx", "hentai", "escort", "escorts", "viagra", "camgirl", "camgirls", "malware", "phishing", "warez")
SOFT = ("sex", "nude", "adult", "casino", "poker", "betting", "gambling", "torrent", "crack", "keygen", "payday", "loans", "cheap", "pills", "dating")
SOFT_LIMIT = 2
OUTPUT = ("host", "path", "rule", "verdict", "strict_terms", "soft_terms")


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def automaton(strict: Sequence[str], soft: Sequence[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for t in terms:
            a.add_word(t, (kind, t))
    if len(a):
        a.make_automaton()
    return a


def terms_in(a: ahocorasick.Automaton, url: str) -> tuple[set[str], set[str]]:
    """The distinct strict and soft terms that stand alone; a-z and 0-9 go on a word."""
    strict: set[str] = set()
    soft: set[str] = set()
    if not len(a):
        return strict, soft

    def joins(c: str) -> bool:
        return "a" <= c <= "z" or "0" <= c <= "9"

    for end, (kind, term) in a.iter(url):
        start = end - len(term) + 1
        if (start and joins(url[start - 1])) or (end + 1 < len(url) and joins(url[end + 1])):
            continue
        (strict if kind == "strict" else soft).add(term)
    return strict, soft


def _lower(column) -> F.Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, letters, letters.lower())


def filter_urls(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """All rows with ``host``, ``path``, ``rule``, ``verdict`` and the terms found.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; the
    path follows up to ``?``, ``#`` or the end. Null, or no ``://``: both empty, no rule fits, and null
    has no terms, so it is allowed. Terms are looked up in the whole address, A-Z in lower case. Rows are neither moved nor
    dropped; columns named like the added ones are replaced; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    df = without(df, [*OUTPUT, "_low"])
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    parsed = df.withColumns(
        {
            "host": F.coalesce(_lower(F.regexp_extract(after, r"^[^/?#]*", 0)), F.lit("")),
            "path": F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
            "_low": _lower(F.col(url)),
        }
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(strict, soft)
        for batch in batches:
            found = [terms_in(a, u or "") for u in batch.column("_low").to_pylist()]
            yield (
                batch.drop_columns(["_low"])
                .append_column("strict_terms", pa.array([sorted(x) for x, _ in found], pa.list_(pa.string())))
                .append_column("soft_terms", pa.array([sorted(y) for _, y in found], pa.list_(pa.string())))
            )

    words = T.ArrayType(T.StringType())
    fields = [f for f in parsed.schema.fields if f.name != "_low"]
    scored = parsed.mapInArrow(
        find, T.StructType([*fields, T.StructField("strict_terms", words), T.StructField("soft_terms", words)])
    )
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest is asked first
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith(
            "path", F.lit(r.path)
        )
        rule = F.when(fits, r.name).otherwise(rule)
        decided = F.when(fits, r.verdict).otherwise(decided)
    rejected = (F.size("strict_terms") > 0) | (F.size("soft_terms") >= soft_limit)
    return scored.withColumns(
        {
            "rule": rule,
            "verdict": F.coalesce(decided, F.when(rejected, "block").otherwise("allow")),
        }
    )


def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    def hit(term: str) -> str:
        return f"regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])')::INT"

    fits = {
        r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))" for r in RULES
    }
    longest = sorted(RULES, key=lambda r: -len(r.name))
    return f"""
WITH a AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
b AS (
  SELECT page_id, low,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM a),
c AS (
  SELECT *, CASE {" ".join(f"WHEN {fits[r]} THEN '{r.name}'" for r in longest)} END AS rule,
         CASE {" ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in longest)} END AS decided,
         coalesce({" + ".join(map(hit, STRICT))}, 0) AS strict,
         coalesce({" + ".join(map(hit, SOFT))}, 0) AS soft
  FROM b)
SELECT page_id, host, path, rule,
       coalesce(decided, CASE WHEN strict > 0 OR soft >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM c
"""


OP6_SQL = _sql()
