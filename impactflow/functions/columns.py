"""Cleaning and normalising expressions (``Column -> Column``).

Everything stays JVM-side. Bad input becomes NULL (or the stated default)
instead of raising, whatever ``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a regular expression of ranges.
SPACES = "[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# What identifies a DOI prefix, an archive id and a paper URL.
DOI_PREFIX = r"^(https?://(dx\.)?doi\.org/|doi:)"
LOCATION_MARKER = "arXiv.org:"
PAPER_URL = r"arxiv\.org/(?:abs|pdf)/([^?#]+)"
VERSION_SUFFIX = r"v\d+$"

# Whole seconds a 64-bit nanosecond timestamp can hold; beyond it -> NULL.
_MAX_EPOCH_SECONDS = 9_223_372_036


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (one linear pass, no regex)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """NULL -> '', anything else -> stripped string."""
    return strip(F.coalesce(_col(c).cast("string"), F.lit("")))


def split_categories(c: Column | str) -> Column:
    """Whitespace-separated codes -> array without empty entries."""
    parts = F.split(F.coalesce(_col(c).cast("string"), F.lit("")), SPACES)
    return F.filter(parts, lambda x: x != "")


def first_version_created(c: Column | str) -> Column:
    """``created`` of the first version; NULL for a missing or empty list."""
    return F.get(_col(c), 0)["created"]


def utc_date(seconds: Column) -> Column:
    """Epoch seconds -> UTC calendar date, independent of the session zone."""
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


def parse_rfc_date(c: Column | str) -> Column:
    """``Mon, 2 Apr 2007 19:18:42 GMT`` (or a numeric offset) -> UTC date."""
    body = F.regexp_replace(strip(_col(c)), r"^[A-Za-z]{3},\s*", "")
    stamp = F.coalesce(
        F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss xx")),
    )
    return utc_date(F.unix_seconds(stamp))


def parse_iso_date(c: Column | str) -> Column:
    return F.try_to_date(_col(c), "yyyy-MM-dd")


def iso_date(c: Column | str) -> Column:
    """Date -> ``yyyy-MM-dd`` string."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def _epoch_seconds(c: Column | str) -> Column:
    seconds = F.floor(_col(c).try_cast("double"))
    return F.when(F.abs(seconds) <= _MAX_EPOCH_SECONDS, seconds)


def epoch_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_seconds(_epoch_seconds(c))


def epoch_to_iso(c: Column | str) -> Column:
    """Epoch seconds -> ``yyyy-MM-ddTHH:mm:ssZ``, always UTC."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    stamp = epoch + F.make_dt_interval(secs=_epoch_seconds(c).cast("decimal(18,6)"))
    return F.concat(F.translate(stamp.cast("string"), " ", "T"), F.lit("Z"))


def to_number(c: Column | str) -> Column:
    """To double; unparsable, missing or NaN -> 0."""
    return F.coalesce(F.nanvl(_col(c).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def to_count(c: Column | str) -> Column:
    """To long (fraction cut off); unparsable or missing -> 0."""
    c = _col(c)
    return F.coalesce(
        c.try_cast("bigint"), to_number(c).try_cast("bigint"), F.lit(0).cast("bigint")
    )


def default_empty_array(c: Column | str, element: str = "bigint") -> Column:
    return F.coalesce(_col(c), F.array().cast(f"array<{element}>"))


def fill_default(c: Column | str, value: str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(value))


def normalize_key(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c).cast("string")))


def normalize_doi(c: Column | str) -> Column:
    """Bare lower-case DOI; blank -> NULL. Lower-cases before the prefix test."""
    bare = F.regexp_replace(F.lower(strip(_col(c))), DOI_PREFIX, "")
    return blank_to_null(strip(bare))


def id_from_location(c: Column | str, marker: str = LOCATION_MARKER) -> Column:
    """Archive id after ``marker`` in a location id, version suffix removed."""
    c = _col(c)
    tail = F.substring(c, F.instr(c, marker) + F.lit(len(marker)), F.length(c))
    bare = F.regexp_replace(F.lower(strip(tail)), VERSION_SUFFIX, "")
    return F.when(F.contains(c, F.lit(marker)), blank_to_null(bare))


def id_from_url(
    c: Column | str,
    pattern: str = PAPER_URL,
    *,
    extension: str = ".pdf",
    strip_slash: bool = False,
) -> Column:
    """Paper id in a URL (group 1 of ``pattern``), without extension and version."""
    found = F.lower(F.regexp_extract(_col(c), pattern, 1))
    if strip_slash:
        found = F.regexp_replace(found, r"/$", "")
    bare = F.regexp_replace(found, re.escape(extension) + "$", "")
    return blank_to_null(F.regexp_replace(bare, VERSION_SUFFIX, ""))


def null_normalize(c: Column | str) -> Column:
    """NaN -> NULL for a floating-point column."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def ignore_above(c: Column | str, limit: int) -> Column:
    """NULL for strings longer than ``limit`` (not indexed as a keyword)."""
    c = _col(c)
    return F.when(F.length(c) <= limit, c)


def growth_pct(current: Column, previous: Column) -> Column:
    """Percentage change; NULL without a positive previous value."""
    return F.when(previous > 0, (current - previous) / previous * 100)


# -- text folding -------------------------------------------------------------

# Letters that fold to more than one ASCII letter.
FOLD_MULTI = {
    "æ": "ae", "œ": "oe", "ß": "ss", "þ": "th", "ĳ": "ij", "ǆ": "dz", "ǉ": "lj",
    "ǌ": "nj", "ǳ": "dz",
}
# Letters without a Unicode decomposition that fold to one letter.
FOLD_SINGLE = {
    "ð": "d", "đ": "d", "ħ": "h", "ı": "i", "ł": "l", "ŉ": "n", "ø": "o", "ŧ": "t",
}


def _fold_pairs() -> tuple[str, str]:
    """Lower-case accented letters and their base letters, from Unicode decompositions."""
    pairs = dict(FOLD_SINGLE)
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        base = unicodedata.normalize("NFD", ch)[0]
        if ch == ch.lower() and base != ch and base.isascii():
            pairs.setdefault(ch, base)
    return "".join(pairs), "".join(pairs.values())


FOLD_FROM, FOLD_TO = _fold_pairs()

# Han and hiragana signs, each of which is a word of its own.
_SIGNS = r"\u3041-\u309f\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\x{20000}-\x{3134f}"
_LETTERS = rf"[a-z\p{{L}}\p{{M}}&&[^{_SIGNS}]]++"
# A word is letters, digits, marks and underscores; . : ' join two letters and
# . , ; ' join two digits. Possessive repeats keep Java's matcher from recursing.
WORD = (
    rf"(?:{_LETTERS}(?:[.:'’·]{_LETTERS})*+|\p{{N}}++(?:[.,;'’]\p{{N}}++)*+|_)++"
    rf"|[{_SIGNS}]"
)


def fold_ascii(c: Column | str) -> Column:
    """Lower-case and replace accented letters by their ASCII base letters."""
    out = F.translate(F.lower(_col(c)), FOLD_FROM, FOLD_TO)
    for letter, ascii_letters in FOLD_MULTI.items():
        out = F.replace(out, F.lit(letter), F.lit(ascii_letters))
    return out


def fold_text(c: Column | str) -> Column:
    """Analysed tokens for matching: word tokens, lower-cased, folded to ASCII.

    Folding turns letters into letters, so it can run over the whole text first.
    """
    folded = fold_ascii(F.coalesce(_col(c), F.lit("")))
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))
