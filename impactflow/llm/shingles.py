"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from .common import lower_ascii

WIDTH = 5

_RANDOM = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, np.uint64)
_PLACE = _RANDOM.integers(1, 1 << 63, WIDTH, np.uint64) | np.uint64(1)
_LENGTH = _RANDOM.integers(1, 1 << 63, WIDTH + 1, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of words that are hashed at a time.
BLOCK = 1 << 18
# What bytes.split takes as space is what separates words here: 0x20 and 0x09 to 0x0D.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spread(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number for each byte and its place in its word, without a rule that whole words could follow."""
    return mix64(_BYTE[data] + place.astype(np.uint64) * _STEP)


def _word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of each word from data[first] up to data[last]; a bounded number of bytes is worked on at a time."""
    out = np.zeros(len(first), np.uint64)
    a = 0
    while a < len(first):
        b = int(np.searchsorted(last, first[a] + BLOCK, "right"))
        if b <= a:  # a word longer than a block
            for at in range(int(first[a]), int(last[a]), BLOCK):
                part = data[at : min(at + BLOCK, int(last[a]))]
                out[a : a + 1] += _spread(part, np.arange(len(part)) + (at - first[a])).sum(dtype=np.uint64)
            a += 1
            continue
        start, stop = int(first[a]), int(last[b - 1])
        at = np.arange(stop - start)
        begin = np.zeros(stop - start, np.int64)
        begin[first[a:b] - start] = first[a:b] - start
        sums = np.zeros(stop - start + 1, np.uint64)
        np.cumsum(_spread(data[start:stop], at - np.maximum.accumulate(begin)), out=sums[1:])
        out[a:b] = sums[last[a:b] - start] - sums[first[a:b] - start]
        a = b
    return mix64(out + (last - first).astype(np.uint64))


def words_of(data: bytes) -> list[bytes]:
    """The words of one text, in lower case as far as A-Z go."""
    return data.translate(_LOWER).split()


def same_shingles(a: bytes, b: bytes) -> tuple[int, int, int]:
    """Sizes of two texts' sets of shingles and of their intersection, counted on the words themselves."""
    sets = []
    for text in (a, b):
        w = words_of(text)
        sets.append(set(zip(*(w[i:] for i in range(WIDTH)))) if len(w) >= WIDTH else {tuple(w)} if w else set())
    return len(sets[0]), len(sets[1]), len(sets[0] & sets[1])


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, end to end; and the n + 1 offsets.

    A-Z are lower-cased; a word is a run of bytes other than space and 0x09 to 0x0D. A text of fewer than
    WIDTH words has its whole sequence as its one shingle, one without words has none.
    """
    n = len(ends) - 1
    low = lower_ascii(data)
    word = ~_SPACE[low]
    begins = np.zeros(len(low) + 1, bool)  # a text begins here
    begins[ends] = True
    before = np.zeros(len(low), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(low), bool)
    after[:-1] = word[1:]
    first = np.flatnonzero(word & (~before | begins[:-1]))
    last = np.flatnonzero(word & (~after | begins[1:])) + 1
    h = _word_hashes(low, first, last)
    text = np.searchsorted(ends, first, "right") - 1
    words = np.bincount(text, minlength=n)

    m = max(len(h) - WIDTH + 1, 0)
    total = np.zeros(m, np.uint64)
    for j in range(WIDTH):
        total += h[j : j + m] * _PLACE[j]
    whole = text[:m] == text[WIDTH - 1 : WIDTH - 1 + m]
    tokens, owner = mix64(total[whole] + _LENGTH[WIDTH]), text[:m][whole]
    few = np.flatnonzero((words > 0) & (words < WIDTH))
    if len(few):
        at = np.searchsorted(text, few)
        short = np.zeros(len(few), np.uint64)
        for j in range(WIDTH - 1):
            has = words[few] > j
            short[has] += h[at[has] + j] * _PLACE[j]
        short = mix64(short + _LENGTH[words[few]])
        order = np.argsort(np.concatenate([owner, few]), kind="stable")
        tokens, owner = np.concatenate([tokens, short])[order], np.concatenate([owner, few])[order]
    edges = np.searchsorted(owner, np.arange(n + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a > 1:
            tokens[a:b].sort()
    keep = np.ones(len(tokens), bool)
    if len(tokens):
        keep[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[keep], np.concatenate([[0], np.cumsum(keep)])[edges]
