"""Mixing sources to target weights by subset-sum budget fitting.

Each source has a budget of words. Its documents are counted by exact length; whole passes over the
source are taken first. For the rest of the budget every length gives a proportional share of its
documents, so the mix keeps the source's lengths, the longest lengths fill up what is left, and a bounded-knapsack
dynamic program over the remaining documents, of any length, closes the gap to the word, or comes as near as they can. Which documents of a length are taken
is decided by a seeded hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read, ship, without

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 4_711
#: Words that are left to the dynamic program at first; what exceeds them is filled greedily before. Where that does not meet the budget, all is fitted.
WINDOW = 1 << 16
#: The most that one dynamic program may take: bits of a set of sums, and bits times lengths.
BITS, WORK = 1 << 28, 1 << 34
#: Documents that are left open at first where all of them are too many.
OPEN = 32
#: Hash ranges that documents of one source and length are dealt over (a power of two).
RANGES = 256
OUTPUT = ("size", "source_size", "target", "copies", "taken")


def word_count(text: str = "text") -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of the sum by weight, none above ``most`` times its size; the excess goes to the others by weight."""
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), sum(sizes)
    while open_:
        by = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > most * sizes[i] * by]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / by
            break
        for i in full:
            out[i] = float(most * sizes[i])
        open_ -= set(full)
        left -= sum(most * sizes[i] for i in full)
    return out


def fit(
    lengths: np.ndarray, counts: np.ndarray, budget: int, spare: int = 0, window: int = WINDOW
) -> np.ndarray:
    """How many documents of each length to take, so that their words come nearest to the budget.

    A proportional share of each length is taken in any case; what comes on top is the nearest there is (see ``nearest`` on
    very many lengths). Every document is there once.
    Only if that cannot meet the budget, a few are taken up to ``spare`` times more.
    """
    take = np.zeros(len(lengths), np.int64)
    counts = np.where(lengths > 0, counts, 0)
    total = int(lengths @ counts)
    if total:
        # A proportional share of each length, rounded down, in whole numbers. Where it holds whole passes, one document
        # of each length is left open for each of them.
        times = budget // total
        share = [min(c * budget // total - times, c * (1 + spare)) for c in counts.tolist()]
        take = np.maximum(np.asarray(share, np.int64), 0)
    share, open_ = take.copy(), budget - int(lengths @ take)
    left = open_
    for i in np.argsort(-lengths, kind="stable"):  # longest first, until the rest fits into the window
        if left <= window or lengths[i] == 0:
            break
        more = min(int(counts[i] - take[i]), (left - window) // int(lengths[i]) + 1, left // int(lengths[i]))
        if more > 0:
            take[i] += more
            left -= more * int(lengths[i])
    best = take + knapsack(lengths, counts - take, left)
    # What was filled greedily may be in the way: then all of the rest is fitted, and after that with spare ones.
    for there in (counts, counts * (1 + spare))[: 2 if spare else 1]:
        off = abs(budget - int(lengths @ best))
        if off <= least(lengths, counts, budget):
            break
        again = share + nearest(lengths, there - share, open_)
        if abs(budget - int(lengths @ again)) < off:
            best = again
    return best


def nearest(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts of each length whose sum is nearest to the budget, in bounded time and memory.

    Where the dynamic program over all documents is no larger than WORK and BITS, it is that, and no selection is nearer. Otherwise
    the documents are filled in longest first but for some that stay open, which the dynamic program swaps in and out; twice as many are left open
    until the sum meets the budget or the program would exceed WORK. Open are those that bring the greatest common
    divisor down to that of all, and lengths evenly over all there are: their sums are then dense, as a few dozen documents have more
    subsets than sums. A program of n lengths and a budget of b units takes n * b / 64 machine words of work, times log n to find
    the way back, and b / 8 * log n bytes.
    """
    counts = np.where(lengths > 0, np.maximum(counts, 0), 0)
    able = np.flatnonzero(counts)
    if budget <= 0 or len(able) == 0 or _cost(lengths, counts, budget) <= 1:
        return knapsack(lengths, counts, budget)
    divisor, leading = 0, []
    for i in able.tolist():
        less = math.gcd(divisor, int(lengths[i]))
        if less != divisor:
            leading.append(i)
        divisor = less
    stop = least(lengths, counts, budget)
    best, off, open_ = np.zeros(len(lengths), np.int64), budget, OPEN
    while True:
        picked = np.zeros(len(lengths), np.int64)
        picked[leading] = 1
        picked[able[np.linspace(0, len(able) - 1, min(open_, len(able))).astype(np.int64)]] = -(-open_ // len(able))
        picked = np.minimum(picked, counts)
        filled, left = np.zeros(len(lengths), np.int64), budget - int(picked @ lengths) // 2
        for i in able[np.argsort(-lengths[able], kind="stable")].tolist():
            more = min(int(counts[i] - picked[i]), max(left, 0) // int(lengths[i]))
            filled[i] = more
            left -= more * int(lengths[i])
        left = budget - int(filled @ lengths)
        if open_ > OPEN and _cost(lengths, picked, left) > 1:
            return best
        take = filled + knapsack(lengths, picked, left)
        now = abs(budget - int(take @ lengths))
        if now < off:
            best, off = take, now
        if off <= stop or (picked == counts).all():
            return best
        open_ *= 2


def _cost(lengths: np.ndarray, counts: np.ndarray, budget: int) -> float:
    """Work and memory of the dynamic program, 1 where it reaches the most that is allowed."""
    able = (counts > 0) & (lengths > 0)
    if budget <= 0 or not able.any():
        return 0.0
    unit = int(np.gcd.reduce(lengths[able]))
    bits = (budget + min(budget, int(lengths[able].max()))) // unit + 1
    bundles = int(np.ceil(np.log2(counts[able] + 1.0)).sum())
    return max(bits / BITS, bits * bundles / WORK)


def least(lengths: np.ndarray, counts: np.ndarray, budget: int) -> int:
    """What any selection is off the budget at least: all sums are multiples of the lengths' greatest common divisor."""
    unit = int(np.gcd.reduce(lengths[(counts > 0) & (lengths > 0)], initial=0))
    return min(budget % unit, -budget % unit) if unit else abs(budget)


def allot(lengths: np.ndarray, counts: np.ndarray, target: int, whole: int, most: int) -> tuple[int, np.ndarray]:
    """Whole passes over a source, and how many documents of each length come on top.

    As many passes as the target holds; one pass less (and so on) only where that comes nearer, as in a
    source of a few documents.
    """
    if whole == 0:
        return 0, np.zeros(len(lengths), np.int64)
    best = None
    for passes in range(min(most, target // whole), -1, -1):
        budget = target - passes * whole
        if passes == most:
            chosen = np.zeros(len(lengths), np.int64)
        else:
            chosen = fit(lengths, counts, budget, most - passes - 1)
        off = abs(budget - int(chosen @ lengths))
        if best is None or off < best[0]:
            best = off, passes, chosen
        if off <= least(lengths, counts, target):
            break
    return best[1], best[2]


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset-sum: counts of each length whose sum is nearest to the budget, the lower one of two.

    The sums that can be reached are the bits of one number, in units of the lengths' greatest common divisor. Only as
    many of these numbers are held as halving takes; those between are made again to find the way back.
    """
    take = np.zeros(len(lengths), np.int64)
    able = lengths[(counts > 0) & (lengths > 0)]
    if budget <= 0 or len(able) == 0:
        return take
    every = np.where(lengths > 0, np.maximum(counts, 0), 0)
    if int(lengths @ every) <= budget:
        return every
    unit = int(np.gcd.reduce(able))
    low, over = divmod(budget, unit)
    nearest = low if 2 * over <= unit else low + 1
    most = (budget + min(budget, int(able.max()))) // unit  # what is above is no nearer than nothing, or a document too many
    within = (1 << (most + 1)) - 1
    bundles: list[tuple[int, int, int]] = []
    reached = 1
    for i in np.argsort(-lengths, kind="stable").tolist():
        length, size = int(lengths[i]) // unit, 1
        rest = int(min(counts[i], most // length)) if length else 0
        while rest > 0 and not reached >> nearest & 1:
            n = min(size, rest)  # bundles of 1, 2, 4, ... documents make every number up to the count
            rest, size = rest - n, size * 2
            reached |= reached << n * length & within
            bundles.append((i, n, n * length))
        if reached >> nearest & 1:
            break
    if reached >> nearest & 1:
        at = nearest
    else:
        below = (reached & (1 << (low + 1)) - 1).bit_length() - 1
        above = reached >> (low + 1)
        at = below
        if above:
            next_ = low + (above & -above).bit_length()
            at = next_ if next_ * unit - budget < budget - below * unit else below

    def back(first: int, last: int, start: int, at: int) -> int:
        """What is left of a sum before the bundles from first to last, which take what they add to it."""
        if last - first == 1:
            i, n, step = bundles[first]
            if start >> at & 1:
                return at
            take[i] += n
            return at - step
        middle, half = start, (first + last) // 2
        for _, _, step in bundles[first:half]:
            middle |= middle << step & within
        return back(first, half, start, back(half, last, middle, at))

    if bundles:
        back(0, len(bundles), 1, at)
    return take


def mix(
    df: DataFrame,
    size: Column,
    identity: Sequence[str],
    source: str = "source",
    weights: Callable[[int], float] = lambda i: WEIGHTS[i % len(WEIGHTS)],
    most: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    ``size`` is a document's number of words. Sources in code point order, null last, weigh ``weights(0)``, ``weights(1)``, ...; their targets
    share the sum of all sizes, and stop at ``most`` times the source's own. A document is taken as often as the target holds the whole
    source, and once more if it belongs to the selection for the rest (where single documents cannot meet it, a few are taken more often),
    never more than ``most`` times. Within a
    source and length the order is a seeded hash of the ``identity`` columns: equal seeds give equal mixes, and rows that are
    repeated whole are interchangeable. Documents without words belong to every pass but the selection, which they
    cannot change. Texts are not read, only their sizes: a very long document is a length like others. Sizes per source and per source and length are the only statistics, over all rows; one small row for each source goes to the driver. An empty table
    gives an empty result; columns named like the added ones are replaced.
    """
    spark = df.sparkSession
    ship(spark)
    spare = ("_none", "_name", "_hash", "_range")
    names = [c for c in without(df, [*OUTPUT, *spare]).columns]
    rows = without(
        df.withColumns(
            {
                "_size": size,
                "_none": F.col(source).isNull(),
                "_name": F.coalesce(F.col(source), F.lit("")),
                "_hash": F.xxhash64(F.lit(seed), *identity),
            }
        ),
        OUTPUT,
    ).withColumnRenamed("_size", "size")
    rows = rows.withColumn("_range", F.shiftrightunsigned("_hash", 56).cast("int"))  # the order of the hash, unsigned

    # Counts by source, length and hash range: the only pass for statistics.
    counted = materialise(
        rows.groupBy("_none", "_name", "size", "_range").agg(F.count("*").alias("n")), "mixing-counts"
    )
    by_length = counted.groupBy("_none", "_name", "size").agg(F.sum("n").alias("n"))
    sums = by_length.groupBy("_none", "_name").agg(F.sum(F.col("size") * F.col("n")).alias("s")).collect()
    sums = sorted(sums, key=lambda r: (r["_none"], r["_name"]))
    sizes = [int(r["s"]) for r in sums]
    wanted = targets(sizes, [weights(i) for i in range(len(sums))], most)
    # As an Arrow table, a list would be pickled in Python workers of its own, which stay beside those of the other steps.
    kinds = {"_none": pa.bool_(), "_name": pa.string(), "source_size": pa.int64(), "target": pa.float64()}
    facts = [[r["_none"] for r in sums], [r["_name"] for r in sums], sizes, [float(t) for t in wanted]]
    table = spark.createDataFrame(
        pa.table([pa.array(v, k) for v, k in zip(facts, kinds.values(), strict=True)], names=list(kinds))
    )

    def choose(group: pa.Table) -> pa.Table:
        group = group.sort_by("size")
        whole, target = group["source_size"][0].as_py(), group["target"][0].as_py()
        lengths, counts = (group[c].to_numpy().astype(np.int64) for c in ("size", "n"))
        passes, chosen = allot(lengths, counts, round(target), whole, most)
        out = group.select(["_none", "_name", "size"]).append_column("passes", pa.array(passes + chosen // counts, pa.int32()))
        return out.append_column("chosen", pa.array(chosen % counts, pa.int64()))

    chosen = materialise(
        by_length.join(table, ["_none", "_name"])
        .groupBy("_none", "_name")
        .applyInArrow(choose, "_none boolean, _name string, size long, passes int, chosen long"),
        "mixing-chosen",
    )
    # The selection takes the documents of a length in the order of their hashes: whole ranges first.
    before = (
        Window.partitionBy("_none", "_name", "size").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = (
        counted.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(chosen, ["_none", "_name", "size"])
        .select(
            "_none",
            "_name",
            "size",
            "_range",
            "passes",
            F.greatest(F.lit(0), F.least(F.col("n"), F.col("chosen") - F.col("_before"))).alias("_here"),
        )
    )
    keys = ["_none", "_name", "size", "_range"]
    here = Window.partitionBy(*keys).orderBy("_hash", *identity)
    joined = rows.join(ranges, keys).withColumn("_rank", F.row_number().over(here))
    copies = F.col("passes") + (F.col("_rank") <= F.col("_here")).cast("int")
    return joined.withColumn("copies", copies).join(table, ["_none", "_name"]).select(
        *names, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    # The texts are read once, for their sizes and what identifies them.
    slim = materialise(
        docs.select("doc_id", "source", word_count().alias("words"), F.xxhash64("text").alias("text_hash")),
        "mixing-sizes",
    )
    out = mix(slim, F.col("words"), ["doc_id", "text_hash"])
    return out.select("doc_id", "size", "source_size", "target", "taken")
