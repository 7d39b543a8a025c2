"""Integer vectors inside Arrow batches, and exact squared distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole components are held within this size either way, so that squares of 64 of them, times two, fit 64 bits.
LARGEST = 1 << 26
#: Below this, sums of whole numbers are exact in double precision.
_EXACT = 1 << 53


def usable(vector: str) -> Column:
    """Rows whose vector is there and holds neither null nor NaN nor infinity."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & finite


def numeric(df: DataFrame, vector: str) -> Column:
    """The vector as an array of float or double, as ``whole`` reads it."""
    kind = df.schema[vector].dataType.simpleString()
    return F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")


def whole(column: pa.Array, scale: int, width: int, exactly: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the usable rows and their vectors, floor(scale * x) of each component, as a table of ``width`` columns.

    With ``exactly`` only vectors of that width are usable; without, shorter ones are filled up with zeros.
    """
    offsets = column.offsets.to_numpy().astype(np.int64)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null comes as NaN
    lengths = np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    good = there & (bad[offsets[1:]] == bad[offsets[:-1]])
    if exactly:
        good &= lengths == width
    rows = np.flatnonzero(good)
    out = np.zeros((len(rows), width), np.int64)
    size = np.minimum(lengths[rows], width)
    row = np.repeat(np.arange(len(rows)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    values = np.floor(x[np.repeat(offsets[:-1][rows], size) + place] * scale)
    out[row, place] = np.clip(values, -LARGEST, LARGEST).astype(np.int64)
    return rows, out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two tables of whole numbers."""
    if a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two tables of whole numbers."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * products(a, b)


def means(sums: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """floor(sum / count) by component; rows without members stay as they were."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], before)
