"""Whole-number vectors of a column of arrays, inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Components are multiplied by this and rounded down.
SCALE = 256
LONG = 2**63 - 1


def whole_vectors(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can be used, and their components as whole numbers (a row each, as exact doubles).

    Null arrays and those that hold null, a non-finite component or one that overflows when scaled are left out, and
    with ``size`` those of another length; without it, shorter ones end in zeros.
    """
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    there = np.maximum(lengths, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        value = np.floor(SCALE * column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(lengths)), there)
    fits = (lengths >= 0) & (np.bincount(row[~np.isfinite(value)], minlength=len(lengths)) == 0)
    if size is not None:
        fits &= lengths == size
    made = np.zeros((int(fits.sum()), size if size is not None else int(there[fits].max(initial=0))))
    place = np.arange(len(row)) - np.repeat(np.cumsum(there) - there, there)
    mine = fits[row]
    made[(np.cumsum(fits) - 1)[row[mine]], place[mine]] = value[mine]
    return fits, made


def integers(matrix: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers, for sums that a double can't hold."""
    return np.frompyfunc(int, 1, 1)(matrix).reshape(matrix.shape)


def largest(*matrices: np.ndarray) -> float:
    return max((float(np.abs(m).max(initial=0)) for m in matrices), default=0.0)
