"""Arrow columns in slices of bounded size, so that a task's memory does not follow its batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a step in Python holds.
STEP_BYTES = 1 << 20


def _runs(column: pa.Array, step: np.ndarray) -> Iterator[pa.Array]:
    starts = np.flatnonzero(np.r_[True, step[1:] != step[:-1]]) if len(column) else np.zeros(0, np.int64)
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(column)], strict=False):
        yield column.slice(start, end - start)


def by_bytes(column: pa.Array, limit: int | None = None) -> Iterator[pa.Array]:
    """Consecutive slices of about ``limit`` bytes (a longer text at the end of a slice comes whole) and as many rows at most; nulls count as empty."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    return _runs(column, (np.cumsum(size) - size) // (limit or STEP_BYTES))


def by_known(column: pa.Array, count: int) -> Iterator[pa.Array]:
    """Consecutive slices with ``count`` values that are not null each; the last may have fewer."""
    known = np.cumsum(pc.is_valid(column).to_numpy(zero_copy_only=False))
    return _runs(column, np.maximum(known - 1, 0) // count)
