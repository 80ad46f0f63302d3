"""Arrow batches with a list column, cut into runs of rows with a bounded number of list items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Items that are worked on at once; a longer list is taken alone.
SLICE_ITEMS = 200_000


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and boundaries of a column of integer lists without nulls."""
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return values, np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each run of rows with the values and boundaries of its lists."""
    for batch in batches:
        upto, at = np.cumsum(batch[column].value_lengths().to_numpy(zero_copy_only=False)), 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + SLICE_ITEMS, side="right")))
            part = batch.slice(at, end - at)
            yield part, *lists(part[column])
            at = end
