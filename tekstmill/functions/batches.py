"""Arrow batches in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# List items worked on at a time: keeps a Python worker's arrays to some tens of MB.
ITEMS = 1 << 20


def list_lengths(batch: pa.ListArray) -> np.ndarray:
    """Items per list, 0 for NULL."""
    return pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def parts(batch: pa.ListArray, items: int = ITEMS) -> Iterator[pa.ListArray]:
    """Slices of whole lists with about ``items`` items; a longer list stays whole."""
    before = np.cumsum(list_lengths(batch)) - list_lengths(batch)
    edges = np.flatnonzero(np.diff(before // items, prepend=-1)) if len(batch) else np.array([0])
    for low, high in zip(edges, [*edges[1:], len(batch)]):
        yield batch.slice(int(low), int(high - low))
