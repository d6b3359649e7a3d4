"""Groups of rows inside one task, read from batches that are sorted by their first column."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def by_key(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Each value of the first column (whole numbers) with its rows. Holds one group at a time."""
    key, held = None, []
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for first, last in zip([0, *cuts], [*cuts, len(keys)]):
            if held and keys[first] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = keys[first]
            held.append(batch.slice(first, last - first))
    if held:
        yield key, pa.Table.from_batches(held)


def local_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of `count` nodes reaches by the links a[i] - b[i]."""
    root = np.arange(count)
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    while True:
        further = root[root]
        if (further == root).all():
            return root
        root = further
