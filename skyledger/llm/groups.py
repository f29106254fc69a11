"""Groups of sorted partitions inside mapInPandas."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows with equal keys, in batches sorted by them; one group in memory."""
    open_: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        values = batch[keys].to_numpy()
        edges = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        edges = [0, *edges.tolist(), len(batch)]
        for begin, end in zip(edges, edges[1:], strict=False):
            part = batch.iloc[begin:end]
            if open_ and (open_[-1][keys].iloc[0].to_numpy() != values[begin]).any():
                yield pd.concat(open_) if len(open_) > 1 else open_[0]
                open_ = []
            open_.append(part)
    if open_:
        yield pd.concat(open_) if len(open_) > 1 else open_[0]


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of 0..n-1's component under the links a-b."""
    parent = np.arange(n)
    while a.size:
        low = np.minimum(parent[a], parent[b])
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        apart = parent[a] != parent[b]
        a, b = a[apart], b[apart]
    return parent
