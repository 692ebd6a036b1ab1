"""Groups of rows inside a task: rows come sorted by key, each group is handed out whole."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each run of equal values in the first `keys` integer columns."""
    current: tuple | None = None
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for low, high in zip(starts, starts[1:]):
            key = tuple(int(c[low]) for c in columns)
            if key != current:
                if held:
                    yield current, pa.Table.from_batches(held)
                current, held = key, []
            held.append(batch.slice(low, high - low))
    if held:
        yield current, pa.Table.from_batches(held)


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of a graph on 0 … n - 1 as (node, the node that led to it).

    near(x, others) tells which of the others are linked to x. Every node is
    compared with those not reached yet, so linked groups cost little, and no pair
    that could join two trees is left out.
    """
    edges: list[tuple[int, int]] = []
    open_ = np.arange(n)
    queue: list[int] = []
    while len(open_):
        if not queue:
            queue.append(int(open_[0]))
            open_ = open_[1:]
        node = queue.pop()
        if not len(open_):
            break
        hit = near(node, open_)
        found = open_[hit].tolist()
        edges.extend((k, node) for k in found)
        queue.extend(found)
        open_ = open_[~hit]
    return edges
