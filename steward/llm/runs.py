"""Groups of rows as runs of a sorted stream, for tasks that handle many small groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal ``keys``, with the offsets at which each run starts and the last ends.

    The input must be sorted by ``keys`` (integers without nulls). What is held is a batch and the run that goes beyond it.
    """
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, dtype=bool)
        change[0] = True
        for key in keys:
            values = table[key].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(change), table.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        at = cut(table)
        if len(at) > 2:
            yield table.slice(0, at[-2]), at[:-1]
            held = table.slice(at[-2]).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)


class Forest:
    """Union-find over the positions of a run."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.root(i), self.root(j)))
        self.up[b] = a
