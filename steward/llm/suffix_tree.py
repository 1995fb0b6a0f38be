"""Suffix trees of short integer sequences with constant-time longest common extensions, as tasks use them.

Ukkonen's construction in one pass, an Euler tour that notes the string depth of each node it meets, and range minima over
the tour: the lowest common ancestor of two leaves is the shallowest node between them, and its string depth is how far the
two suffixes agree. Queries come as arrays and are answered together.
"""

from __future__ import annotations

import numpy as np

#: Numbers of the tour in a block; within blocks minima are looked up by prefix and suffix, between blocks by doubling.
BLOCK = 16


class RangeMinima:
    """Least values of ranges of ``values``: constant time each, memory of a few times the values'."""

    def __init__(self, values: np.ndarray):
        n = -(-len(values) // BLOCK)
        padded = np.full(n * BLOCK, np.iinfo(np.int64).max)
        padded[: len(values)] = values
        self.values, grid = padded, padded.reshape(n, BLOCK)
        self.from_start = np.minimum.accumulate(grid, axis=1).ravel()
        self.to_end = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [grid.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minima of ``values[a..b]``, both ends included, ``a <= b``."""
        out = np.minimum(self.to_end[a], self.from_start[b])
        first, last = a // BLOCK + 1, b // BLOCK
        span = last - first
        for level, least in enumerate(self.levels):
            at = np.flatnonzero((span >= 1 << level) & (span < 2 << level))
            if len(at):
                out[at] = np.minimum(out[at], np.minimum(least[first[at]], least[last[at] - (1 << level)]))
        inside = np.flatnonzero(span < 0)
        if len(inside):
            low, high = a[inside], b[inside]
            least = self.values[low]
            for step in range(1, BLOCK):
                least = np.minimum(least, self.values[np.minimum(low + step, high)])
            out[inside] = least
        return out


def ukkonen(text: list[int], sigma: int) -> tuple[list[int], list[int], list[int], dict[int, int]]:
    """The suffix tree of ``text``, whose last number is found nowhere else in it; numbers are in ``[0, sigma)``.

    Node 0 is the root. Gives the start and end of the label of the edge into each node, the suffix of each leaf (-1 for an
    inner node), and the children by ``node * sigma + first number``.
    """
    n = len(text)
    start, stop, suffix, link = [0], [0], [-1], [0]
    child: dict[int, int] = {}
    node = edge = length = waiting = 0
    for i, c in enumerate(text):
        waiting += 1
        unlinked = 0
        while waiting:
            if not length:
                edge = i
            key = node * sigma + text[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                at = node
            else:
                span = stop[below] - start[below]
                if length >= span:
                    node, edge, length = below, edge + span, length - span
                    continue
                if text[start[below] + length] == c:
                    if unlinked:
                        link[unlinked] = node
                    length += 1
                    break
                at = len(start)
                start.append(start[below])
                stop.append(start[below] + length)
                suffix.append(-1)
                link.append(0)
                child[key] = at
                start[below] += length
                child[at * sigma + text[start[below]]] = below
                child[at * sigma + c] = len(start)
            start.append(i)
            stop.append(n)
            suffix.append(i - waiting + 1)
            link.append(0)
            if unlinked:
                link[unlinked] = at
            unlinked = at
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return start, stop, suffix, child


class Extensions:
    """Longest common extensions of ``codes`` (numbers from 1 to ``sigma - 1``), and, if asked for, the ranks of its suffixes by
    ascending and by descending numbers; the end of the sequence comes before any number in both."""

    def __init__(self, codes: list[int], sigma: int, ranks: bool = False):
        n = len(codes) + 1
        start, stop, suffix, child = ukkonen([*codes, 0], sigma)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        order = np.argsort(keys)
        to = np.fromiter(child.values(), np.int64, len(child))[order].tolist()
        bounds = np.searchsorted(keys[order], np.arange(len(start) + 1) * sigma).tolist()
        depth, tour, first = [0] * len(start), [], [0] * n
        leaves: list[int] = []
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back from a child
                tour.append(depth[~v])
            elif suffix[v] >= 0:
                leaves.append(suffix[v])
                first[suffix[v]] = len(tour)
                tour.append(n - suffix[v])
            else:
                d = depth[v]
                tour.append(d)
                for w in reversed(to[bounds[v] : bounds[v + 1]]):
                    depth[w] = d + stop[w] - start[w]
                    stack += (~v, w)
        self.n, self.first = n, np.array(first)
        self.minima = RangeMinima(np.array(tour))
        if ranks:
            self.ascending = np.empty(n, np.int64)
            self.ascending[leaves] = np.arange(n)
            leaves, stack = [], [0]
            while stack:
                v = stack.pop()
                if suffix[v] >= 0:
                    leaves.append(suffix[v])
                    continue
                below = to[bounds[v] : bounds[v + 1]]
                end = below[0]  # the end of the sequence, if the node has it
                if suffix[end] >= 0 and start[end] == n - 1:
                    stack += below[1:]
                    stack.append(end)
                else:
                    stack += below
            self.descending = np.empty(n, np.int64)
            self.descending[leaves] = np.arange(n)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers the suffixes from ``i`` and from ``j`` have in common; ``i`` and ``j`` differ."""
        a, b = self.first[i], self.first[j]
        return self.minima(np.minimum(a, b), np.maximum(a, b))
