"""Periodic runs of words, and texts without their repeats (operator 11).

A run is a stretch of words that repeats with a smallest period ``q``, at least ``min_length`` words and ``min_periods``
periods long, and that no neighbouring word continues. All runs of a text are found by their Lyndon roots: every run holds,
in the order of words or in its reverse, the longest Lyndon word that starts at some place, as one period of it. That word ends
at the next smaller suffix, so there are two candidates a place; each is extended in both directions by longest common
extensions, in constant time from Ukkonen's suffix trees of the text and of its reversal (``suffix_tree``).

Trees are built for the parts of a text that can hold a run. A run of the required length has no window of ``window_words``
words that is unlike all other windows of the text, so the parts are the stretches of windows that are found twice; windows are
compared by hash, and a chance hit only makes a part longer. What a part has is exactly what the text has there.

Texts are whole and independent of each other: no shuffle, and a lost task is done again. Memory is that of one batch and of
the trees of one part.

Defined results: a null text counts as empty and has no runs; a null id is kept; repeated rows are done each for itself; runs
of one start are listed by period; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from steward.llm.columns import picked
from steward.llm.suffix_tree import Extensions

MIN_LENGTH = 24
MIN_PERIODS = 3

RUNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType(
            [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]
        ))),
        T.StructField("collapsed", T.BinaryType()),
    ]
)

#: Rewrites the words of a text before they are searched, given its id.
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def window_words(min_length: int, min_periods: int) -> int:
    """The longest window of which every run holds each one twice: a run of ``l`` words and period ``q`` does for windows of
    up to ``l - 2 * q + 1``."""
    return min(max(min_length, min_periods * q) - 2 * q + 1 for q in range(1, min_length + 1))


def repeating_parts(codes: np.ndarray, min_length: int, window: int) -> list[tuple[int, int]]:
    """``(start, end)`` of the maximal stretches, of at least ``min_length``, whose windows are all found twice in ``codes``."""
    n = len(codes) - window + 1
    if len(codes) < min_length or n < 2:
        return []
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for k in range(window):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(n + 2, np.int8)
    twice[1:-1][order[1:][same]] = 1
    twice[1:-1][order[:-1][same]] = 1
    change = np.diff(twice)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1) + window - 1
    return [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= min_length]


def next_smaller(rank: list[int]) -> list[int]:
    """For each place but the last the next one whose rank is smaller; the last rank is the smallest."""
    out, open_ = [0] * (len(rank) - 1), [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        r = rank[i]
        while rank[open_[-1]] > r:
            open_.pop()
        out[i] = open_[-1]
        open_.append(i)
    return out


def runs_of(codes: list[int], sigma: int, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """``(start, length, period)`` of all runs of ``codes`` (numbers from 1 to ``sigma - 1``), by start, then period."""
    n = len(codes)
    if n < min_length:
        return np.empty((0, 3), np.int64)
    onward = Extensions(codes, sigma, ranks=True)
    at = np.arange(n)
    first = np.concatenate([at, at])
    second = np.array(next_smaller(onward.ascending.tolist()) + next_smaller(onward.descending.tolist()))
    period = second - first
    fits = period * min_periods <= n
    first, second, period = first[fits], second[fits], period[fits]
    end = second.copy()
    inside = np.flatnonzero(second < n)
    end[inside] += onward(first[inside], second[inside])
    del onward
    backward = Extensions(codes[::-1], sigma)
    start = first.copy()
    inside = np.flatnonzero(first > 0)
    start[inside] -= backward(n - first[inside], n - second[inside])
    length = end - start
    runs = np.column_stack([start, length, period])
    runs = runs[(length >= min_length) & (length >= min_periods * period)]
    return np.unique(runs[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def periods_of(words: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """``(start, length, period)`` of the runs of a text's words, by start, then period."""
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = []
    for a, b in repeating_parts(codes, min_length, window_words(min_length, min_periods)):
        distinct, part = np.unique(codes[a:b], return_inverse=True)
        runs = runs_of((part + 1).tolist(), len(distinct) + 1, min_length, min_periods)
        runs[:, 0] += a
        found.append(runs)
    if not found:
        return np.empty((0, 3), np.int64)
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run repeats: of each run the first period is kept."""
    if not len(runs):
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None,
                  min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``runs`` (their ``start, length, period`` by start, then period) and
    ``collapsed``, the UTF-8 text of the words that are left.

    Words are stretches without ASCII white space, numbered from 0. At least two periods make a run.
    """
    if min_periods < 2 or min_length < 1:
        raise ValueError("a run has two periods or more")
    schema = to_arrow_schema(RUNS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            runs, texts = [], []
            for doc, value in zip(ids, batch["text"], strict=True):
                words = (value.as_py() or b"").split()  # bytes are split at ASCII white space and nowhere else
                if rewrite is not None:
                    words = rewrite(doc, words)
                found = periods_of(words, min_length, min_periods)
                runs.append([{"start": s, "length": l, "period": p} for s, l, p in found.tolist()])
                texts.append(collapsed(words, found))
            columns = (ids, runs, texts)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)

    rows = picked(docs, doc_id=doc_id, text=text)
    return rows.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(find, RUNS)
