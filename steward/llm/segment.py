"""N-best segmentation into the pieces of a public vocabulary, and decoding (operator 6).

A unit's lattice is searched from its end: the forward Viterbi pass gives the best score of every prefix, which is an exact
heuristic for the backward A-star search, so that complete segmentations leave its agenda best first and nothing is expanded
that no result needs. Pieces do not reach across units, so the N best of a text are put together from those of its units,
keeping N at each step. Units are searched once and kept in a bounded cache.

Ids are those of the vocabulary file. Characters that it lacks are spelled as bytes at the cost of a score below all others,
so decoding gives the text back, byte for byte.

Defined results: a null text has a null segmentation, and an empty one the empty segmentation with score 0; segmentations of
equal score come in the order in which the search meets them, which is the same on every run; repeated rows are segmented
alike; fewer segmentations than N are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.llm.columns import picked
from steward.llm.lattice import Pieces, pieces
from steward.llm.tokens import vocabulary_path

#: Units a worker remembers, about 200 bytes each. The cache is emptied in halves, so what is frequent comes back at once.
CACHED_UNITS = 600_000

#: Ids of a segmentation as bytes, two each.
Ids = bytes


def _spelling(vocabulary: Pieces, character: str) -> tuple[float, Ids]:
    """A character spelled in bytes: below every piece, and the pieces of its bytes."""
    ids = vocabulary.byte_ids(character)
    return (vocabulary.lowest - 10.0) * len(ids), b"".join(i.to_bytes(2, "big") for i in ids)


def unit_n_best(unit: str, vocabulary: Pieces, n: int) -> list[tuple[float, Ids]]:
    """The ``n`` best segmentations of ``unit`` as ``(score, ids)``, best first, by backward A-star search.

    Every entry of the agenda is the end of at least one segmentation that scores what its heuristic says, and of no other
    entry's. So as many entries are kept as results are missing, however long the unit is. Among equals the one that got
    furthest comes first, then the one met first.
    """
    ids, scores, longest = vocabulary.ids, vocabulary.scores, vocabulary.longest
    ahead = _best_ahead(unit, vocabulary)
    found: list[tuple[float, Ids]] = []
    met = 0
    agenda: list[tuple[float, int, int, float, tuple]] = [(-ahead[-1], len(unit), 0, 0.0, ())]
    while agenda and len(found) < n:
        _, at, _, behind, path = agenda.pop(0)
        if not at:
            parts = []
            while path:
                part, path = path
                parts.append(part)
            found.append((behind, b"".join(parts)))
            continue
        for start in range(max(0, at - longest), at):
            piece = ids.get(unit[start:at])
            if piece is not None:
                score, part = scores[piece], piece.to_bytes(2, "big")
            elif start == at - 1:
                score, part = _spelling(vocabulary, unit[start])
            else:
                continue
            met += 1
            bisect.insort(agenda, (-(ahead[start] + score + behind), start, met, score + behind, (part, path)))
        del agenda[n - len(found) :]
    return found


def _best_ahead(unit: str, vocabulary: Pieces) -> list[float]:
    """The best score of every beginning of ``unit``."""
    tree, n = vocabulary.tree, len(unit)
    out = [0.0] + [float("-inf")] * n
    for start in range(n):
        node, here, end = tree.get(unit[start]), out[start], start + 1
        if node is None or node[0] < 0:
            out[end] = max(out[end], here + _spelling(vocabulary, unit[start])[0])
        while node is not None:
            if node[0] >= 0 and here + node[1] > out[end]:
                out[end] = here + node[1]
            if end == n:
                break
            node = node[2].get(unit[end])
            end += 1
    return out


def unit_best(unit: str, vocabulary: Pieces) -> tuple[Ids, float, float]:
    """The best segmentation of ``unit``, its score, and how much less the second best has, by a forward pass that keeps two
    scores per position."""
    tree, n = vocabulary.tree, len(unit)
    low = float("-inf")
    first, second, back = [low] * (n + 1), [low] * (n + 1), [(0, -1)] * (n + 1)
    first[0] = 0.0
    for start in range(n):
        a, b = first[start], second[start]
        node = tree.get(unit[start])
        if node is None or node[0] < 0:
            end, score = start + 1, _spelling(vocabulary, unit[start])[0]
            if a + score > first[end]:
                second[end] = max(first[end], b + score)
                first[end], back[end] = a + score, (start, -1)
            else:
                second[end] = max(second[end], a + score)
        end = start + 1
        while node is not None:
            piece, score, further = node
            if piece >= 0:
                total = a + score
                if total > first[end]:
                    second[end] = first[end] if first[end] > b + score else b + score
                    first[end], back[end] = total, (start, piece)
                elif total > second[end]:
                    second[end] = total
            if end == n:
                break
            node = further.get(unit[end])
            end += 1
    ids, at = [], n
    while at:
        at, piece = back[at]
        ids.append(piece.to_bytes(2, "big") if piece >= 0 else _spelling(vocabulary, unit[at])[1])
    return b"".join(reversed(ids)), first[n], first[n] - second[n]


class _Units:
    """Units found so far: their numbers, and by number their best ids, scores and losses."""

    def __init__(self, room: int):
        self.number: dict[str, int] = {}
        self.ids: list[Ids] = []
        self.scores, self.losses = np.zeros(room), np.zeros(room)

    def add(self, unit: str, ids: Ids, score: float, loss: float) -> None:
        i = self.number[unit] = len(self.ids)
        self.ids.append(ids)
        self.scores[i], self.losses[i] = score, loss


class Segmenter:
    """N-best segmentation of texts, with a cache of units."""

    def __init__(self, path: str, n: int, cached: int = CACHED_UNITS):
        self.vocabulary, self.n, self.half = pieces(path), n, max(1, cached // 2)
        self.new, self.old = _Units(self.half), _Units(self.half)
        self.searched = functools.lru_cache(max(1, cached // 20))(lambda unit: unit_n_best(unit, self.vocabulary, n))

    def _look_up(self, units: list[str]) -> list[tuple[Ids, float, float]]:
        """Every unit's best, whatever the cache holds; what is not in its newer half is put there."""
        found = []
        for unit in units:
            at = self.new.number.get(unit)
            held = self.new
            if at is None:
                at, held = self.old.number.get(unit), self.old
            known = (
                unit_best(unit, self.vocabulary)
                if at is None
                else (held.ids[at], float(held.scores[at]), float(held.losses[at]))
            )
            if held is self.old:
                if len(self.new.ids) == self.half:
                    self.old, self.new = self.new, _Units(self.half)
                self.new.add(unit, *known)
            found.append(known)
        return found

    def n_best(self, text: str) -> list[tuple[float, Ids]]:
        """The best segmentations of ``text``, as if a blank stood before it.

        Another segmentation loses at least the least loss of a unit it changes, and changing one of the ``n - 1`` units of
        least loss already gives that many better ones: so no other unit is changed, and only those are searched.
        """
        if not text:
            return [(0.0, b"")]
        units = self.vocabulary.units(text)
        numbers = list(map(self.new.number.get, units))
        missing = [unit for unit, number in zip(units, numbers, strict=True) if number is None] if None in numbers else []
        if missing and len(self.new.ids) + len(missing) <= self.half:
            self._look_up(missing)
            numbers = list(map(self.new.number.get, units))
            missing = []
        if missing:  # the cache turns over within this text
            best, scores, losses = map(list, zip(*self._look_up(units), strict=True))
            total, losses = sum(scores), np.array(losses)
        else:
            at = np.array(numbers)
            best = list(map(self.new.ids.__getitem__, numbers))
            total, losses = float(self.new.scores[at].sum()), self.new.losses[at]
        choices: list[tuple[float, tuple[tuple[int, Ids], ...]]] = [(0.0, ())]
        if self.n > 1:
            for place in _least(losses, self.n - 1):
                options = self.searched(units[place])
                choices = [
                    (loss + options[0][0] - score, (*taken, (place, other)))
                    for loss, taken in choices
                    for score, other in options
                ]
                choices = heapq.nsmallest(self.n, choices, key=lambda x: x[0])
        out = []
        for loss, taken in choices:
            ids = list(best)
            for place, other in taken:
                ids[place] = other
            out.append((total - loss, b"".join(ids)))
        return out


def _least(values: np.ndarray, n: int) -> list[int]:
    """The places of the ``n`` least values, earlier places first among equals."""
    if len(values) > n:
        low = np.flatnonzero(values <= np.partition(values, n - 1)[n - 1])
    else:
        low = np.arange(len(values))
    return low[np.argsort(values[low], kind="stable")][:n].tolist()


def id_array(ids: Ids) -> np.ndarray:
    return np.frombuffer(ids, dtype=">u2").astype("<u4")


def decode(ids: np.ndarray, vocabulary: Pieces) -> str:
    """The text of a segmentation: its pieces' bytes, without the blank put before the text."""
    whole = vocabulary.text_bytes(ids)
    return whole[1:].decode() if whole[:1] == b" " else whole.decode()


SEGMENTED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("score", T.DoubleType()),
        T.StructField("ids", T.BinaryType()), T.StructField("decoded_crc32", T.LongType()),
    ]
)

_SEGMENTERS: dict[tuple[str, int], Segmenter] = {}


def _segmenter(path: str, n: int) -> Segmenter:
    """One per process, so that a worker keeps its cache from task to task."""
    if (path, n) not in _SEGMENTERS:
        _SEGMENTERS[path, n] = Segmenter(path, n)
    return _SEGMENTERS[path, n]


def segment_texts(docs: DataFrame, n: int = 3, doc_id: str = "doc_id", text: str = "text",
                  vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """``(doc_id, rank, score, ids, decoded_crc32)``: the ``n`` best segmentations of every text, ``rank`` from 1, ``ids`` as
    little-endian unsigned 32-bit numbers. The best is decoded again at once; the checksum of what comes out tells whether
    that is the text."""
    path = vocabulary_path(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(path, n)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc, whole in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    if whole is None:
                        rows.append((doc, 1, None, None, None))
                        continue
                    for rank, (score, found) in enumerate(segmenter.n_best(whole), 1):
                        ids = id_array(found)
                        back = decode(ids, segmenter.vocabulary) if rank == 1 else None
                        rows.append((doc, rank, score, ids.tobytes(), None if back is None else zlib.crc32(back.encode())))
                kinds = (pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.int64())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.record_batch(columns, SEGMENTED.names)

    source = picked(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(work, SEGMENTED)


def decode_ids(segmented: DataFrame, ids: str = "ids", out: str = "text", vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """``segmented`` with the text that each row's ids spell: the inverse of :func:`segment_texts`. Null where ids are null."""
    path = vocabulary_path(vocabulary)
    held = [f for f in segmented.schema if f.name != out]
    schema = T.StructType([*held, T.StructField(out, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = pieces(path)
        for batch in batches:
            texts = [None if x is None else decode(np.frombuffer(x, "<u4"), read) for x in batch[ids].to_pylist()]
            yield pa.record_batch([*(batch[f.name] for f in held), pa.array(texts, pa.string())], schema.names)

    return segmented.mapInArrow(work, schema)
