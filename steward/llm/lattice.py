"""The piece lattice of a public subword vocabulary: all ways to spell a string in its pieces.

Strings are in blanks where the vocabulary writes word marks. A text is cut into units, across which no piece reaches, and
lattices are built per unit: a run of blanks with what follows up to the next one or, where the vocabulary mixes no letters
with other signs in a piece, up to the next change between them. Characters that the vocabulary lacks, such as its word mark
where a text has it, are spelled as the pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import functools
import math
import re
from collections import deque

import numpy as np

MARK = "▁"

#: A unit of a text: blanks, and what follows up to the next ones.
UNITS = re.compile(" *[^ ]+| +")
#: Finer ones: blanks, and letters or other signs. Superscript digits go with the other signs.
FINE_UNITS = re.compile(r" *[^\W\d_¹²³]+| *(?:[^\w ]|[\d_¹²³])+| +")


class Pieces:
    """The pieces of a vocabulary file with their ids and scores."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.bytes: list[int] = [-1] * 256
        self.spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i))
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.spelled.append(b"")
            else:
                self.ids[piece.replace(MARK, " ")] = i
                self.spelled.append(piece.replace(MARK, " ").encode())
        if min(self.bytes) < 0:
            raise ValueError(f"{path} has no piece for some bytes")
        #: By character: the id and score of the piece that ends with it (-1 for none), and what pieces have after it.
        self.tree: dict[str, list] = {}
        for piece, i in self.ids.items():
            here = self.tree
            for c in piece[:-1]:
                here = here.setdefault(c, [-1, 0.0, {}])[2]
            here.setdefault(piece[-1], [-1, 0.0, {}])[:2] = [i, self.scores[i]]
        #: Whether units may be cut between letters and other signs as well: no piece goes across.
        self.finer = all(FINE_UNITS.fullmatch(p) or not p.strip(" ") for p in self.ids)
        self.longest = max(map(len, self.ids))
        self.lowest = min(s for s in self.scores if s > -1e8)

    def arcs(self, unit: str) -> list[list[tuple[int, int]]]:
        """For each end position in ``unit``, the ``(start, id)`` of pieces ending there; id -1 spells one character by bytes."""
        n = len(unit)
        out: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for start in range(n):
            if unit[start] not in self.ids:
                out[start + 1].append((start, -1))
            here = self.tree
            for end in range(start + 1, n + 1):
                node = here.get(unit[end - 1])
                if node is None:
                    break
                if node[0] >= 0:
                    out[end].append((start, node[0]))
                here = node[2]
        return out

    def units(self, text: str) -> list[str]:
        """The units of a text, which starts as if a blank stood before it."""
        return (FINE_UNITS if self.finer else UNITS).findall(" " + text)

    @functools.cached_property
    def _flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces' bytes in a row, where each starts, and how long it is."""
        lengths = np.array([len(b) for b in self.spelled], dtype=np.int64)
        return np.frombuffer(b"".join(self.spelled), np.uint8), np.cumsum(lengths) - lengths, lengths

    def text_bytes(self, ids: np.ndarray) -> bytes:
        """What a sequence of ids spells."""
        flat, starts, lengths = self._flat
        sizes = lengths[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return flat[np.repeat(starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()

    def byte_ids(self, character: str) -> list[int]:
        """The pieces that spell a character the vocabulary lacks."""
        return [self.bytes[b] for b in character.encode()]


@functools.cache
def pieces(path: str) -> Pieces:
    """The vocabulary of ``path``, read once per process."""
    return Pieces(path)


def rank_weights(vocabulary: Pieces) -> list[float]:
    """Natural log probabilities of all pieces from their scores, as a rank law.

    The scores of the file are minus the rank of the piece; a piece of rank ``r`` weighs ``1 / (r + 2)``, and bytes, which
    have no rank, weigh like the last. The weights add up to 1.
    """
    last = -vocabulary.lowest
    weights = [0.0] * len(vocabulary.scores)
    for i in [*vocabulary.ids.values(), *vocabulary.bytes]:
        score = vocabulary.scores[i]
        rank = -score if -1e8 < score < 0 else last
        weights[i] = 1.0 / (rank + 2.0)
    total = sum(weights)
    return [math.log(w / total) if w else -math.inf for w in weights]


def log_marginal(unit: str, vocabulary: Pieces, weights: list[float]) -> float:
    """Natural log of the summed probability of all segmentations of ``unit``: forward recursion in log space.

    What arrives is kept for as many positions ahead as the longest piece reaches, so a unit of any length takes little room.
    """
    tree, n = vocabulary.tree, len(unit)
    ahead: deque[list[float]] = deque([[0.0]])
    for start in range(n):
        arrived = ahead.popleft()
        if len(arrived) == 1:
            here = arrived[0]
        else:
            most = max(arrived)
            here = most + math.log(sum([math.exp(t - most) for t in arrived]))
        if not ahead:
            ahead.append([])
        node = tree.get(unit[start])
        if node is None or node[0] < 0:
            ahead[0].append(here + sum(weights[i] for i in vocabulary.byte_ids(unit[start])))
        end = start + 1
        while node is not None:
            if node[0] >= 0:
                while len(ahead) < end - start:
                    ahead.append([])
                ahead[end - start - 1].append(here + weights[node[0]])
            if end == n:
                break
            node = node[2].get(unit[end])
            end += 1
    arrived = ahead.popleft()
    most = max(arrived)
    return most + math.log(sum([math.exp(t - most) for t in arrived]))


def add_expected(unit: str, vocabulary: Pieces, weights: list[float], chances: list[float], out: list[float]) -> None:
    """Add to ``out`` how often each piece is expected in a segmentation of ``unit``, given that it is spelled: forward and
    backward sums over its lattice. ``chances`` are the ``exp`` of ``weights``.

    Sums are of probabilities, or of their logarithms where these are too small.
    """
    n, tree, arcs = len(unit), vocabulary.tree, []
    for start in range(n):
        node = tree.get(unit[start])
        if node is None or node[0] < 0:
            arcs.append((start, start + 1, vocabulary.byte_ids(unit[start])))
        end = start + 1
        while node is not None:
            if node[0] >= 0:
                arcs.append((start, end, node[0]))
            if end == n:
                break
            node = node[2].get(unit[end])
            end += 1
    forward = [1.0] + [0.0] * n
    sized = []
    for start, end, piece in arcs:
        p = chances[piece] if isinstance(piece, int) else math.prod([chances[i] for i in piece])
        sized.append(p)
        forward[end] += forward[start] * p
    if forward[n] > 1e-250:
        backward = [0.0] * n + [1.0 / forward[n]]
        for (start, end, piece), p in zip(reversed(arcs), reversed(sized)):
            after = p * backward[end]
            backward[start] += after
            share = forward[start] * after
            for i in (piece,) if isinstance(piece, int) else piece:
                out[i] += share
        return
    logs = [weights[piece] if isinstance(piece, int) else sum(weights[i] for i in piece) for _, _, piece in arcs]
    into: list[list[float]] = [[] for _ in range(n + 1)]
    into[0].append(0.0)
    before = [0.0] * (n + 1)
    at = 0
    for (start, end, _), w in zip(arcs, logs):
        while at <= start:  # all arcs into a place come before those out of it
            before[at] = _log_sum(into[at])
            at += 1
        into[end].append(before[start] + w)
    total = _log_sum(into[n])
    onward: list[list[float]] = [[] for _ in range(n + 1)]
    onward[n].append(0.0)
    after, at = [0.0] * (n + 1), n
    for (start, end, piece), w in zip(reversed(arcs), reversed(logs)):
        while at > start:
            after[at] = _log_sum(onward[at])
            at -= 1
        onward[start].append(w + after[end])
        share = math.exp(before[start] + w + after[end] - total)
        for i in (piece,) if isinstance(piece, int) else piece:
            out[i] += share


def _log_sum(terms: list[float]) -> float:
    if not terms:
        return -math.inf
    most = max(terms)
    return most if most == -math.inf else most + math.log(sum([math.exp(t - most) for t in terms]))
