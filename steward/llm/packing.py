"""Bulk-synchronous best-fit packing of token sequences (operator 5).

Documents become token ids; those longer than a sequence are cut into full ones and a shorter first piece. Pieces and the
gaps of open sequences are both kept sorted by size, as runs: pieces of one length are ranked across all partitions, and
sequences with one gap are a range of numbers. A superstep takes the longest open length, sweeps the sorted gaps for its
successors (the smallest gaps that hold it), gives the pieces of that length places there in order of rank, the lowest ranks
in the tightest gap, updates the gaps and goes on with what is left; pieces that no gap holds open new sequences. Since there
are only as many lengths as a sequence has tokens, a superstep works on runs and not on rows: the runs are the counts of each
length, 1024 numbers, and rows meet the plan once, when every piece looks up the run its rank falls into. Ranks settle all
conflicts, so the result is that of sequential best-fit decreasing over the whole corpus.

Defined results: a null or empty text is its end token only; repeated rows are packed each for itself; pieces of one length are
alike, and where they lie in the input decides which goes where; the name of a special token in a text is that token, as the
vocabulary file has it; very long texts are cut and nothing of them lost; a null id stays null; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from steward.llm.columns import picked
from steward.llm.tokens import encode, vocabulary_path
from steward.session import stored

SEQUENCE_TOKENS = 1024
END_ID = 2


@dataclass(frozen=True)
class Plan:
    """Where runs of pieces go. Run ``i`` holds the pieces of one length with ranks from ``first_rank[i]``; rank
    ``first_rank + j`` goes to sequence ``first_sequence + j // each``, as number ``j % each`` of the run there."""

    key: np.ndarray
    first_sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int


#: Ranks in a plan's keys stay below this.
RANKS = 1 << 48


def best_fit_plan(counts: dict[int, int], capacity: int = SEQUENCE_TOKENS) -> Plan:
    """Place ``counts[length]`` pieces of each length into as few sequences of ``capacity`` as best-fit decreasing finds.

    The state is one list of sequence ranges per gap, in the order they got it, and the sorted list of the gaps that occur.
    """
    gaps: list[int] = []
    ranges: dict[int, list[tuple[int, int]]] = {}
    made = 0
    runs: list[tuple[int, int, int, int, int]] = []

    def opened(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in ranges:
                bisect.insort(gaps, gap)
                ranges[gap] = []
            ranges[gap].append((first, n))

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        rank, left = 0, counts[length]

        def fill(gap: int, first: int, n: int) -> int:
            """Pieces in rank order into up to ``n`` sequences of ``gap``; returns how many sequences were used."""
            nonlocal rank, left
            each = gap // length
            full, rest = min(n, left // each), 0
            if full:
                runs.append((length, rank, first, each, capacity - gap))
                rank, left = rank + full * each, left - full * each
                opened(gap - each * length, first, full)
            if left and full < n:
                rest, at = left, first + full
                runs.append((length, rank, at, rest, capacity - gap))
                rank, left = rank + rest, 0
                opened(gap - rest * length, at, 1)
            return full + bool(rest)

        while left:
            i = bisect.bisect_left(gaps, length)
            if i == len(gaps):
                made += fill(capacity, made, -(-left // (capacity // length)))
                break
            gap = gaps.pop(i)
            held = ranges.pop(gap)
            while held and left:
                first, n = held.pop()
                used = fill(gap, first, n)
                if used < n:
                    held.append((first + used, n - used))
            if held:
                if gap in ranges:
                    ranges[gap].extend(held)
                else:
                    bisect.insort(gaps, gap)
                    ranges[gap] = held
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    return Plan(table[:, 0] * RANKS + table[:, 1], table[:, 2], table[:, 3], table[:, 4], made)


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens; only the first may be shorter than ``capacity`` if there are more."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("chunk", T.IntegerType()),
        T.StructField("local_rank", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)


def token_pieces(docs: DataFrame, capacity: int, end_id: int, json_path: str, ranks_path: str | None, with_ids: bool) -> DataFrame:
    """The pieces of ``docs(doc_id, text)``, each with its rank among those of its length in its partition (``chunk``)."""
    schema = to_arrow_schema(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.array([*encode(text, json_path, ranks_path, names_are_text=False), end_id] if text else [end_id], dtype="<u4")
                for piece, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    part = ids[start : start + length]
                    held = part.astype("int32") if with_ids else None
                    rows.append((doc, piece, start, length, zlib.crc32(part.tobytes()), chunk, seen[length], held))
                    seen[length] += 1
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = SEQUENCE_TOKENS,
                   end_id: int = END_ID, vocabulary: str = "byte_bpe_50k", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, its ``ids``.

    The pieces are stored once, since counting and placing both read them. What comes to the driver are the counts of each
    length (``capacity`` numbers), and what is sent to the tasks is the plan, whose runs are at most a pair of lengths each.
    """
    json_path, ranks_path = (vocabulary_path(f"{vocabulary}.{kind}") for kind in ("json", "tiktoken"))
    source = picked(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    pieces = stored(token_pieces(source, capacity, end_id, json_path, ranks_path, with_ids), "pieces")

    per_chunk = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(counts, capacity)
    upto = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = per_chunk.select("length", "chunk", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "chunk"]).withColumn("rank", F.col("before") + F.col("local_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            run = np.searchsorted(plan.key, length * RANKS + rank, side="right") - 1
            number = rank - (plan.key[run] - length * RANKS)
            sequence = plan.first_sequence[run] + number // plan.each[run]
            offset = plan.offset[run] + number % plan.each[run] * length
            held = [batch[c] for c in columns]
            yield pa.record_batch([*held, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    placed = T.StructType([*[PIECES[c] for c in columns], *[T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]])
    return ranked.select(*columns, "rank").mapInArrow(place, placed)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with their ids: ``sequence_id, ids``; a group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
