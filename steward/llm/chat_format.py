r"""Chat formatting with offset-aligned loss masks (operator 13).

The rows of a conversation, in order of turn, are rendered as one text: each turn is ``<turn>``, its role, a line feed, its
text, ``</turn>`` and a line feed. Backslashes and the two marks inside roles and texts (in roles line feeds, too) get a
backslash before them, which reading takes away again, so no text can end a turn or begin one. The whole text is encoded
once; the vocabulary is lossless on bytes, so lengths of tokens add up to the offsets of all. The spans of the texts to learn
from are sorted, and so are the tokens' offsets: binary search finds the first and the last token that each span meets, and the
span's own ends say which bytes of these two belong to it. A token that lies across a border therefore is under the mask with its
bytes inside the span only.

One shuffle brings the turns of a conversation together, sorted; what a task holds is a part of one conversation, whole turns of
``PART_CHARS`` characters or little more. Nearly all conversations have one part. Longer ones are cut between turns, where the
vocabulary's pattern always ends a token (a line feed between ``>`` and ``<``), so the parts' ids are those of the whole; no
conversation is cut off and none is gathered.

Defined results: a null role or text is empty; turns of equal number are ordered by role, then text, nulls first, and repeated
rows are turns each; rows with a null conversation id make one conversation with that id; a null turn comes first; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from steward.llm.columns import picked
from steward.llm.tokens import byte_lengths, decode, encode, vocabulary_path

OPEN, CLOSE, ESCAPE = "<turn>", "</turn>", "\\"
#: Characters from which a conversation goes on in another part.
PART_CHARS = 4_000_000
#: Characters of parts a task passes on at once.
BATCH_CHARS = 4_000_000

_CONTROL = re.compile(r"\\|</?turn>")
_ROLE_CONTROL = re.compile(r"\\|\n|</?turn>")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn>((?:[^\\\n]++|\\.)*+)\n((?:[^\\<]++|\\.|<(?!/?turn>))*+)</turn>\n", re.S)

FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()), T.StructField("part", T.LongType()),
        T.StructField("formatted", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss", T.ArrayType(T.StructType([
            T.StructField("first_token", T.LongType()), T.StructField("end_token", T.LongType()),
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        ]))),
    ]
)


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def rendered(turns: Iterable[tuple[str, str]], learn: frozenset[str]) -> tuple[str, list[tuple[int, int]]]:
    """The text of ``(role, text)`` turns, and the byte spans of the texts of roles to learn from, in order."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{OPEN}{_ROLE_CONTROL.sub(r'\\\g<0>', role)}\n"
        body = escaped(text)
        out += (head, body, CLOSE, "\n")
        at += len(head.encode())
        size = len(body.encode())
        if role in learn:
            spans.append((at, at + size))
        at += size + len(CLOSE) + 1
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` turns of a rendered text."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return turns


def masked_tokens(ends: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """``(first_token, end_token, start, end)`` for each of the sorted byte ``spans``: the tokens that have bytes of it, given where
    tokens end. An empty span has none."""
    starts = np.concatenate([[0], ends[:-1]])
    low, high = (np.array([s[k] for s in spans], dtype=np.int64) for k in (0, 1))
    first = np.searchsorted(ends, low, side="right")
    end = np.maximum(np.searchsorted(starts, high, side="left"), first)
    end[low == high] = first[low == high]
    return list(zip(first.tolist(), end.tolist(), low.tolist(), high.tolist(), strict=True))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         learn: Iterable[str] = ("assistant",), json_path: str | None = None,
                         ranks_path: str | None = None) -> DataFrame:
    """One row per conversation, or per part of a very long one: ``conv_id, part`` (from 0), ``formatted``, ``ids`` and ``loss``.

    ``loss`` has the tokens and the bytes, within the part, of each text of the roles in ``learn``. Rows of a conversation come in
    order of part and in the same partition. The paths name one vocabulary as JSON and as merge ranks.
    """
    wanted = frozenset(learn)
    json_path = json_path or vocabulary_path("byte_bpe_50k.json")
    ranks_path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")
    schema = to_arrow_schema(FORMATTED)

    def row(conv, part, held):
        formatted, spans = rendered(held, wanted)
        ids = np.array(encode(formatted, json_path, ranks_path), dtype=np.int32)
        ends = np.cumsum(byte_lengths(ranks_path)[ids])
        loss = [dict(zip(("first_token", "end_token", "start", "end"), m, strict=True)) for m in masked_tokens(ends, spans)]
        return conv, part, formatted, ids, loss

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0
        held, chars, now, part = [], 0, None, 0
        for batch in batches:
            for conv, who, said in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if held and (conv != now or chars >= PART_CHARS):
                    ready.append(row(now, part, held))
                    size += chars
                    part = part + 1 if conv == now else 0
                    held, chars = [], 0
                    if size >= BATCH_CHARS:
                        yield _batch(ready, schema)
                        ready, size = [], 0
                now = conv
                held.append((who or "", said or ""))
                chars += len(said or "")
        if held:
            ready.append(row(now, part, held))
        if ready:
            yield _batch(ready, schema)

    rows = picked(turns, conv_id=conv_id, turn=turn, role=role, text=text).withColumn("conv_id", F.col("conv_id").cast("long"))
    together = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return together.select("conv_id", "role", "text").mapInArrow(write, FORMATTED)


DIGEST = T.StructType(
    [
        T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_loss_tokens", T.LongType()),
    ]
)


class _Reading:
    """Counts and checksums of one conversation, part by part."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.tokens = self.loss_tokens = 0

    def add(self, formatted: str, ids: np.ndarray, loss: list[dict], ranks_path: str) -> None:
        for role, said in read_turns(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        self.chars += len(formatted)
        self.tokens += len(ids)
        begins = np.concatenate([[0], np.cumsum(byte_lengths(ranks_path)[ids])])
        for span in loss:
            first, end = span["first_token"], span["end_token"]
            shown = decode(ids[first:end].tolist(), ranks_path)
            at = int(begins[first])
            learned = unescaped(shown[span["start"] - at : span["end"] - at].decode())
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
            self.loss_tokens += end - first

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.tokens,
                self.loss_tokens)


def digests(formatted: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """What :func:`format_conversations` gives, read back, one row per conversation: turns from the text, and what is to be
    learned from the tokens under the mask."""
    ranks_path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")
    schema = to_arrow_schema(DIGEST)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Reading | None = None
        for batch in batches:
            done = []
            columns = (batch[c] for c in ("conv_id", "part", "formatted", "ids", "loss"))
            for conv, part, text, ids, loss in zip(*columns, strict=True):
                if part.as_py() == 0:
                    if now:
                        done.append(now.row())
                    now = _Reading(conv.as_py())
                now.add(text.as_py(), ids.values.to_numpy(), loss.as_py(), ranks_path)
            if done:
                yield _batch(done, schema)
        if now:
            yield _batch([now.row()], schema)

    return formatted.mapInArrow(read, DIGEST)
