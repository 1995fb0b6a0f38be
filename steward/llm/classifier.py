"""Quality classifier by nearest-neighbour voting in a latent-semantic space (operator 1).

Texts become vectors of hashed terms: words, word shapes (which show symbols, capitals and digits), and how often words come
back. A truncated singular value decomposition of the labelled vectors gives the latent space. The labelled vectors, a sample
whose size is a parameter, are broadcast; every document's cosines with all of them are computed block by block, exactly, and
the nearest vote with weights that grow with similarity. Nothing but the text goes into a score.

Defined results: a null or empty text, and one near no labelled vector, score the mean of the class shares, one half (and so are
predicted good: nothing speaks against them, and rules on length are the place to refuse them); without any label all texts score
one half; which of equal cosines at the last neighbour's place count is left to rounding; very long texts are read whole;
repeated rows score alike; labels of a repeated id are averaged; null labels and labels without a document teach nothing; other
columns stay as they are whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from steward.llm.columns import picked, quoted

WORD_TERMS, SHAPE_TERMS, RETURN_TERMS = 1024, 320, 32
TERMS = WORD_TERMS + SHAPE_TERMS + RETURN_TERMS
#: Labelled rows that may be broadcast, for each class: with LATENT dimensions of 4 bytes, 1 MB at most.
PER_CLASS = 2048
LATENT = 64
NEIGHBOURS = 25
#: A vote weighs its cosine to this power.
SHARPNESS = 16
#: Documents whose cosines a task computes at once.
BLOCK = 256
#: Words whose terms a worker remembers.
CACHED_WORDS = 150_000

_SHAPES = (
    (re.compile("[A-Z]{2,}"), "\x00"),
    (re.compile("[A-Z]"), "A"),
    (re.compile(r"(?:[a-z]|[^\W\d_A-Z])+"), "a"),
    (re.compile("[0-9]+"), "0"),
    (re.compile("\x00"), "AA"),
)


def shape(word: str) -> str:
    """A word with each run of letters or digits written as one sign, two for capitals."""
    for pattern, sign in _SHAPES:
        word = pattern.sub(sign, word)
    return word[:12]


class Terms:
    """Hashed terms of texts, with a cache of words."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def _of(self, word: str) -> tuple[int, int]:
        terms = (
            zlib.crc32(word.lower().encode()) % WORD_TERMS,
            WORD_TERMS + zlib.crc32(shape(word).encode()) % SHAPE_TERMS,
        )
        if len(self.known) >= CACHED_WORDS:
            self.known.clear()
        self.known[word] = terms
        return terms

    def vector(self, text: str | None) -> np.ndarray:
        """Three parts, each of length 1: words, shapes, and how often words come back."""
        out = np.zeros(TERMS, dtype=np.float32)
        words = (text or "").split()
        if not words:
            return out
        counts = Counter(words)
        known = self.known.get
        terms = [known(w) or self._of(w) for w in counts]
        times = np.fromiter(counts.values(), dtype=np.float32, count=len(counts))
        of_words, of_shapes = (np.fromiter((t[i] for t in terms), dtype=np.int64, count=len(terms)) for i in (0, 1))
        out[:WORD_TERMS] = np.bincount(of_words, np.log1p(times), minlength=WORD_TERMS)
        out[WORD_TERMS:] = np.sqrt(np.bincount(of_shapes - WORD_TERMS, times, minlength=TERMS - WORD_TERMS) / len(words))
        returns = np.bincount(np.minimum(np.log2(times).astype(np.int64), 15), times, minlength=16) / len(words)
        out[-RETURN_TERMS : -RETURN_TERMS + 16] = np.sqrt(returns)
        fresh = len(counts) / len(words)
        out[-16 + min(int(fresh * 16), 15)] = 1.0
        for part in (slice(0, WORD_TERMS), slice(WORD_TERMS, -RETURN_TERMS), slice(-RETURN_TERMS, None)):
            out[part] /= max(float(np.linalg.norm(out[part])), 1e-9)
        return out


@dataclass(frozen=True)
class Neighbours:
    """What is broadcast: the map into the latent space, and the labelled vectors in it."""

    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Similarity-weighted labels of the nearest labelled vectors, for a block of term vectors."""
        out = np.full(len(terms), 0.5)
        if not len(self.labels):
            return out
        cosines = _unit_rows(terms @ self.basis) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.clip(np.take_along_axis(cosines, nearest, axis=1), 0.0, None).astype(np.float64) ** SHARPNESS
        weight = votes.sum(axis=1)
        heard = weight > 1e-9
        out[heard] = np.clip((votes * self.labels[nearest]).sum(axis=1)[heard] / weight[heard], 0.0, 1.0)
        return out


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


_TERMS = Terms()


def fit(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
        per_class: int = PER_CLASS) -> Neighbours:
    """Learn from at most ``per_class`` labelled rows of each class: those whose ids have the least hashes, so that the sample
    is even, and the same on every run. Only their hashed terms come to the driver."""
    known = (
        picked(labels, doc_id=doc_id, label=label)
        .filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.avg(F.col("label").cast("double")).alias("label"))
        .join(picked(docs, doc_id=doc_id).distinct(), "doc_id", "left_semi")
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = [
        row
        for side in (F.col("label") >= 0.5, F.col("label") < 0.5)
        for row in known.filter(side).orderBy(*order).limit(per_class).collect()
    ]
    if not sample:
        return Neighbours(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in sample], "doc_id long, label double")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [_TERMS.vector(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], batch["label"], pa.array(vectors, pa.binary())], ["doc_id", "label", "terms"])

    held = (
        picked(docs, doc_id=doc_id, text=text)
        .join(F.broadcast(chosen), "doc_id")  # at most two classes of per_class ids
        .select("doc_id", "label", "text")
        .mapInArrow(terms_of, "doc_id long, label double, terms binary")
        .groupBy("doc_id")
        .agg(F.first("label").alias("label"), F.min("terms").alias("terms"))
        .orderBy("doc_id")
        .toArrow()
    )
    terms = np.frombuffer(b"".join(held["terms"].to_pylist()), dtype=np.float32).reshape(-1, TERMS)
    labels_ = held["label"].to_numpy()
    seen = (terms[:, :WORD_TERMS] > 0).sum(axis=0)
    weights = np.ones(TERMS, dtype=np.float32)
    weights[:WORD_TERMS] = 0.25 * np.log((1 + len(terms)) / (1 + seen)) / np.log(1 + len(terms))
    weighed = terms * weights
    _, axes = np.linalg.eigh((weighed.T @ weighed).astype(np.float64))
    basis = (weights[:, None] * axes[:, ::-1][:, :LATENT]).astype(np.float32)
    return Neighbours(basis, _unit_rows(terms @ basis).astype(np.float32), labels_)


def score_column(model: Broadcast, text: Column) -> Column:
    """The quality score of each text: blocks of documents against all broadcast vectors."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = np.zeros(len(texts))
            for at in range(0, len(texts), BLOCK):
                block = np.stack([_TERMS.vector(t) for t in texts.iloc[at : at + BLOCK]])
                out[at : at + BLOCK] = model.value.scores(block)
            yield pd.Series(out)

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", doc_id: str = "doc_id",
                   text: str = "text", threshold: float = 0.3, per_class: int = PER_CLASS) -> DataFrame:
    """``(doc_id, score, predicted)`` of every document; ``learn`` is a condition on the labels' ids."""
    model = fit(docs, labels.filter(learn), label, doc_id, text, per_class)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = picked(docs, doc_id=doc_id, text=text).select("doc_id", score_column(sent, F.col("text")).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_predicted(docs: DataFrame, model: Neighbours, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.filter(score_column(sent, quoted(text)) >= threshold)
