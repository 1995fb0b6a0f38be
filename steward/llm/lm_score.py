"""Language-model scores by subword lattice likelihood (operator 3).

A text is a sequence of words and an end; a word's probability is that of all its segmentations. The arcs of its lattice are
the pieces of a public vocabulary and one arc for the whole word, weighted by how often the training documents have it:
``(c - d) / N`` for a word seen ``c`` times in ``N`` training tokens, where the discount ``d`` leaves ``d * V / N`` for the
spelled ones. Pieces start with the vocabulary's scores as weights. They are then estimated anew from the corpus: forward and
backward sums over the lattices of all distinct training words tell how often each piece is expected, and how many pieces a word
has. After each piece the word ends with a fixed chance, so spellings of all lengths add up to 1. A forward recursion in log
space sums over the segmentations. No piece reaches across words, so the marginal probability of a text is the product over
its words, and each word is worked out once.

What is gathered from the corpus is the count of every word, and from the distinct ones the expected count of every piece. The most frequent words, at most ``BROADCAST_WORDS``, are sent to
all tasks; the others are joined by a shuffle of the rarer words of each document. Both ways use the same numbers.

Defined results: null and empty texts are an end only; without training documents no token is known, and all mass is spelled, by
the vocabulary's scores; very long texts and words are taken whole; repeated rows are scored and counted each; a null id is scored, and belongs to training; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from steward.llm.columns import picked
from steward.llm.lattice import Pieces, add_expected, log_marginal, pieces, rank_weights
from steward.llm.tokens import vocabulary_path
from steward.session import stored

#: Words sent to every task: about 20 bytes each on the way, 200 in a worker.
BROADCAST_WORDS = 200_000
#: Distinct words a worker counts before it passes them on.
COUNTED_AT_ONCE = 400_000
DISCOUNT = 0.5
#: Pieces that the vocabulary's own weights count for when weights are estimated.
PRIOR = 1000.0
#: Pieces whose sums are passed on together.
PIECES_AT_ONCE = 1024


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased; the methods of ``bytes`` do exactly this."""
    return (text or "").encode().lower().split()


COUNTED = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("c", T.LongType())])


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)``: every word of ``docs(text, in_training)`` with its count in training texts, 0 if only others have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "c"])
            seen.clear()
            return batch

        for batch in batches:
            for text, in_training in zip(batch["text"].to_pylist(), batch["in_training"].to_pylist(), strict=True):
                if in_training:
                    seen.update(tokens(text))
                else:
                    for word in set(tokens(text)):
                        seen.setdefault(word, 0)
                if len(seen) > COUNTED_AT_ONCE:
                    yield out()
        yield out()

    return docs.select("text", "in_training").mapInArrow(count, COUNTED).groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Spelling:
    """Natural log weights of the pieces, each with the chance that the word goes on after it, and what ending adds."""

    weights: list[float]
    end: float

    @staticmethod
    def of(shares: list[float], ends: float) -> Spelling:
        """From the pieces' shares, which add up to 1, and the chance that a word ends after a piece."""
        return Spelling([math.log(p * (1 - ends)) if p else -math.inf for p in shares], math.log(ends / (1 - ends)))

    def log_probability(self, word: str, vocabulary: Pieces) -> float:
        return log_marginal(" " + word, vocabulary, self.weights) + self.end


def given_spelling(path: str) -> tuple[list[float], Spelling]:
    """The shares of the pieces by the vocabulary's scores, and the spelling with these: half of the pieces end a word."""
    shares = [math.exp(w) for w in rank_weights(pieces(path))]
    return shares, Spelling.of(shares, 0.5)


EXPECTED = T.StructType(
    [T.StructField("block", T.IntegerType()), T.StructField("n", T.ArrayType(T.DoubleType())), T.StructField("words", T.LongType())]
)


def learned_spelling(counts: DataFrame, path: str) -> Spelling:
    """The spelling estimated from the distinct words of ``counts`` that training has, each taken once: what the lattice is needed for
    are words that it lacks, which are like the rare ones. The given shares count like ``PRIOR`` pieces.

    Each task adds up what its words lead to expect and passes on blocks of these sums, which are as many as there are pieces.
    """
    shares, given = given_spelling(path)
    size = -(-len(shares) // PIECES_AT_ONCE)
    schema = to_arrow_schema(EXPECTED)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, chances = pieces(path), [math.exp(w) for w in given.weights]
        out, words = [0.0] * len(chances), 0
        for batch in batches:
            for word in batch["word"].to_pylist():
                add_expected(" " + word.decode(), vocabulary, given.weights, chances, out)
                words += 1
        if words:
            parts = [out[i * PIECES_AT_ONCE : (i + 1) * PIECES_AT_ONCE] for i in range(size)]
            rows = [range(size), parts, [words] * size]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema)

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.array(n) for n in table["n"].to_pylist()], axis=0)
        rows = [[table["block"][0].as_py()], [total.tolist()], [sum(table["words"].to_pylist())]]
        return pa.table([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    parts = counts.filter("c > 0").select("word").mapInArrow(expect, EXPECTED)
    sums = {r["block"]: r for r in parts.groupBy("block").applyInArrow(add, EXPECTED).collect()}
    if not sums:
        return given
    expected = [n for block in range(size) for n in sums[block]["n"]]
    total, words = sum(expected), sums[0]["words"]
    learned = [(n + PRIOR * p) / (total + PRIOR) for n, p in zip(expected, shares, strict=True)]
    return Spelling.of(learned, (words + PRIOR / 2) / (total + PRIOR))


class Model:
    """Log10 terms of a token with ``c`` training occurrences: plain add-half, and discounted with the lattice below."""

    def __init__(self, train_tokens: int, distinct: int, path: str, spelling: Spelling):
        self.n, self.path, self.spelling = train_tokens, path, spelling
        self.base_norm = train_tokens + 0.5 * (distinct + 1)
        self.left = DISCOUNT * distinct / train_tokens if train_tokens else 1.0

    def base(self, c: int) -> float:
        return math.log10((c + 0.5) / self.base_norm)

    def word(self, word: bytes, c: int) -> float:
        spelled = math.log(self.left) + self.spelling.log_probability(word.decode(), pieces(self.path))
        if not c:
            return spelled / math.log(10)
        whole = math.log((c - DISCOUNT) / self.n)
        low, high = sorted((spelled, whole))
        return (high + math.log1p(math.exp(low - high))) / math.log(10)

    def end(self, c: int) -> float:
        """An end has no spelling; where none was seen it takes what is left."""
        return math.log10((c - DISCOUNT) / self.n if c else self.left)


TERMS = T.StructType(
    [T.StructField("word", T.BinaryType()), T.StructField("c", T.LongType()), T.StructField("base", T.DoubleType()),
     T.StructField("full", T.DoubleType())]
)
SCORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("full", T.DoubleType()),
        T.StructField("row", T.LongType()),
        T.StructField("rare", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())]))),
    ]
)


def word_terms(counts: DataFrame, model: Model) -> DataFrame:
    """``counts`` with the two log10 terms of each word; the lattice of each is worked out once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, cs = batch["word"].to_pylist(), batch["c"].to_pylist()
            columns = [batch["word"], batch["c"], pa.array(map(model.base, cs), pa.float64()),
                       pa.array(map(model.word, words, cs), pa.float64())]
            yield pa.record_batch(columns, TERMS.names)

    return counts.select("word", "c").mapInArrow(work, TERMS)


def _frequent(counts: DataFrame, at_most: int) -> int:
    """The least count such that no more than ``at_most`` words have it; counts of counts are few numbers."""
    by_size = counts.filter("c > 0").groupBy(F.length(F.bin("c")).alias("bits")).agg(F.count("*").alias("n"))
    total, least = 0, None
    for bits, n in sorted(((r["bits"], r["n"]) for r in by_size.collect()), reverse=True):
        if total + n > at_most:
            break
        total, least = total + n, 1 << (bits - 1)
    return least if least is not None else 1 << 62


def score_texts(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
                vocabulary: str = "piece_bpe_32k.model", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out`` is a condition on ``doc_id``; the model learns from the rows where it is not true.
    """
    spark, path = docs.sparkSession, vocabulary_path(vocabulary)
    rows = picked(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    counts = stored(word_counts(rows.withColumn("in_training", ~F.col("held_out"))), "word-counts")
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = rows.filter(~F.col("held_out")).count()
    model = Model(facts["n"] + ends, facts["v"] + (ends > 0), path, learned_spelling(counts, path))

    terms = stored(word_terms(counts, model), "word-terms")
    least = _frequent(counts, broadcast_words)
    frequent = terms.filter(F.col("c") >= least).toArrow()
    known = spark.sparkContext.broadcast(
        dict(zip(frequent["word"].to_pylist(), zip(frequent["base"].to_pylist(), frequent["full"].to_pylist(), strict=True),
                 strict=True))
    )
    schema = to_arrow_schema(SCORED)
    end = (int(ends > 0), model.base(ends), model.end(ends))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = known.value.get
        for batch in batches:
            out = []
            for doc, held, whole, row in zip(*(batch[c].to_pylist() for c in ("doc_id", "held_out", "text", "row")), strict=True):
                words = tokens(whole)
                n_known, base, full = end
                rare = []
                for word, times in Counter(words).items():
                    at = of(word)
                    if at is None:
                        rare.append((word, times))
                    else:
                        n_known += times
                        base += times * at[0]
                        full += times * at[1]
                out.append((doc, held, len(words) + 1, n_known, base, full, row, [{"word": w, "times": t} for w, t in rare]))
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    first = stored(numbered.mapInArrow(score, SCORED), "frequent-scores")
    rest = (
        first.select("row", F.inline("rare"))
        .join(terms.filter(F.col("c") < least), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.col("base")).alias("more_base"),
            F.sum(F.col("times") * F.col("full")).alias("more_full"),
        )
    )
    return first.drop("rare").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("full") + F.coalesce("more_full", F.lit(0.0))).alias("score"),
    )
