import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from steward.llm.bindings import crc_remainder
from steward.llm.lattice import add_expected, log_marginal, pieces, rank_weights
from steward.llm.lm_score import PRIOR, Spelling, given_spelling, learned_spelling, score_texts
from steward.llm.tokens import vocabulary_path
from tests.llm.rows import DOCS, documents

PATH = vocabulary_path("piece_bpe_32k.model")


def scored(df, **settings):
    return score_texts(df, crc_remainder(F.col("doc_id"), 5) == 1, **settings)


def spellings(unit, vocabulary, weights):
    """The probability of every segmentation, one by one."""
    out = {0: [1.0]}
    for end in range(1, len(unit) + 1):
        out[end] = []
        for start, piece in vocabulary.arcs(unit)[end]:
            ids = [piece] if piece >= 0 else vocabulary.byte_ids(unit[start])
            out[end] += [p * math.prod(math.exp(weights[i]) for i in ids) for p in out[start]]
    return out[len(unit)]


@pytest.mark.parametrize("unit", [" the", " erhaanti", " été", " 漢q▁", " a1,b"])
def test_marginal_sums_all_segmentations(unit):
    vocabulary = pieces(PATH)
    weights = rank_weights(vocabulary)
    assert math.isclose(sum(math.exp(w) for w in weights), 1.0)
    assert math.isclose(math.exp(log_marginal(unit, vocabulary, weights)), sum(spellings(unit, vocabulary, weights)), rel_tol=1e-9)


def segmentations(unit, vocabulary):
    """All ways to spell ``unit``, as lists of ids."""
    ways = {0: [[]]}
    for end in range(1, len(unit) + 1):
        ways[end] = []
        for start, piece in vocabulary.arcs(unit)[end]:
            ids = [piece] if piece >= 0 else vocabulary.byte_ids(unit[start])
            ways[end] += [[*way, *ids] for way in ways[start]]
    return ways[len(unit)]


def brute_expected(units, vocabulary, weights):
    out = Counter()
    for unit in units:
        ways = [(way, math.exp(sum(weights[i] for i in way))) for way in segmentations(unit, vocabulary)]
        total = sum(p for _, p in ways)
        for way, p in ways:
            for i in way:
                out[i] += p / total
    return out


UNITS = [" the", " erhaanti", " été", " 漢q▁", " a1,b", " and", " aaaa"]


def test_expected_counts_are_those_of_all_segmentations():
    vocabulary = pieces(PATH)
    _, given = given_spelling(PATH)
    want = brute_expected(UNITS, vocabulary, given.weights)
    got = [0.0] * len(given.weights)
    for unit in UNITS:
        add_expected(unit, vocabulary, given.weights, [math.exp(w) for w in given.weights], got)
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in range(len(got)))


def test_logarithms_and_probabilities_agree():
    vocabulary = pieces(PATH)
    _, given = given_spelling(PATH)
    unit = " " + "xqzjk" * 30  # its probability is below what sums of probabilities can tell
    half = " " + "xqzjk" * 6
    for text, small in ((unit, True), (half, False)):
        got = [0.0] * len(given.weights)
        add_expected(text, vocabulary, given.weights, [math.exp(w) for w in given.weights], got)
        by_logs = [0.0] * len(given.weights)
        add_expected(text, vocabulary, given.weights, [0.0] * len(given.weights), by_logs)
        assert all(math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-12) for a, b in zip(got, by_logs, strict=True)), small
        lengths = sum(n * len(vocabulary.spelled[i]) for i, n in enumerate(got))
        assert math.isclose(lengths, len(text), rel_tol=1e-6)


def test_learning_raises_the_likelihood_and_ends_add_up(spark):
    words = sorted({w.encode() for _, t, _, _ in DOCS for w in (t or "").lower().split() if len(w) < 30})
    counts = spark.createDataFrame([(w, 1) for w in words] + [(b"unseen", 0)], "word binary, c long").repartition(3)
    vocabulary = pieces(PATH)
    shares, given = given_spelling(PATH)
    learned = learned_spelling(counts, PATH)
    likelihood = lambda s: sum(s.log_probability(w.decode(), vocabulary) for w in words)
    assert likelihood(learned) > likelihood(given) + 0.5 * len(words)
    goes_on = sum(map(math.exp, learned.weights))
    ends = 1 - goes_on
    assert math.isclose(learned.end, math.log(ends / goes_on), rel_tol=1e-6)
    want = brute_expected([" " + w.decode() for w in words[:40]], vocabulary, given.weights)
    few = learned_spelling(spark.createDataFrame([(w, 2) for w in words[:40]], "word binary, c long"), PATH)
    total = sum(want.values())
    for i, n in want.items():
        share = (n + PRIOR * shares[i]) / (total + PRIOR)
        stop = (40 + PRIOR / 2) / (total + PRIOR)
        assert math.isclose(few.weights[i], math.log(share * (1 - stop)), rel_tol=1e-9)
    assert isinstance(few, Spelling) and learned_spelling(counts.filter("c < 0"), PATH) == given


def brute(docs, spelling):
    tokens = [(t or "").encode().lower().split() for _, t, _, _ in docs]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _, _, _ in docs]
    counts = Counter(w for words, h in zip(tokens, held) if not h for w in [*words, None])
    n, v = sum(counts.values()), len(counts)
    vocabulary = pieces(PATH)

    def full(word):
        c = counts[word]
        whole = (c - 0.5) / n if c else 0.0
        if word is None:
            return math.log10(whole)
        return math.log10(whole + 0.5 * v / n * math.exp(spelling.log_probability(word.decode(), vocabulary)))

    out = []
    for (doc, _, _, _), words, h in zip(docs, tokens, held):
        all_ = [*words, None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in all_)
        out.append((doc, h, len(all_), sum(counts[w] > 0 for w in all_), n, base, sum(map(full, all_))))
    return out


@pytest.mark.parametrize("broadcast", [0, 40, 200_000])
def test_scores_are_those_of_a_plain_sum(spark, broadcast):
    docs = [d for d in DOCS if d[0] not in (10, 14)] + [(100 + i, f"the und é{i} new{i}", "en", "a") for i in range(30)]
    got = scored(documents(spark, docs), broadcast_words=broadcast)
    trained = {w for d, t, _, _ in docs if d is None or zlib.crc32(str(d).encode()) % 5 != 1 for w in (t or "").encode().lower().split()}
    spelling = learned_spelling(spark.createDataFrame([(w, 1) for w in trained], "word binary, c long"), PATH)
    key = lambda r: ((r[0] is not None, r[0]), r[5])
    rows = sorted(map(tuple, got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=key)
    for a, b in zip(rows, sorted(brute(docs, spelling), key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_long_words_and_no_training(spark):
    rows = [(i, "x" * 60_000, "en", "a") for i in range(20) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = scored(documents(spark, rows)).collect()
    assert len(got) == len(rows) and all(math.isfinite(r["score"]) and r["train_tokens"] == 0 and r["n_known"] == 0 for r in got)


def test_empty_table(spark):
    assert scored(documents(spark, [])).count() == 0
