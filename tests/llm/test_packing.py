import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from steward.llm.packing import best_fit_plan, cut_points, pack_documents, sequences
from steward.llm.tokens import encode, vocabulary_path
from tests.llm.rows import DOCS, documents, prose

JSON, RANKS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("byte_bpe_50k.tiktoken")


def best_fit_decreasing(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, length)
        n += i == len(gaps)
        gap = capacity if i == len(gaps) else gaps.pop(i)
        if gap - length:
            bisect.insort(gaps, gap - length)
    return n


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([8, 30, 100, 1024]))
    lengths = np.clip(rng.lognormal(rng.uniform(0, 6), 1, int(rng.integers(1, 3000))).astype(int) + 1, 1, capacity)
    counts = Counter(lengths.tolist())
    plan = best_fit_plan(counts, capacity)
    assert plan.sequences == best_fit_decreasing(lengths.tolist(), capacity)
    used = defaultdict(list)
    for length, n in counts.items():
        for rank in range(n):
            run = np.searchsorted(plan.key, length * (1 << 48) + rank, side="right") - 1
            j = rank - (plan.key[run] - length * (1 << 48))
            used[plan.first_sequence[run] + j // plan.each[run]].append((plan.offset[run] + j % plan.each[run] * length, length))
    assert len(used) == plan.sequences
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_cut_points():
    assert cut_points(10, 4) == [(0, 2), (2, 4), (6, 4)]
    assert cut_points(8, 4) == [(0, 4), (4, 4)] and cut_points(3, 4) == [(0, 3)]


def test_both_ways_to_encode_agree():
    plain = Tokenizer.from_file(JSON)
    plain.encode_special_tokens = True
    texts = [t for _, t, _, _ in DOCS if t] + ["<|endoftext|> x", "a\r\n\r\n  b\t\tc", "don't 1234567 ½ ǅ", " " * 3000 + "x", prose(4, 3000)]
    for text in texts:
        assert encode(text, JSON, RANKS) == plain.encode(text, add_special_tokens=False).ids == encode(text, JSON, None)


def test_names_of_special_tokens_are_those_tokens_in_packing(spark):
    as_loaded = Tokenizer.from_file(JSON)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext", "x<|endoftext|><|endoftext|>y", "plain"]
    for text in texts:
        ids = as_loaded.encode(text, add_special_tokens=False).ids
        assert encode(text, JSON, RANKS, names_are_text=False) == ids == encode(text, JSON, None, names_are_text=False)
    assert encode(texts[0], JSON, RANKS, names_are_text=False) == [64, 220, 50256, 275]
    packed = pack_documents(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), with_ids=True)
    assert {r["doc_id"]: list(r["ids"]) for r in packed.collect()} == {
        i: [*as_loaded.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)
    }


def test_pieces_and_places(spark, odd_documents):
    capacity = 64
    packed = pack_documents(odd_documents, capacity=capacity, with_ids=True)
    rows = packed.collect()
    want = Counter()
    for doc, text, _, _ in DOCS:
        ids = [*encode(text or "", JSON, RANKS), 2]
        for piece, (start, length) in enumerate(cut_points(len(ids), capacity)):
            part = np.array(ids[start : start + length], "<u4")
            want[doc, piece, start, length, zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], list(r["ids"])))
    assert len(by_sequence) == best_fit_decreasing([r["length"] for r in rows], capacity)
    whole = {r["sequence_id"]: list(r["ids"]) for r in sequences(packed).collect()}
    for sequence, parts in by_sequence.items():
        ids = [i for _, _, part in sorted(parts) for i in part]
        assert [o for o, _, _ in sorted(parts)] == np.cumsum([0, *[n for _, n, _ in sorted(parts)]])[:-1].tolist()
        assert len(ids) <= capacity and whole[sequence] == ids


def test_empty_table(spark):
    assert pack_documents(documents(spark, [])).count() == 0
