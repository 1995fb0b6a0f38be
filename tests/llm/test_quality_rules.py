import re
from collections import Counter

import pytest

from steward.llm.quality_rules import RATIOS, fences, keep_good, quality_verdicts, sketches, text_counts
from tests.llm.rows import DOCS, bag, documents

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_are_those_of_a_plain_count(odd_documents):
    got = quality_verdicts(odd_documents)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = []
    for doc, text, _, _ in DOCS:
        n = brute(text)
        want.append((doc, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
    assert bag(got, *columns) == sorted(want, key=lambda r: [(v is not None, v) for v in r])


def test_small_texts_with_windows_at_the_edges(spark):
    texts = ["a b c a b c", "a a a", "a a a a", "a b a b a b", "a b c d a b c", "x y", "a b c x a b c y a b"]
    got = text_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string"))
    assert [r["n_repeat_words"] for r in got.orderBy("id").collect()] == [brute(t)[4] for t in texts]


def test_fences_follow_each_group_and_stay_in_the_corridor(spark):
    # Half of the words of source "code" carry a symbol; of source "text" none does.
    plain, marked = "alpha beta gamma delta epsilon " * 1, "alpha# beta gamma# delta "
    rows = []
    for i in range(30):
        rows.append((i, " ".join(f"{w}{j}" for j in range(12) for w in plain.split()), "en", "text"))
        rows.append((100 + i, " ".join(f"{j}{w}" for j in range(14) for w in marked.split()), "en", "code"))
    rows.append((200, " ".join(f"{w}{j}" for j in range(14) for w in marked.split()), "en", "text"))
    docs = documents(spark, rows)
    limits = {r["source"]: r for r in fences(sketches(text_counts(docs)), min_group=20).collect()}
    symbols = RATIOS[0]
    assert limits["text"]["symbols_fence"] == symbols.lowest_fence
    assert limits["code"]["symbols_fence"] == symbols.highest_fence  # 500 per mille is beyond the corridor
    kept = {r["doc_id"]: r["kept"] for r in quality_verdicts(docs, min_group=20).collect()}
    assert all(kept[i] for i in range(30)) and not kept[200] and not any(kept[100 + i] for i in range(30))


def test_small_groups_take_the_fence_above(spark):
    rows = [(i, " ".join(f"w{j}x{i}" for j in range(60)), "en", f"s{i % 7}") for i in range(40)]
    limits = fences(sketches(text_counts(documents(spark, rows))), min_group=1000).collect()
    assert len(limits) == 7 and len({tuple(r)[2:] for r in limits}) == 1


def test_keep_good_returns_the_rows_as_they_are(odd_documents):
    kept = keep_good(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert {0, 1, 2, 3, 10}.issubset(ids) and not {5, 6, 7, 8, 12, 13}.intersection(ids) and ids.count(10) == 2


def test_empty_table(spark):
    empty = documents(spark, [])
    assert quality_verdicts(empty).count() == 0 and keep_good(empty).count() == 0


@pytest.mark.parametrize("column", ["kept", "base_failed"])
def test_verdicts_are_never_null(odd_documents, column):
    assert quality_verdicts(odd_documents).filter(f"{column} IS NULL").count() == 0


def marked(i, per_mille):
    """A text of 200 different words, of which so many carry a symbol."""
    return " ".join(f"word{i}x{j}" + ("#" if j < per_mille * 200 // 1000 else "") for j in range(200))


def test_a_quantile_decides_where_it_lies_in_the_corridor(spark):
    """Quartiles of 100 and 140 per mille give a fence of 260, between the corridor's ends of 100 and 300: rows on both sides of it
    lie inside the corridor, so that it is the group's own quantiles that keep the one and reject the other."""
    shares = [100] * 40 + [120] * 20 + [140] * 35 + [255, 260, 265, 290, 300]
    rows = [(i, marked(i, s), "en", "code") for i, s in enumerate(shares)]
    # Another source has the same rows beside many without a symbol: its quartiles are 0, and all those rows go.
    rows += [(1000 + i, marked(i, s), "en", "prose") for i, s in enumerate(shares)]
    rows += [(2000 + i, marked(i, 0), "en", "prose") for i in range(500)]
    docs = documents(spark, rows)
    limits = {r["source"]: r["symbols_fence"] for r in fences(sketches(text_counts(docs)), min_group=50).collect()}
    assert limits == {"code": 4 * 140 - 3 * 100, "prose": RATIOS[0].lowest_fence}
    kept = {r["doc_id"]: r["kept"] for r in quality_verdicts(docs, min_group=50).collect()}
    assert {shares[i] for i in range(100) if not kept[i]} == {265, 290, 300} and kept[96]
    assert {shares[i] for i in range(100) if kept[1000 + i]} == {100} and all(kept[2000 + i] for i in range(500))
