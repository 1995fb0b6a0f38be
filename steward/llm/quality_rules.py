"""Quality rules with thresholds that adapt to each language and source (operator 9).

Per text, counts of words, symbols, repeated lines and repeated word windows are worked out in place, with SQL functions
only. Their ratios go into quantile sketches: counts per bucket of a fixed log-linear grid. Such sketches merge by adding
counts, so the ones of a source add up to those of its language and of the corpus, in any order and after any retry, with the
same result. A document is rejected where a ratio lies beyond the fence of its own group.

Defined results: a null text counts as empty; a text without words has zero counts and fails the base rule; a null language
or source is a group of its own; repeated rows are judged one by one, and alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from steward.llm.columns import aside, bound, picked, quoted
from steward.session import stored

#: White space between words, as a regular expression class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"

#: Buckets are exact below 2**GRID_BITS; above, this many leading bits are kept.
GRID_BITS = 10


@dataclass(frozen=True)
class Ratio:
    """A ratio ``per_mille`` of two counts, and the corridor its adaptive upper fence must stay in."""

    name: str
    count: str
    base: str
    lowest_fence: int
    highest_fence: int


RATIOS = (
    Ratio("symbols", "n_symbols", "n_words", 100, 300),
    Ratio("dup_lines", "n_dup_lines", "n_lines", 400, 700),
    Ratio("repeats", "n_repeat_words", "n_words", 400, 500),
    Ratio("word_length", "word_chars", "n_words", 9_000, 20_000),
)

#: Rows that pass the base rules, for a group to have a fence of its own; smaller ones take their language's or the corpus's.
MIN_GROUP = 200


def words_of(text: Column) -> Column:
    """The words of a text in order, as an array."""
    return F.array_remove(F.split(text, SPACE_CLASS), "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice, first occurrences included.

    Windows are sorted by hash; those with an equal neighbour are repeated, and the positions they cover are counted.
    """

    def covered(ordered: Column) -> Column:
        twins = F.filter(
            F.transform(
                ordered,
                lambda x, k: F.when((F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"]), x["i"]),
            ),
            lambda i: i.isNotNull(),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(twins, lambda i: F.array(i, i + 1, i + 2)))))

    def counted(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), bound(placed, covered))

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.coalesce(F.when(F.size(words) >= 3, bound(hashes, counted)), F.lit(0)).cast("long")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of each text: ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines`` and
    ``n_repeat_words``. Columns of these names are replaced."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")

    def word_counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def line_counts(ls: Column) -> Column:
        return F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        )

    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    held = [quoted(c) for c in docs.columns if c not in counts]
    of_words, of_lines, of_symbols = aside(docs.columns, "_words", "_lines", "_symbols")
    found = F.struct(
        bound(words_of(whole), word_counts).alias(of_words),
        bound(lines, line_counts).alias(of_lines),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias(of_symbols),
    )
    # Each text is counted where a row is generated of it: as columns, the counts would be worked out wherever one is used.
    w, ls = quoted(of_words), quoted(of_lines)
    return docs.select(*held, F.inline(F.array(found))).select(
        *held, w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), quoted(of_symbols).alias("n_symbols"),
        ls["n_lines"].alias("n_lines"), ls["n_dup_lines"].alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
    )


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col(n_words) < 50) | (100 * F.col(n_repeat_words) > 50 * F.col(n_words))


def ratio_value(ratio: Ratio) -> Column:
    """The ratio in thousandths, rounded down; 0 where there is nothing to divide by."""
    return F.expr(f"CASE WHEN {ratio.base} > 0 THEN (1000 * {ratio.count}) DIV {ratio.base} ELSE 0 END")


def bucket(value: Column) -> Column:
    """The lower end of a value's bucket: the value itself, or its ``GRID_BITS`` leading bits."""
    cut = F.greatest(F.length(F.bin(value)) - GRID_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Quantile sketches ``(lang, source, metric, at, n)`` of the rows that pass the base rules."""
    metrics = F.array(*[F.struct(F.lit(r.name).alias("metric"), bucket(ratio_value(r)).alias("at")) for r in RATIOS])
    return (
        counted.filter(~base_failed())
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(metrics).alias("m"))
        .groupBy("lang", "source", "m.metric", "m.at")
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (lang, source) with the upper fence of each ratio: the upper quartile plus three quartile ranges, kept
    inside the ratio's corridor. Groups below ``min_group`` rows take the fence of the merged sketch above them."""
    levels = {
        "own": ["lang", "source"],
        "wide": ["lang"],
        "all": [],
    }
    at = {}
    for level, keys in levels.items():
        merged = sketch.groupBy(*keys, "metric", "at").agg(F.sum("n").alias("n"))
        whole = Window.partitionBy(*keys, "metric")
        run = merged.withColumns(
            {"upto": F.sum("n").over(whole.orderBy("at")), "rows": F.sum("n").over(whole)}
        )
        at[level] = run.groupBy(*keys, "metric").agg(
            F.max("rows").alias(f"{level}_rows"),
            F.min(F.when(4 * F.col("upto") >= F.col("rows"), F.col("at"))).alias(f"{level}_q1"),
            F.min(F.when(4 * F.col("upto") >= 3 * F.col("rows"), F.col("at"))).alias(f"{level}_q3"),
        )
    own, wide, every = at["own"].alias("o"), at["wide"].alias("w"), at["all"].alias("a")
    joined = own.join(wide, F.expr("o.lang <=> w.lang AND o.metric = w.metric")).join(every, F.expr("o.metric = a.metric"))
    low, high = (
        F.coalesce(*[F.when(F.col("o.metric") == r.name, F.lit(getattr(r, end))) for r in RATIOS])
        for end in ("lowest_fence", "highest_fence")
    )
    fence = F.expr(
        f"CASE WHEN own_rows >= {min_group} THEN 4 * own_q3 - 3 * own_q1 "
        f"WHEN wide_rows >= {min_group} THEN 4 * wide_q3 - 3 * wide_q1 ELSE 4 * all_q3 - 3 * all_q1 END"
    )
    kept = joined.select(
        F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), F.col("o.metric").alias("metric"),
        F.least(F.greatest(fence, low), high).alias("fence"),
    )
    return kept.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == r.name, F.col("fence"))).alias(f"{r.name}_fence") for r in RATIOS]
    )


def judged(counted: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept``; a row whose group has no fence fails the base rules itself.

    ``limits`` should be stored: Spark then knows how small it is before it plans the join, and shuffles no text for it.
    """
    group_lang, group_source, *edges = aside(counted.columns, "_lang", "_source", *[f"_{r.name}" for r in RATIOS])
    renamed = picked(limits, **{group_lang: "lang", group_source: "source"},
                     **{edge: f"{r.name}_fence" for edge, r in zip(edges, RATIOS, strict=True)})
    same = counted[lang].eqNullSafe(renamed[group_lang]) & counted[source].eqNullSafe(renamed[group_source])
    within = F.lit(True)
    for edge, r in zip(edges, RATIOS, strict=True):
        within = within & F.coalesce(ratio_value(r) <= quoted(edge), F.lit(True))
    out = counted.join(renamed, same, "left").withColumns({"base_failed": base_failed(), "kept": ~base_failed() & within})
    return out.drop(group_lang, group_source, *edges)


def quality_verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
                     min_group: int = MIN_GROUP) -> DataFrame:
    """One row per document: id, language, source, counts, ``base_failed`` and ``kept``.

    The counts are stored once, without the texts, since the sketches and the verdicts both read them.
    """
    narrow = picked(docs, doc_id=doc_id, lang=lang, source=source, text=text)
    counted = stored(text_counts(narrow).drop("text"), "quality-counts")
    return judged(counted, stored(fences(sketches(counted), min_group), "quality-fences"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
              min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are.

    The counts are worked out twice, for the sketches and for the verdicts, so that no text is shuffled or copied.
    """
    packed = docs.select(
        F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"),
        quoted(text).alias("text"), quoted(lang).alias("lang"), quoted(source).alias("source"),
    )
    limits = stored(fences(sketches(text_counts(packed.select("text", "lang", "source"))), min_group), "quality-fences")
    kept = judged(text_counts(packed), limits).filter("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
