"""Column profiles, candidate keys, field discovery and nesting depth."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.functions.nested import data_depth, json_depth
from steward.functions.normalize import comparable_text

#: Bookkeeping columns that are never part of a key.
NOT_PROFILED = ("created_at", "updated_at")
#: Texts longer than this are compared by their SHA-256 digest, so documents are not shuffled to be counted.
LONG_TEXT = 64
#: Spark's largest distinct-count sketch has two to this power registers.
MOST_REGISTERS = 21


def _comparable(field: T.StructField) -> Column:
    """The value as a text that is equal exactly for equal values; NULL when empty."""
    text = comparable_text(F.col(f"`{field.name}`"), field.dataType)
    # A digest has 64 characters and is only used for longer texts, so it cannot equal a short text.
    short = F.when(F.length(text) < LONG_TEXT, text).otherwise(F.sha2(text.cast("binary"), 256))
    return F.nullif(short, F.lit(""))


def _profiled(df: DataFrame, columns: Sequence[str] | None, skip: Iterable[str]) -> list[T.StructField]:
    names = list(columns) if columns is not None else [c for c in df.columns if c not in set(skip)]
    if not names:
        raise ValueError("no column to profile")
    return [df.schema[name] for name in names]


def _hundredths(part: Column, whole: Column) -> Column:
    """``part / whole`` in hundredths, rounded as the language's ``round(x, 2)`` does.

    Off the ties this is integer arithmetic. On a tie, ``round`` follows the binary value of the ratio, so the odd
    half-hundredths that it rounds up are worked out here and looked up.
    """
    rounds_up = [t for t in range(1, 200, 2) if round(t / 200, 2) > t / 200]
    halves = F.expr("_part * 200 div _whole")
    on_tie = ((F.col("_part") * 200) % F.col("_whole") == 0) & (halves % 2 == 1)
    tie = F.expr("(_part * 200 div _whole) div 2") + F.when(halves.isin(rounds_up), 1).otherwise(0)
    return F.when(on_tie, tie).otherwise(F.expr("(_part * 200 + _whole) div (2 * _whole)"))


def _ratio(df: DataFrame, name: str, part: str, whole: str) -> DataFrame:
    """Add ``name`` = part / whole with two digits."""
    marked = df.withColumn("_part", F.col(part)).withColumn("_whole", F.col(whole))
    return marked.withColumn(name, _hundredths(F.col("_part"), F.col("_whole")) / F.lit(100.0)).drop("_part", "_whole")


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, skip: Iterable[str] = NOT_PROFILED
) -> DataFrame:
    """Uniqueness and completeness of each column (D1, D2): ``column_name, total, filled, distinct_values,
    uniqueness, completeness``.

    Empty and absent values do not count as filled. A column without any filled value has no row. The ratios have
    two digits; the counts next to them give the exact ones.

    One pass: the columns are unpivoted to (column, value) pairs, which are counted twice, first per pair and then
    per column. Both counts combine before they shuffle.
    """
    fields = _profiled(df, columns, skip)
    names = [f.name for f in fields]
    counted = (
        df.select(*[_comparable(f).alias(f.name) for f in fields])
        .unpivot([], [F.col(f"`{name}`") for name in names], "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .groupBy("column_name")
        .agg(
            F.sum("_copies").alias("total"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("_copies"))), F.lit(0)).alias("filled"),
            F.count("value").alias("distinct_values"),
        )
        .where(F.col("filled") > 0)
    )
    return _ratio(_ratio(counted, "uniqueness", "distinct_values", "filled"), "completeness", "filled", "total")


def _contenders(df: DataFrame, fields: list[T.StructField], levels: int, error: float) -> list[str]:
    """Columns whose uniqueness, known to ``error``, can still be among the top ``levels``. Reads the data once."""
    # A sketch of 2^k registers has a standard error of about 1.04 / 2^(k/2).
    registers = max(ceil(2 * log2(1.04 * 6 / error)), 4)
    if registers > MOST_REGISTERS:
        raise ValueError(f"an error of {error} needs larger sketches than there are; use one of 0.0044 or more, or none")
    aggs = []
    for i, f in enumerate(fields):
        value = _comparable(f)
        estimate = F.hll_sketch_estimate(F.hll_sketch_agg(value, registers))
        aggs += [estimate.alias(f"d{i}"), F.count(value).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    bounds = {}
    for i, f in enumerate(fields):
        if row[f"n{i}"]:
            score = min(row[f"d{i}"] / row[f"n{i}"], 1.0)
            bounds[f.name] = (score * (1 - error) - 0.01, score * (1 + error) + 0.01)
    floor, found, ceiling = 0.0, 0, float("inf")
    for low, high in sorted(bounds.values(), key=lambda b: b[0], reverse=True):
        if high < ceiling:  # apart from the level before, so a level of its own
            found, ceiling = found + 1, low
        if found == levels:
            floor = low
            break
    return [name for name, (_, high) in bounds.items() if high >= floor]


def candidate_keys(
    df: DataFrame,
    levels: int = 1,
    exact: bool = False,
    columns: Sequence[str] | None = None,
    skip: Iterable[str] = NOT_PROFILED,
    prefilter_error: float | None = None,
) -> DataFrame:
    """Columns in the top ``levels`` distinct levels of uniqueness (D3): ``column_name, uniqueness, level``.

    Ties share a level and are all kept. Completeness plays no part. Levels are taken after rounding to two digits
    unless ``exact``. Fewer levels than asked for give all columns.

    With ``prefilter_error`` (e.g. 0.03) one pass of distinct-count sketches, an action that brings a single row to the
    driver, first rules out columns that cannot be among the top; the exact count then reads the others only. The
    sketches are sized for a standard error of a sixth of it.
    """
    if not isinstance(levels, int) or levels < 1:
        raise ValueError("levels must be a positive integer")
    fields = _profiled(df, columns, skip)
    if prefilter_error is not None:
        names = _contenders(df, fields, levels, prefilter_error)
        columns = names or [f.name for f in fields]
    profile = column_profile(df, columns, skip)
    score = F.col("distinct_values") / F.col("filled") if exact else F.col("uniqueness")
    # One row per column of the table, so the ranking is small whatever the data.
    return (
        profile.select("column_name", score.alias("uniqueness"))
        .withColumn("level", F.dense_rank().over(Window.orderBy(F.col("uniqueness").desc())))
        .where(F.col("level") <= levels)
    )


def json_fields(df: DataFrame, column: str) -> DataFrame:
    """Names of all top-level keys in a column of JSON objects (D4), one row per name."""
    return df.select(F.explode(F.json_object_keys(F.col(column))).alias("field")).distinct()


def map_fields(df: DataFrame, column: str) -> DataFrame:
    """Names of all keys in a map column (D4), one row per name."""
    return df.select(F.explode(F.map_keys(column)).alias("field")).distinct()


def align(frames: Sequence[DataFrame]) -> DataFrame:
    """Ragged record sets as one, with the union of their columns in name order; what a set lacks is NULL."""
    if not frames:
        raise ValueError("align needs at least one frame")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.select(*[F.col(f"`{c}`") for c in sorted(union.columns)])


def max_depth(df: DataFrame, column: str | None = None) -> DataFrame:
    """Greatest nesting depth in the data (D5), as one row: of a column of JSON text, maps or structs, or of the records
    themselves. Without rows it is 0."""
    if column is None:
        fields = [data_depth(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
        depth = F.greatest(F.lit(0), *fields) + 1
    elif isinstance(df.schema[column].dataType, T.StringType):
        depth = json_depth(F.col(f"`{column}`"))
    else:
        depth = data_depth(F.col(f"`{column}`"), df.schema[column].dataType)
    return df.agg(F.coalesce(F.max(depth), F.lit(0)).alias("depth"))
