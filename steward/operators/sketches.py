"""Profiles from stored sketches: distinct counts, quantiles and frequent values of batches, merged without their rows.

The sketch of a batch is a small table of whole numbers, ``(column, kind, at, value, n)``, whatever the batch's size. Merging is a
maximum or a sum per key, so it does not matter in which order, or in how many steps, batches are merged, nor how their rows lay.

========  ===============================================  ==========  ==================
kind      at, value, n                                     merged by   rows a column
========  ===============================================  ==========  ==================
rows      n: rows                                          sum         1
filled    n: values that are neither NULL nor empty        sum         1
distinct  at: register, n: highest rank of a hash in it    maximum     2 ** REGISTER_BITS
quantile  at: bucket of the value's size, n: values        sum         buckets in use
frequent  value, n: how often, where often enough          sum         1 / SUPPORT a batch
========  ===============================================  ==========  ==================
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.session import stored

#: 16,384 registers: a standard error of 0.8 % of the distinct count.
REGISTER_BITS = 14
#: Relative error of quantiles.
ACCURACY = 0.01
#: Share of a batch's filled values from which a value is kept. What is reported may be short of the truth by that share of the
#: filled values of the batches that did not keep it.
SUPPORT = 0.001
#: Hash cells that pick the values worth counting one by one. A cell is the first bits of the hash, so it lies in one register.
CELL_BITS = 16
CELLS = 1 << CELL_BITS

SKETCH = T.StructType(
    [
        T.StructField("column", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("at", T.LongType()),
        T.StructField("value", T.StringType()), T.StructField("n", T.LongType()),
    ]
)

_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: Buckets of positive numbers are numbered from here up, of negative ones from its negative down; 0 is the number 0.
_MIDDLE = 1 << 20

# A slot is one number for a column, one of its two kinds of counters (cells, buckets) and the counter; a code adds a rank.
_AT_BITS, _RANK_BITS = 30, 6
_RANKS = 1 << _RANK_BITS


def _slot(column: int, kind: int, at: Column) -> Column:
    return F.lit((2 * column + kind) << _AT_BITS).cast("long") + at


def _cell(digest: Column) -> Column:
    return F.shiftrightunsigned(digest, 64 - CELL_BITS)


def _bucket(number: Column) -> Column:
    """The bucket of a number; numbers in one differ by twice ``ACCURACY`` at most. NaN is the highest, infinities come next to it."""
    size = F.ceil(F.log(F.abs(number)) / math.log(_GAMMA)).try_cast("long") + _MIDDLE
    finite = F.when(number > 0, size).when(number < 0, -size).otherwise(0)
    ends = F.when(F.isnan(number), 3 * _MIDDLE).when(number == float("inf"), 2 * _MIDDLE).when(number == float("-inf"), -2 * _MIDDLE)
    return F.coalesce(ends, finite)


def _number(bucket: Column) -> Column:
    """A number that differs from all of its bucket by ``ACCURACY`` at most."""
    middle = F.pow(F.lit(_GAMMA), F.abs(bucket) - _MIDDLE) * (2 / (1 + _GAMMA))
    return (
        F.when(bucket == 0, 0.0).when(bucket == 3 * _MIDDLE, float("nan")).when(bucket == 2 * _MIDDLE, float("inf"))
        .when(bucket == -2 * _MIDDLE, float("-inf")).otherwise(F.signum(bucket.cast("double")) * middle)
    )


def sketch_batch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The sketch of the rows of ``df``: ``(column, kind, at, value, n)``.

    Values are compared as texts; empty ones count as absent, as in the profiles of ``operators.profile``. Quantiles are kept of
    numeric columns. Two passes: the first counts hash cells, with the highest rank in each, and buckets, of which each task has a
    bounded number before anything is shuffled; rows, filled values and registers are sums and maxima of cells. The second counts,
    one by one, the values of the cells that hold enough to matter, and reads only the columns that have such cells.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    if not fields or (columns is not None and len(fields) != len(set(columns))):
        raise ValueError("unknown columns or none")
    simple = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    refused = [f.name for f in fields if isinstance(f.dataType, simple)]
    if refused:
        raise ValueError(f"columns without a text: {refused}")

    texts, numbers = [f"_t{i}" for i in range(len(fields))], [f"_x{i}" for i in range(len(fields))]
    held = [F.col(f"`{f.name}`") for f in fields]
    # What is used several times is a column of a projection before, so that it is worked out once.
    read = df.select(
        *[F.nullif(c.cast("string"), F.lit("")).alias(t) for c, t in zip(held, texts)],
        *[c.cast("double").alias(x) for f, c, x in zip(fields, held, numbers) if isinstance(f.dataType, T.NumericType)],
    )
    digests = [F.when(F.col(t).isNotNull(), F.xxhash64(t)).alias(f"_d{i}") for i, t in enumerate(texts)]

    def cell_code(i: int) -> Column:
        digest = F.col(f"_d{i}")
        # The rank is the place of the first 1 in the bits that are not the register's.
        left = digest.bitwiseAND(F.lit((1 << (64 - REGISTER_BITS)) - 1))
        rank = F.when(left == 0, 64 - REGISTER_BITS + 1).otherwise(64 - REGISTER_BITS + 1 - F.octet_length(F.bin(left)))
        return F.when(digest.isNull(), _slot(i, 0, F.lit(CELLS)) * _RANKS).otherwise(_slot(i, 0, _cell(digest)) * _RANKS + rank)

    def size_code(i: int) -> Column:
        number = F.col(f"_x{i}")
        return F.when(number.isNull(), F.lit(-1).cast("long")).otherwise(_slot(i, 1, _bucket(number) + 4 * _MIDDLE) * _RANKS)

    codes = [cell_code(i) for i in range(len(fields))]
    codes += [size_code(i) for i, f in enumerate(fields) if isinstance(f.dataType, T.NumericType)]
    coded = read.select("*", *digests).select(F.explode(F.array(*codes)).alias("_code")).where("_code >= 0")
    slots = coded.groupBy(F.shiftright("_code", _RANK_BITS).alias("_slot")).agg(
        F.max(F.col("_code").bitwiseAND(F.lit(_RANKS - 1))).alias("_rank"), F.count(F.lit(1)).alias("_count")
    )
    kept = stored(slots, "sketch")

    which, at = F.shiftright("_slot", _AT_BITS), F.col("_slot").bitwiseAND(F.lit((1 << _AT_BITS) - 1))
    column = F.get(F.array(*[F.lit(f.name) for f in fields]), F.shiftright(which, 1).cast("int"))
    named = kept.select(column.alias("column"), "_slot", (which.bitwiseAND(F.lit(1)) == 0).alias("_is_cell"), at.alias("_at"), "_rank", "_count")

    def row(kind: str, at: Column, n: Column, given: Column) -> Column:
        full = F.struct(F.lit(kind).alias("kind"), at.cast("long").alias("at"), n.cast("long").alias("n"))
        return F.when(given, full)

    is_cell, nothing, count = F.col("_is_cell"), F.lit(0), F.col("_count")
    there = is_cell & (F.col("_at") < CELLS)
    parts = F.array_compact(
        F.array(
            row("rows", nothing, count, is_cell),
            row("filled", nothing, count, there),
            row("distinct", F.shiftright("_at", CELL_BITS - REGISTER_BITS), F.col("_rank"), there),
            row("quantile", F.col("_at") - 4 * _MIDDLE, count, ~is_cell),
        )
    )
    grouped = named.select("column", F.inline(parts)).groupBy("column", "kind", "at")
    counted = _merged(grouped.agg(F.max("n").alias("_most"), F.sum("n").alias("_sum")))
    filled = named.where(there).groupBy("column").agg(F.sum("_count").alias("_filled"))
    # At most 1 / SUPPORT cells a column, and most columns have none.
    heavy = named.where(there).join(F.broadcast(filled), "column").where(F.col("_count") >= F.col("_filled") * SUPPORT)
    heavy = heavy.select("column", "_slot", "_filled")
    found = {r[0] for r in heavy.select("column").distinct().collect()}
    values = [
        F.struct(_slot(i, 0, _cell(F.xxhash64(t))).alias("_slot"), F.col(t).alias("value"))
        for i, (f, t) in enumerate(zip(fields, texts)) if f.name in found
    ]
    names = SKETCH.names
    small = counted.withColumn("value", F.lit(None).cast("string")).select(*names)
    if not values:
        return small
    placed = read.select(F.inline(F.array(*values))).where(F.col("value").isNotNull())
    frequent = (
        placed.join(F.broadcast(heavy), "_slot").groupBy("column", "value", "_filled").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= F.col("_filled") * SUPPORT)
    )
    return small.unionByName(frequent.withColumns({"kind": F.lit("frequent"), "at": F.lit(0).cast("long")}).select(*names))


def _merged(grouped: DataFrame) -> DataFrame:
    return grouped.withColumn("n", F.when(F.col("kind") == "distinct", F.col("_most")).otherwise(F.col("_sum"))).drop("_most", "_sum")


def merged_sketch(sketches: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """Sketches together, those of one table or several: again a sketch. A table of sketches, one after the other, is merged as well
    as two of them, so sketches may simply be appended to one."""
    tables = [sketches] if isinstance(sketches, DataFrame) else list(sketches)
    together = reduce(DataFrame.unionByName, [t.select(*SKETCH.names) for t in tables])
    grouped = together.groupBy("column", "kind", "at", "value").agg(F.max("n").alias("_most"), F.sum("n").alias("_sum"))
    return _merged(grouped).select(*SKETCH.names)


def distinct_counts(sketch: DataFrame) -> DataFrame:
    """``(column, n, filled, distinct)``: rows, filled values and the estimated number of different ones, for each column."""
    m = 1 << REGISTER_BITS
    merged = merged_sketch(sketch)
    sums = merged.groupBy("column").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(a) for k, a in (("rows", "n"), ("filled", "filled"))],
        F.count(F.when(F.col("kind") == "distinct", 1)).alias("_set"),
        F.sum(F.when(F.col("kind") == "distinct", F.pow(F.lit(2.0), -F.col("n"))).otherwise(0.0)).alias("_power"),
    )
    empty = m - F.col("_set")
    raw = 0.7213 / (1 + 1.079 / m) * m * m / (F.col("_power") + empty)
    # Few values leave registers empty, whose number tells more than the others' ranks.
    few = m * F.log(m / F.greatest(empty, F.lit(1)).cast("double"))
    estimate = F.when((raw <= 2.5 * m) & (empty > 0), few).otherwise(raw)
    return sums.select("column", "n", "filled", F.round(estimate).cast("long").alias("distinct"))


def quantiles(sketch: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``(column, share, value)``: for each numeric column, the value that the share of its values does not exceed, within
    ``ACCURACY`` of that value."""
    counts = merged_sketch(sketch).where("kind = 'quantile'")
    order = Window.partitionBy("column").orderBy("at")  # some thousand buckets a column
    running = counts.select(
        "column", "at", F.sum("n").over(order).alias("_upto"), F.sum("n").over(Window.partitionBy("column")).alias("_all")
    )
    wanted = running.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    reached = wanted.where(F.col("_upto") >= F.greatest(F.ceil(F.col("share") * F.col("_all")), F.lit(1)))
    found = reached.groupBy("column", "share").agg(F.min("at").alias("at"))
    return found.select("column", "share", _number(F.col("at")).alias("value"))


def frequent_values(sketch: DataFrame, share: float) -> DataFrame:
    """``(column, value, n)`` of all values that make up ``share`` of the filled values or more. ``n`` may be short by ``SUPPORT`` of
    the filled values, and so a value that just misses the share may be listed; ``share`` must exceed ``SUPPORT``."""
    if share <= SUPPORT:
        raise ValueError(f"the share must exceed {SUPPORT}")
    merged = merged_sketch(sketch)
    filled = merged.where("kind = 'filled'").select("column", F.col("n").alias("_filled"))
    kept = merged.where("kind = 'frequent'").join(filled, "column")
    return kept.where(F.col("n") + F.col("_filled") * SUPPORT >= F.col("_filled") * share).select("column", "value", "n")
