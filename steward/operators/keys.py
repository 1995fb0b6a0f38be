"""Primary-key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steward.operators.names import unused
from steward.session import stored as stored_once

def _cols(key: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in key]


def _has_null(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in _cols(key)])


def key_violations(df: DataFrame, key: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """Keys that may not be loaded: NULL in a key column, repeated in ``df``, or already in ``stored``.

    Gives the key columns and ``n``, the number of rows of ``df`` that carry the key (``n_`` where a key column has that name).
    The counts combine before they shuffle, so a key with very many rows costs no more than one with two. The stored table is
    reduced to the keys of ``df`` by a semi join, which Spark turns into a broadcast when those are few, so a small batch does
    not shuffle a large table.
    """
    names, cols = list(key), _cols(key)
    n, present = unused(key, "n", "_taken")
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n))
    bad = (F.col(n) > 1) | _has_null(key)
    if stored is not None:
        taken = stored.select(*cols).join(counted.select(*cols), names, "left_semi").distinct()
        counted = counted.join(taken.withColumn(present, F.lit(True)), names, "left")
        bad = bad | F.col(present).isNotNull()
    return counted.where(bad).select(*cols, n)


def split_violations(df: DataFrame, violations: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` as (good rows, bad rows), bad being NULL in the key or having a key in ``violations``.

    One join flags the rows, which are stored once in the shared scratch folder, and both results read that. A key of
    ``violations`` is one row there, so where a key holds a large share of ``df``, adaptive execution splits its rows over
    tasks; rows with a NULL in the key are told by expression and dealt out evenly.
    """
    marked, *slots = unused([*df.columns, *violations.columns], "_bad", *[f"_key{i}" for i in range(len(key))])
    listed = violations.where(~_has_null(key)).select(
        *[c.alias(slot) for c, slot in zip(_cols(key), slots)], F.lit(True).alias(marked)
    )
    keyed = df.where(~_has_null(key))
    same = [keyed[f"`{k}`"] == listed[slot] for k, slot in zip(key, slots)]
    order = [F.col(f"`{c}`") for c in df.columns]
    flagged = keyed.join(listed, same, "left").select(*order, F.coalesce(marked, F.lit(False)).alias(marked))
    nulls = df.where(_has_null(key)).select(*order, F.lit(True).alias(marked))
    flagged = stored_once(flagged.unionAll(nulls), "flagged-rows")
    return flagged.where(~F.col(marked)).select(*order), flagged.where(F.col(marked)).select(*order)
