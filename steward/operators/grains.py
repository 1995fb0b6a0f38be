"""Totals at several grains in one pass: rollups, cubes and grouping sets."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steward.operators.analytics import _summable


def rollup(columns: Sequence[str]) -> list[tuple[str, ...]]:
    """The grains of a rollup: all columns, then one less from the right each, down to none."""
    return [tuple(columns[:n]) for n in range(len(columns), -1, -1)]


def cube(columns: Sequence[str]) -> list[tuple[str, ...]]:
    """All subsets of the columns."""
    return [chosen for n in range(len(columns), -1, -1) for chosen in combinations(columns, n)]


def totals_by_grains(
    df: DataFrame, grains: Sequence[Sequence[str]], value: str, scale: int | None = None, weight: str | None = None
) -> DataFrame:
    """Count, sum and mean of ``value`` for each group of each of the ``grains``.

    The result has the columns of all grains, NULL where a grain lacks them, and ``grain``, which has a bit for each column, the first
    being the highest, that is 1 where the grain lacks it: so a NULL of the data can be told from a column that is summed over.
    Then ``n``, the rows; ``total``; and ``mean_value``, over the values that are not NULL. Values are summed as
    :func:`~steward.operators.analytics.mean_by_group` does. ``weight`` names a column that says for how many rows a row stands, where
    rows were summed before, ``value`` being the sum; a mean is then one over those. A grain named twice is given once.

    Rows are summed per group of all columns first, in each task and after one shuffle, and only these groups are multiplied by the
    grains: with the usual few columns they are much fewer than rows.
    """
    sets = list(dict.fromkeys(tuple(g) for g in grains))
    columns = list(dict.fromkeys(c for g in sets for c in g))
    if not sets:
        raise ValueError("at least one grain")
    taken = {c.lower() for c in columns} & {"grain", "n", "total", "mean_value"}
    if taken:
        raise ValueError(f"columns of the result: {sorted(taken)}")
    keys = [F.col(f"`{c}`") for c in columns]
    exact = _summable(df, value, scale)
    rows = F.sum(F.col(f"`{weight}`").cast("long")) if weight else F.count(F.lit(1))
    valued = F.sum(F.when(exact.isNotNull(), F.col(f"`{weight}`").cast("long"))) if weight else F.count(exact)
    finest = df.groupBy(*keys).agg(rows.alias("_n"), valued.alias("_valued"), F.sum(exact).alias("_total"))
    by_grain = finest.groupingSets([[F.col(f"`{c}`") for c in g] for g in sets], *keys)
    summed = by_grain.agg(
        F.grouping_id().cast("long").alias("grain"), F.sum("_n").alias("n"), F.sum("_total").alias("total"), F.sum("_valued").alias("_valued")
    )
    mean = F.when(F.col("_valued") > 0, F.col("total").cast("double") / F.col("_valued"))
    # An empty table has no groups but one at the grain without columns.
    return summed.select(*keys, "grain", F.coalesce("n", F.lit(0)).alias("n"), "total", mean.alias("mean_value"))
