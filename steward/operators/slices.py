"""Time lines cut into slices, so that a key with very many rows is spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices in a block: what is carried goes from slice to slice within a block, and from block to block.
BLOCK_SLICES = 4096


def micros(ts: Column) -> Column:
    """A time as microseconds since 1970, whatever its type."""
    return F.unix_micros(ts.cast("timestamp"))


def floor_to(at: Column, width: int) -> Column:
    """The start of the slice of ``width`` that ``at`` lies in."""
    return at - F.pmod(at, F.lit(width))


def last_before(slices: DataFrame, keys: Sequence[str], at: str, value: str, width: int) -> DataFrame:
    """For each row of ``slices``, which has one per key and slice that starts at ``at``, the last ``value`` that is not NULL of the
    key's earlier slices, in its place.

    A window holds the slices of one block, or the blocks of one key; never rows.
    """
    in_block = Window.partitionBy(*keys, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    of_key = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocked = slices.withColumn("_block", floor_to(F.col(at), width * BLOCK_SLICES))
    filled = F.when(F.col(value).isNotNull(), F.col(at))
    totals = blocked.groupBy(*keys, "_block").agg(F.max_by(value, filled).alias("_last"))
    carried = totals.select(*keys, "_block", F.last("_last", ignorenulls=True).over(of_key).alias("_carried"))
    inside = blocked.withColumn("_inside", F.last(value, ignorenulls=True).over(in_block))
    return inside.join(carried, [*keys, "_block"]).select(*keys, at, F.coalesce("_inside", "_carried").alias(value))
