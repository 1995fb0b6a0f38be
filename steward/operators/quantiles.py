"""Exact quantiles of large columns, without a group or a task that holds all values of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steward.session import stored

#: Coarse ranges of values a power of two, and fine ones, of equal width, in a coarse range that holds a quantile.
COARSE, FINE = 32, 4096


def _coarse(value: Column) -> Column:
    """A whole number that never falls as the value rises; NaN is the highest. Every logarithm of a double exceeds -1,100."""
    return F.coalesce(F.rint(F.signum(value) * (F.log2(F.abs(value)) + 1100) * COARSE), F.lit(0.0))


def _reached(counts: DataFrame, at: str, *kept: str) -> DataFrame:
    """For each ``(column, share)`` the first ``at`` by which ``rank`` values are counted, and how many lie ``below`` it."""
    upto = F.col("below") + F.sum("n").over(Window.partitionBy("column", "share").orderBy(at))
    enough = counts.withColumn("_upto", upto).where(F.col("_upto") >= F.col("rank"))
    first = F.struct(at, (F.col("_upto") - F.col("n")).alias("below"), "rank", *kept)
    return stored(enough.groupBy("column", "share").agg(F.min_by(first, at).alias("_first")).select("column", "share", "_first.*"), "quantile")


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``(column, share, value)``: the least value of each numeric column that the share of its values does not exceed, as
    ``percentile_disc`` gives it, as a double. NULL is no value; columns without values have no row.

    The first pass over ``df`` counts coarse ranges of values, some thousand a column, and finds those that hold the ranks asked
    for; the second counts the values of these alone, one by one. In them fine ranges and then single values are counted up.
    What a window holds are ranges, or the different values of one fine range. The counts are stored in the shared scratch folder.
    """
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])))
    cells = cells.where(F.col("value").isNotNull()).withColumn("coarse", _coarse(F.col("value")))
    ranges = cells.groupBy("column", "coarse").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    ranked = ranges.withColumn("_all", F.sum("n").over(Window.partitionBy("column")))
    ranked = ranked.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    ranked = ranked.select("*", F.lit(0).cast("long").alias("below"), (F.col("share") * F.col("_all")).alias("rank"))
    target = _reached(ranked, "coarse", "low", "high")

    span = F.col("high") - F.col("low")
    fine = F.when(F.col("high") > F.col("low"), F.floor((F.col("value") - F.col("low")) / span * (FINE - 1))).otherwise(F.lit(0))
    within = target.select("column", "coarse", "low", "high").distinct()
    near = cells.join(F.broadcast(within), ["column", "coarse"]).withColumn("fine", fine.cast("long"))
    counts = stored(near.groupBy("column", "coarse", "fine", "value").agg(F.count(F.lit(1)).alias("n")), "quantile-counts")
    sums = counts.groupBy("column", "coarse", "fine").agg(F.sum("n").alias("n"))
    target = _reached(sums.join(F.broadcast(target), ["column", "coarse"]), "fine", "coarse")
    return _reached(counts.join(F.broadcast(target), ["column", "coarse", "fine"]), "value").select("column", "share", "value")
