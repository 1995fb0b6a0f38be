"""Fraud, volume and sentiment analytics over transaction-like tables.

Business column names are arguments. Every aggregate combines on the map side before it shuffles, so a key that
holds a large share of the rows reaches the reducers as one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.operators.slices import floor_to, micros
from steward.session import stored

#: Units of :func:`rapid_fire_by_bucket`.
UNITS = ("microsecond", "millisecond", "second", "minute", "hour", "day", "week", "month", "quarter", "year")


def _summable(df: DataFrame, value: str, scale: int | None) -> Column:
    """``value`` as a number whose sum does not depend on the order of the rows, where there is one: decimals and integers as
    they are, others as decimals with ``scale`` digits. Without a scale, others are summed as doubles."""
    column, held = F.col(f"`{value}`"), df.schema[value].dataType
    if isinstance(held, T.DecimalType):
        return column
    if isinstance(held, T.IntegralType):
        return column.cast("decimal(20,0)")
    return column.cast("double") if scale is None else column.cast(f"decimal(28,{scale})")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One ``(label, n)`` row per table."""
    if not tables:
        raise ValueError("row_counts needs at least one table")
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"), "n") for label, df in tables.items()]
    return reduce(DataFrame.unionAll, counted)


def rapid_fire_by_bucket(tx: DataFrame, key: str, ts: str, unit: str = "minute", more_than: int = 3) -> DataFrame:
    """Keys with more than ``more_than`` rows in one calendar ``unit`` (Q2).

    A burst that straddles a boundary is split between two buckets and may be missed; see
    :func:`rapid_fire_in_frame` for the sliding form.
    """
    if unit.lower() not in UNITS:
        raise ValueError(f"unknown unit {unit!r}; use one of {', '.join(UNITS)}")
    bucket = F.date_trunc(unit, F.col(ts)).cast(tx.schema[ts].dataType).alias("bucket")
    return (
        tx.groupBy(F.col(key), bucket)
        .agg(F.count(F.lit(1)).alias("tx_count"))
        .where(F.col("tx_count") > more_than)
    )


def top_groups_by_volume(
    tx: DataFrame,
    accounts: DataFrame,
    owners: DataFrame,
    *,
    tx_account: str,
    account_id: str,
    account_owner: str,
    owner_id: str,
    group: str,
    amount: str,
    scale: int | None = None,
    top: int = 5,
) -> DataFrame:
    """Groups of owners ranked by the outgoing volume of their accounts (Q3).

    The volume is summed before each join: sums distribute over the join, so the fact rows shrink to one row per
    account, then one per owner, and a hot account never meets the join as raw rows. Equal volumes are ordered by
    the group name. Decimal amounts are summed with all their digits, others as :func:`mean_by_group` does.
    """
    summed = _summable(tx, amount, scale)
    per_account = (
        tx.where(F.col(tx_account).isNotNull())
        .groupBy(F.col(tx_account).alias("_account"))
        .agg(F.sum(summed).alias("_vol"))
    )
    per_owner = (
        per_account.join(
            accounts.select(F.col(account_id).alias("_account"), F.col(account_owner).alias("_owner")), "_account"
        )
        .groupBy("_owner")
        .agg(F.sum("_vol").alias("_vol"))
    )
    return (
        per_owner.join(owners.select(F.col(owner_id).alias("_owner"), F.col(group)), "_owner")
        .groupBy(group)
        .agg(F.sum("_vol").alias("total_vol"))
        .orderBy(F.col("total_vol").desc_nulls_last(), F.col(group).asc_nulls_last())
        .limit(top)
    )


def mean_by_group(df: DataFrame, group: str, value: str, scale: int | None = None) -> DataFrame:
    """Mean of ``value`` per ``group`` (Q4).

    Decimals and integers are summed with all their digits, so the mean does not depend on the order of the rows; the sum is
    divided as a double, so the mean is not cut to the scale of the input. Doubles are summed as they are, unless ``scale``
    says how many digits they have: they are then summed as decimals, too. Sort the result for display.
    """
    exact = _summable(df, value, scale)
    return df.groupBy(group).agg((F.sum(exact).cast("double") / F.count(exact)).alias("mean_value"))


def rank_by_mean(df: DataFrame, group: str, value: str, scale: int | None = None) -> DataFrame:
    """Groups ranked by descending mean; equal means share a rank (Q7).

    The means, one row per group, are stored in the shared scratch folder. They are counted per distinct mean, so a mean that
    very many groups share is one row, and the distinct means are ranked in slices between quantiles, whose estimation is an
    action; the groups then look their rank up.
    """
    means = stored(mean_by_group(df, group, value, scale), "means")
    # A mean is finite, so this places groups without any value last.
    sortable = F.coalesce("mean_value", F.lit(float("-inf"))).alias("_mean")
    ranks = stored(_ranks(means.select(sortable)), "ranks")
    return means.select("*", sortable).join(ranks, "_mean").drop("_mean")


def _ranks(means: DataFrame) -> DataFrame:
    """``_mean`` and ``sentiment_rank`` for each distinct value of ``_mean``, without a task that sees them all."""
    slices = 1_000
    finite = means.where(F.col("_mean") > float("-inf"))
    bounds = sorted(set(finite.approxQuantile("_mean", [i / slices for i in range(1, slices)], 1 / slices)))
    # The number of bounds that the mean reaches.
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<double>"), lambda b: b <= F.col("_mean")))
    counted = means.groupBy("_mean").agg(F.count(F.lit(1)).alias("_n")).withColumn("_slice", place)
    above = Window.orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # At most as many rows as there are slices, whatever the data.
    offsets = (
        counted.groupBy("_slice")
        .agg(F.sum("_n").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    )
    inside = Window.partitionBy("_slice").orderBy(F.col("_mean").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(inside), F.lit(0))
    return counted.join(F.broadcast(offsets), "_slice").select(
        "_mean", (before + F.col("_above") + 1).alias("sentiment_rank")
    )


def rapid_fire_in_frame(
    tx: DataFrame,
    key: str | Sequence[str],
    ts: str,
    frame_seconds: float,
    more_than: int = 3,
    slice_seconds: float | None = None,
) -> DataFrame:
    """Rows that end a run of more than ``more_than`` rows of their key within ``frame_seconds`` (Q5).

    ``tx_count`` is the number of rows of the key in ``[ts - frame, ts]``, peers included: the count of
    ``RANGE BETWEEN frame PRECEDING AND CURRENT ROW``. NULL is a key like any other; rows without time are left out.

    A range frame is re-evaluated for each row and would hold all rows of a key in one task. Here the rows of a key and
    instant are counted first, which combines before the shuffle; the count opens at its instant and closes one frame
    later, and what a frame holds is a running sum of openings and closings. The time line of a key is cut into slices, a
    whole number to the frame, and each is a window partition of its own: what is open at its start is what opened in as many
    slices before it as a frame has, so their totals are all that a slice needs to know of the others, and nothing runs along
    a key. Only the instants above the limit meet the rows again. By default a slice is a frame; ``slice_seconds`` cuts keys
    that fire extremely often finer. The result is the same.
    """
    keys = [key] if isinstance(key, str) else list(key)
    frame = round(frame_seconds * 1_000_000)
    width = round(slice_seconds * 1_000_000) if slice_seconds else frame
    if frame <= 0 or width <= 0:
        raise ValueError("frame_seconds and slice_seconds must be positive")
    per_frame = -(-frame // width)

    slots = [f"_k{i}" for i in range(len(keys))]
    at_once = [F.col(f"`{k}`").alias(slot) for k, slot in zip(keys, slots)]
    timed = tx.where(F.col(f"`{ts}`").isNotNull()).select(
        *at_once, micros(F.col(f"`{ts}`")).alias("_opens"), F.struct(*[F.col(f"`{c}`") for c in tx.columns]).alias("_row")
    )
    instants = timed.groupBy(*slots, "_opens").agg(F.count(F.lit(1)).alias("_n"))
    # Slices are numbered: those of a frame share the whole frames before them.
    nth = F.expr(f"(_opens - pmod(_opens, {frame})) div {frame}") * per_frame + F.expr(f"pmod(_opens, {frame}) * {per_frame} div {frame}")
    placed = instants.withColumn("_slice", nth)
    # At one time openings come before closings, since a frame includes both its ends; what is open at the start comes first.
    opening = F.struct(F.col("_slice").alias("_slice"), (F.col("_opens") * 2).alias("_order"), F.col("_n").alias("_step"))
    closing = F.struct(
        (F.col("_slice") + per_frame).alias("_slice"), ((F.col("_opens") + frame) * 2 + 1).alias("_order"), (-F.col("_n")).alias("_step")
    )
    marks = placed.select(*slots, F.inline(F.array(opening, closing)))
    later = F.explode(F.sequence(F.col("_slice") + 1, F.col("_slice") + per_frame)).alias("_slice")
    totals = placed.groupBy(*slots, "_slice").agg(F.sum("_n").alias("_step"))
    at_start = totals.select(*slots, later, F.lit(-(1 << 63)).alias("_order"), "_step")
    running = Window.partitionBy(*slots, "_slice").orderBy("_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = marks.unionByName(at_start).withColumn("_run", F.sum("_step").over(running))
    opens = (F.col("_step") > 0) & (F.col("_order") > -(1 << 63))
    hits = counted.where(opens & (F.col("_run") > more_than)).select(*slots, F.expr("_order div 2").alias("_opens"), "_run")
    hits = hits.alias("h")
    same_instant = [F.col(f"t.{c}").eqNullSafe(F.col(f"h.{c}")) for c in [*slots, "_opens"]]
    return timed.alias("t").join(hits, same_instant).select("_row.*", F.col("_run").alias("tx_count"))


def double_spend(
    tx: DataFrame,
    same: Sequence[str],
    ts: str,
    tx_id: str,
    within_seconds: float = 0.5,
    slice_seconds: float | None = None,
) -> DataFrame:
    """Rows that repeat the preceding row of their group within ``within_seconds`` (Q6).

    Groups are rows equal in all ``same`` columns (source, destination and amount), NULL being equal to NULL; they are
    ordered by time, then id. Adds ``previous_id`` and ``gap_micros``.

    A preceding row that counts lies at most ``within_seconds`` back. The time line is therefore cut into slices of
    ``slice_seconds`` (eight times the limit by default), rows near the end of a slice are also shown to the next one,
    and a group of any size is spread over its slices.
    """
    limit = round(within_seconds * 1_000_000)
    width = round(slice_seconds * 1_000_000) if slice_seconds else 8 * max(limit, 1)
    if limit < 0 or width < limit:
        raise ValueError("the slice must be at least as long as the limit")
    # The row goes along as one value, so no helper column can have the name of one of its columns.
    slots = [f"_k{i}" for i in range(len(same))]
    timed = tx.where(F.col(f"`{ts}`").isNotNull()).select(
        *[F.col(f"`{c}`").alias(slot) for c, slot in zip(same, slots)],
        micros(F.col(f"`{ts}`")).alias("_at"), F.col(f"`{tx_id}`").alias("_id"),
        F.struct(*[F.col(f"`{c}`") for c in tx.columns]).alias("_row"),
    )
    crosses = floor_to(F.col("_at") + F.lit(limit), width) > floor_to(F.col("_at"), width)
    shown = timed.withColumn(
        "_next", F.explode(F.when(crosses, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).withColumn("_slice", floor_to(F.col("_at"), width) + F.col("_next") * F.lit(width))
    order = Window.partitionBy(*slots, "_slice").orderBy("_at", "_id")
    return (
        shown.withColumn("_previous", F.lag("_id").over(order))
        .withColumn("_gap", F.col("_at") - F.lag("_at").over(order))
        .where((F.col("_next") == 0) & (F.col("_gap") <= limit))
        .select("_row.*", F.col("_previous").alias("previous_id"), F.col("_gap").alias("gap_micros"))
    )
