"""Joins on time: the latest earlier row of a key, and overlapping intervals.

Both are equality joins and windows on (key, slice of time), so that no key is gathered in one task and no pair is tried that
does not share a slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.operators.slices import floor_to, last_before, micros
from steward.session import stored


def _named(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _all_given(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns], F.lit(True))


def _disjoint(left: DataFrame, added: Sequence[str]) -> None:
    clash = {c.lower() for c in left.columns} & {c.lower() for c in added}
    if clash or len({c.lower() for c in added}) != len(added):
        raise ValueError(f"columns of both sides have the same name: {', '.join(sorted(clash)) or 'twice on the right'}")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str | tuple[str, str]],
    left_ts: str,
    right_ts: str,
    tie: Sequence[str] = (),
    strict: bool = False,
    max_age_seconds: float | None = None,
    how: str = "left",
    slice_seconds: float = 3600,
) -> DataFrame:
    """Each row of ``left`` with the latest row of ``right`` that has its key and is not later.

    ``on`` names the key columns, pairs where the sides call them differently. With ``strict`` the right row must be earlier;
    ``max_age_seconds`` leaves out matches that are older than that. Of right rows of one key and time the greatest by ``tie``
    counts, by default the greatest by all columns that have an order. The result has all columns of ``left`` and those of
    ``right`` but its keys of the same name. NULL keys and times match nothing; ``how="left"`` keeps such rows, and others
    without a match, with NULLs, ``how="inner"`` drops them.

    Both sides are first reduced to one row per key and instant, which combines before the shuffle, so repeated instants of a hot
    key are one row. Windows then hold the instants of one key and slice of ``slice_seconds``; what is current at the start of
    a slice is carried along a table of slices. The left rows meet their match last, in an equality join on key and instant. The
    instants with what is current are stored in the shared scratch folder, which is an action, since both read them.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    left_keys, right_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    given = [c for c in right.columns if not (c in right_keys and c in left_keys)]
    _disjoint(left, given)
    width = round(slice_seconds * 1_000_000)
    if width <= 0:
        raise ValueError("slice_seconds must be positive")
    slots = [f"_k{i}" for i in range(len(pairs))]
    rows = left.select(
        *[c.alias(s) for c, s in zip(_named(left_keys), slots)], micros(F.col(f"`{left_ts}`")).alias("_at"),
        F.struct(*_named(left.columns)).alias("_left"),
    )
    no_order = (T.MapType, T.VariantType)
    order = list(tie) or [f.name for f in right.schema.fields if not isinstance(f.dataType, no_order)]
    offered = right.select(
        *[c.alias(s) for c, s in zip(_named(right_keys), slots)], micros(F.col(f"`{right_ts}`")).alias("_at"),
        F.struct(*_named(given)).alias("_right"), F.struct(*_named(order)).alias("_order"),
    ).where(_all_given(_named([*slots, "_at"])))
    timed = _all_given(_named([*slots, "_at"]))
    keyed = rows.where(timed)

    instants = keyed.select(*slots, "_at").distinct()
    latest = offered.groupBy(*slots, "_at").agg(F.max_by("_right", "_order").alias("_right"))
    found = F.struct(F.col("_at").alias("at"), F.col("_right").alias("row"))
    offers = latest.select(*slots, "_at", F.lit(1 if strict else 0).alias("_kind"), found.alias("_found"))
    asked = instants.select(*slots, "_at", F.lit(0 if strict else 1).alias("_kind"))
    line = offers.unionByName(asked, allowMissingColumns=True).withColumn("_slice", floor_to(F.col("_at"), width))

    until = Window.partitionBy(*slots, "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    current = stored(line.withColumn("_inside", F.last("_found", ignorenulls=True).over(until)).drop("_found"), "asof")
    inside = current.where(F.col("_kind") == (0 if strict else 1))
    ends = current.groupBy(*slots, "_slice").agg(F.max_by("_inside", F.struct("_at", "_kind")).alias("_found"))
    carried = last_before(ends, slots, "_slice", "_found", width).withColumnRenamed("_found", "_carried")
    matched = inside.join(carried, [*slots, "_slice"]).select(*slots, "_at", F.coalesce("_inside", "_carried").alias("_found"))
    fits = F.col("_found").isNotNull()
    if max_age_seconds is not None:
        fits = fits & (F.col("_at") - F.col("_found.at") <= round(max_age_seconds * 1_000_000))
    matched = matched.where(fits)

    joined = keyed.join(matched, [*slots, "_at"], how).select("_left.*", "_found.row.*")
    if how == "inner":
        return joined
    # Rows that can match nothing take no part in the join, where all of them would be one key.
    absent = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in given]
    return joined.unionByName(rows.where(~timed).select("_left.*", *absent))


#: Rows of one side in a (key, bin) cell from which the cell is dealt into parts.
CELL_ROWS = 20_000


def _level(length: Column) -> Column:
    """The least ``l`` with ``length <= 2 ** l``: bins of that size hold the interval in two at most."""
    return F.when(length <= 1, F.lit(0)).otherwise(F.length(F.conv((length - 1).cast("string"), 10, 2)))


def _binned(rows: DataFrame, levels: Column) -> DataFrame:
    """A row per level of ``levels`` and bin of that size that the interval touches."""
    at_level = rows.withColumn("_bin_level", F.explode(levels))
    first, last = F.expr("shiftright(_from, _bin_level)"), F.expr("shiftright(_to - 1, _bin_level)")
    return at_level.withColumn("_bin", F.explode(F.sequence(first, last)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    on: Sequence[str | tuple[str, str]] = (),
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Pairs of rows, equal in the key columns ``on``, whose half-open intervals ``[start, end)`` have an instant in common.

    Bounds are times or whole numbers, of one kind on both sides. Rows with a NULL key or bound, and intervals without length,
    overlap nothing. The result has the columns of both sides, without the right keys of the same name.

    The interval's length sets the size of its bins, a power of two, so that it lies in one or two, however long. A pair meets at
    the level of its longer interval, in the first bin that both touch there and in no other: once among the bins of the left
    rows' own levels, and, where the right interval is the longer one, once among those of the right rows'. Shorter
    intervals are therefore shown at each longer level that the other side has, of which there are 63 at most. Cells with more than
    ``cell_rows`` rows of a side are dealt into parts by hash, and the other side is shown to each of the parts.

    Rows whose key the other side lacks are left out first; the keys of both sides are stored in the shared scratch folder, which is
    an action. The cells dealt into parts are broadcast, so a row is shuffled once for each of its bins.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    left_keys, right_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    given = [c for c in right.columns if not (c in right_keys and c in left_keys)]
    _disjoint(left, given)
    slots = [f"_k{i}" for i in range(len(pairs))]

    def bound(df: DataFrame, name: str) -> Column:
        whole = isinstance(df.schema[name].dataType, T.IntegralType)
        return F.col(f"`{name}`").cast("long") if whole else micros(F.col(f"`{name}`"))

    def prepared(df: DataFrame, keys: Sequence[str], interval: tuple[str, str], columns: Sequence[str], side: str) -> DataFrame:
        out = df.select(
            *[c.alias(s) for c, s in zip(_named(keys), slots)], bound(df, interval[0]).alias("_from"),
            bound(df, interval[1]).alias("_to"), *[c.alias(f"_{side}{i}") for i, c in enumerate(_named(columns))],
        )
        own = _level(F.col("_to") - F.col("_from"))
        # Equal rows of different input partitions are dealt apart.
        spread = F.xxhash64(*[f"_{side}{i}" for i in range(len(columns))], F.spark_partition_id())
        return out.where(_all_given(_named(slots)) & (F.col("_from") < F.col("_to"))).withColumns({"_level": own, "_spread": spread})

    a = prepared(left, left_keys, left_interval, left.columns, "a")
    b = prepared(right, right_keys, right_interval, given, "b")
    if slots:
        # Stored, so that their size is known and few keys are sent to the rows and not the rows to the keys.
        shared = stored(a.select(*slots).distinct().join(b.select(*slots).distinct(), slots), "overlap-keys")
        a, b = (rows.join(shared, slots, "left_semi") for rows in (a, b))
    levels_of = {}
    for side, rows in (("a", a), ("b", b)):
        levels_of[side] = sorted(r[0] for r in rows.select("_level").distinct().collect())  # 64 numbers at most

    def met(native: DataFrame, shown: DataFrame, native_levels: list[int], equal: bool) -> DataFrame:
        """Pairs at the level of ``native``'s rows; those of equal level if ``equal``."""
        own = _binned(native, F.array("_level"))
        least = F.col("_level") if equal else F.col("_level") + 1
        wanted = F.filter(F.array(*[F.lit(v) for v in native_levels]).cast("array<int>"), lambda v: v >= least)
        other = _binned(shown, wanted)
        cell = [*slots, "_bin_level", "_bin"]
        counts = own.select(*cell, F.lit(1).alias("n"), F.lit(0).alias("m")).unionAll(
            other.select(*cell, F.lit(0).alias("n"), F.lit(1).alias("m"))
        )
        parts = [F.ceil(F.sum(c) / cell_rows).cast("int").alias(p) for c, p in (("n", "_n"), ("m", "_m"))]
        hot = counts.groupBy(*cell).agg(*parts).where("_n > 0 AND _m > 0 AND _n + _m > 2")

        def dealt(rows: DataFrame, mine: str, others: str, names: tuple[str, str]) -> DataFrame:
            # A hot cell has more than ``cell_rows`` rows of a side, so there are few.
            cut = rows.join(F.broadcast(hot), cell, "left")
            cut = cut.withColumn(names[0], F.pmod("_spread", F.coalesce(F.col(mine), F.lit(1))).cast("int"))
            each = F.sequence(F.lit(0), F.coalesce(F.col(others), F.lit(1)) - 1)
            return cut.withColumn(names[1], F.explode(each)).drop("_n", "_m", "_spread", "_level")

        x = dealt(own, "_n", "_m", ("_p", "_q")).alias("x")
        # A file's size tells nothing of the rows after they are shown in bins, so Spark is not to broadcast them for it.
        y = dealt(other, "_m", "_n", ("_q", "_p")).hint("merge").alias("y")
        same = reduce(lambda p, q: p & q, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in [*cell, "_p", "_q"]])
        # The first bin that both touch is that of the later start.
        once = F.col("x._bin") == F.expr("shiftright(greatest(x._from, y._from), x._bin_level)")
        overlaps = (F.col("x._from") < F.col("y._to")) & (F.col("y._from") < F.col("x._to"))
        return x.join(y, same & once & overlaps)

    named = [F.col(f"_{side}{i}").alias(c) for side, columns in (("a", left.columns), ("b", given)) for i, c in enumerate(columns)]
    first = met(a, b, levels_of["a"], equal=True).select(*named)
    second = met(b, a, levels_of["b"], equal=False).select(*named)
    return first.unionAll(second)
