"""File against table: fresh, matched and table-only rows as bags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steward.functions.normalize import comparable_text
from steward.operators.names import unused
from steward.session import stored

#: A row repeated more often than this is spread over tasks before it is written out again and again.
COPIES_PER_TASK = 1_000_000


def _check_shape(incoming: DataFrame, stored: DataFrame) -> None:
    if set(incoming.columns) != set(stored.columns):
        raise ValueError(f"columns differ: {sorted(incoming.columns)} and {sorted(stored.columns)}")
    kinds = [(f.name, incoming.schema[f.name].dataType.simpleString(), f.dataType.simpleString()) for f in stored.schema]
    clash = [name for name, one, other in kinds if one != other]
    if clash:
        raise ValueError(f"types differ in {', '.join(clash)}; bring the incoming rows to the table's types first")


def paired_counts(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Each distinct row with the number of its copies on either side, ``_incoming`` and ``_stored``.

    Rows are equal when all columns are, NULL being equal to NULL; the order of the columns does not matter. Both
    sides are counted in one aggregation that combines before it shuffles, so many copies of a row travel as one.
    """
    _check_shape(incoming, stored)
    names = [F.col(f"`{c}`") for c in stored.columns]
    left = incoming.select(*names, F.lit(1).alias("_i"), F.lit(0).alias("_s"))
    right = stored.select(*names, F.lit(0).alias("_i"), F.lit(1).alias("_s"))
    return left.unionAll(right).groupBy(*names).agg(F.sum("_i").alias("_incoming"), F.sum("_s").alias("_stored"))


def _row_hash(df: DataFrame) -> Column:
    """64 bits that are equal for equal rows."""
    return F.xxhash64(*[comparable_text(F.col(f"`{c}`"), df.schema[c].dataType) for c in sorted(df.columns)])


def _met(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored rows that can equal an incoming one: a semi join on a hash of the row.

    When the incoming rows are few, their hashes are broadcast, by Spark's own threshold, and of a large table only what
    they meet is shuffled and counted.
    """
    _check_shape(incoming, stored)
    (name,) = unused(stored.columns, "_hash")
    hashes = incoming.select(_row_hash(incoming).alias(name)).distinct()
    return stored.withColumn(name, _row_hash(stored)).join(hashes, name, "left_semi").drop(name)


def repeat_rows(df: DataFrame, times: str, per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Each row as often as its column ``times`` says, without that column.

    Rows with up to ``per_task`` copies are repeated where they are. The others are first cut into batches, which
    are shuffled apart, so no task writes out all copies of a row.
    """
    kept = [c for c in df.columns if c != times]
    names = [F.col(f"`{c}`") for c in kept]
    copy, left, batch = unused(df.columns, "_copy", "_left", "_batch")
    n = F.col(f"`{times}`")
    few = df.where((n > 0) & (n <= per_task)).select(*names, F.explode(F.sequence(F.lit(1), n)).alias(copy))
    batches = (
        df.where(n > per_task)
        .select(*names, n.alias(left), F.explode(F.sequence(F.lit(0), F.expr(f"(`{times}` - 1) div {per_task}"))).alias(batch))
    )
    spread = batches.repartition(*names, F.col(batch))
    size = F.least(F.lit(per_task).cast("bigint"), F.col(left) - F.col(batch) * per_task)
    many = spread.select(*names, F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias(copy))
    return few.unionAll(many).select(*names)


def _bag(incoming: DataFrame, stored: DataFrame, times: Column) -> DataFrame:
    counted = paired_counts(incoming, stored).withColumn("_times", times).where(F.col("_times") > 0)
    return repeat_rows(counted.drop("_incoming", "_stored"), "_times")


def fresh_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows that have no equal row in the table; each match uses up one stored copy.

    Made for batches that are small beside the table, whose rows are first reduced to those that meet the batch's hashes. Where the
    batch is about as large, that filter is a shuffle of the table in itself; with wide rows take :func:`fresh_rows_by_digest`
    then, as ``plans.load.load_fresh`` does with ``by_digest``.
    """
    return _bag(incoming, _met(incoming, stored), F.col("_incoming") - F.col("_stored"))


def _digest(df: DataFrame) -> Column:
    """SHA-256 of a row: equal for equal rows, and different for others as far as anyone can tell."""
    parts = []
    for name in sorted(df.columns):
        dtype = df.schema[name].dataType
        text = comparable_text(F.col(f"`{name}`"), dtype)
        # The length in front keeps neighbouring values apart; an absent value has none.
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def fresh_rows_by_digest(incoming: DataFrame, stored_rows: DataFrame) -> DataFrame:
    """The result of :func:`fresh_rows`, for wide rows of which few are fresh.

    Only 32-byte digests of the rows are shuffled to find what is fresh; the incoming rows are then read again and
    just the fresh ones are shuffled whole. The fresh digests are stored in the shared scratch folder, which is an
    action. For the table-only rows (E3) swap the arguments.
    """
    _check_shape(incoming, stored_rows)
    digest, times = unused(stored_rows.columns, "_digest", "_n")
    marked = incoming.select(*[F.col(f"`{c}`") for c in stored_rows.columns], _digest(incoming).alias(digest))
    counted = paired_counts(marked.select(digest), stored_rows.select(_digest(stored_rows).alias(digest)))
    fresh = counted.where("_incoming > _stored").select(digest, (F.col("_incoming") - F.col("_stored")).alias(times))
    fresh = stored(fresh, "fresh-digests")
    # Of the copies of a fresh row one stands for all, with their number.
    once = marked.join(fresh.select(digest), digest, "left_semi").dropDuplicates([digest])
    return repeat_rows(once.join(fresh, digest).drop(digest), times)


def matched_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows that have an equal row in the table."""
    return _bag(incoming, _met(incoming, stored), F.least("_incoming", "_stored"))


def stored_only_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored rows that no incoming row matched."""
    return _bag(incoming, stored, F.col("_stored") - F.col("_incoming"))


def match_counters(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: ``incoming_rows, stored_rows, matched, fresh, stored_only``."""
    zero = F.lit(0)
    return paired_counts(incoming, stored).agg(
        F.coalesce(F.sum("_incoming"), zero).alias("incoming_rows"),
        F.coalesce(F.sum("_stored"), zero).alias("stored_rows"),
        F.coalesce(F.sum(F.least("_incoming", "_stored")), zero).alias("matched"),
        F.coalesce(F.sum(F.greatest(F.col("_incoming") - F.col("_stored"), zero)), zero).alias("fresh"),
        F.coalesce(F.sum(F.greatest(F.col("_stored") - F.col("_incoming"), zero)), zero).alias("stored_only"),
    )
