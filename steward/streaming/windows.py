"""Counts in tumbling and session windows over a stream, with late rows kept apart.

Each micro-batch is aggregated by DataFrame operators, merged into the table of open windows, and leaves behind those that the
watermark has passed. The watermark of a batch is the latest time of all earlier batches less the lateness allowed, as in
Structured Streaming; rows whose window it has passed are not counted and not dropped, but go to a table of their own. All four
tables change by commits under the batch's number, and the table of open windows last: a batch that runs again, after a failure at
whatever point, finds what is done and does the rest, so nothing is counted or emitted twice. The stream's checkpoint says which
rows make up a batch.

State is the open windows: what ends later than the watermark, one row a key and window. Results and late rows get a folder each a
batch; ``commits.compact`` makes one of them now and then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from steward.operators.slices import floor_to, micros
from steward.session import stored
from steward.sources.commits import append_once, clean_up, create_committed, current_version, is_applied, read_committed, replace_once

#: Sessions are found in slices of so many gaps, then joined across slices.
SLICE_GAPS = 256

_PROGRESS = T.StructType([T.StructField("batch", T.LongType()), T.StructField("high", T.LongType())])


@dataclass(frozen=True)
class WindowTables:
    """Where the results of :func:`count_windows` are: roots of committed tables."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def closed(self, spark: SparkSession) -> DataFrame:
        """Windows that the watermark has passed: keys, ``window_start``, ``window_end``, ``n``; each once, for good."""
        return read_committed(spark, self.at("closed"))

    def open(self, spark: SparkSession) -> DataFrame:
        """Windows that may still grow."""
        return read_committed(spark, self.at("open"))

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that came after their window was closed, and rows without time, as they came."""
        return read_committed(spark, self.at("late"))


def joined_sessions(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sessions ``(keys, _start, _end, n)`` that overlap made one: a session is continued by what starts before its end."""
    order = Window.partitionBy(*keys).orderBy("_start", "_end")
    reach = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.withColumn("_new", F.when(reach > F.col("_start"), 0).otherwise(1))
    numbered = marked.withColumn("_nth", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy(*keys, "_nth").agg(F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("n").alias("n"))
    return merged.drop("_nth")


def _tumbling(width: int) -> tuple[Callable, Callable]:
    def batch(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        start = floor_to(F.col("_at"), width).alias("_start")
        counted = rows.groupBy(*keys, start).agg(F.count(F.lit(1)).alias("n"))
        return counted.select(*keys, "_start", (F.col("_start") + width).alias("_end"), "n")

    def merge(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
        return parts.groupBy(*keys, "_start", "_end").agg(F.sum("n").alias("n"))

    return batch, merge


def _sessions(gap: int) -> tuple[Callable, Callable]:
    def batch(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        # Equal instants are one row, a slice of a key is a window partition; sessions of slices then meet, one row each.
        instants = rows.groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("n"))
        short = instants.select(
            *keys, floor_to(F.col("_at"), gap * SLICE_GAPS).alias("_slice"), F.col("_at").alias("_start"), (F.col("_at") + gap).alias("_end"), "n"
        )
        return joined_sessions(short, [*keys, "_slice"]).drop("_slice")

    return batch, joined_sessions


def count_windows(
    stream: DataFrame,
    root: str,
    keys: Sequence[str],
    ts: str,
    lateness_seconds: float,
    width_seconds: float | None = None,
    gap_seconds: float | None = None,
    checkpoint: str | None = None,
) -> tuple[StreamingQuery, WindowTables]:
    """Start counting the rows of ``stream`` per key and window; all data there is, then the query ends.

    Windows are calendar slices of ``width_seconds``, or sessions that a pause of ``gap_seconds`` ends; give one of them. Windows
    are half-open. A row is late if its window ends at or before the watermark, with sessions if its time lies before it: it could
    then belong to a session that is closed. Windows are closed in the batch after which the watermark reaches their end.
    Started again on the same ``root``, it goes on where it stopped.
    """
    if (width_seconds is None) == (gap_seconds is None):
        raise ValueError("give width_seconds or gap_seconds")
    step, allowed = round((gap_seconds if width_seconds is None else width_seconds) * 1_000_000), round(lateness_seconds * 1_000_000)
    if step <= 0 or allowed < 0:
        raise ValueError("windows must have a length, and lateness must not be negative")
    in_batch, merge = (_sessions if width_seconds is None else _tumbling)(step)
    spark, tables = stream.sparkSession, WindowTables(root)
    slots = [f"_k{i}" for i in range(len(keys))]
    key_fields = [T.StructField(k, stream.schema[k].dataType) for k in keys]
    time = T.TimestampType() if isinstance(stream.schema[ts].dataType, T.TimestampType) else T.TimestampNTZType()
    shape = T.StructType(
        [*key_fields, T.StructField("window_start", time), T.StructField("window_end", time), T.StructField("n", T.LongType())]
    )
    for name, schema in (("closed", shape), ("open", shape), ("late", stream.schema), ("progress", _PROGRESS)):
        _made(spark, tables.at(name), schema)

    def shown(windows: DataFrame) -> DataFrame:
        named = [F.col(s).alias(k) for s, k in zip(slots, keys)]
        times = [F.timestamp_micros(c).cast(time).alias(f"window{c}") for c in ("_start", "_end")]
        return windows.select(*named, *times, F.col("n").cast("long").alias("n"))

    def hidden(windows: DataFrame) -> DataFrame:
        named = [F.col(f"`{k}`").alias(s) for s, k in zip(slots, keys)]
        return windows.select(*named, micros(F.col("window_start")).alias("_start"), micros(F.col("window_end")).alias("_end"), "n")

    def comes_late(at: Column, watermark: int) -> Column:
        return floor_to(at, step) + step <= watermark if gap_seconds is None else at < watermark

    def one_batch(rows: DataFrame, number: int) -> None:
        batch = str(number)
        if is_applied(spark, tables.at("open"), batch):
            return
        held = stored(rows, "stream-batch")
        # Of this batch and the one before, so that a batch that runs again starts from the same watermark.
        known = {r["batch"]: r["high"] for r in read_committed(spark, tables.at("progress")).collect() if r["batch"] < number}
        high = known[max(known)] if known else None
        at = micros(F.col(f"`{ts}`"))
        passed = at.isNull() | comes_late(at, high - allowed) if high is not None else at.isNull()
        append_once(held.where(passed), tables.at("late"), batch)
        fresh = held.where(~passed).select(*[F.col(f"`{k}`").alias(s) for s, k in zip(slots, keys)], at.alias("_at"))
        before = hidden(read_committed(spark, tables.at("open")))
        windows = stored(merge(in_batch(fresh, slots).unionByName(before), slots), "stream-windows")
        newest, earlier = held.agg(F.max(at)).first()[0], high
        high = max((v for v in (high, newest) if v is not None), default=None)
        closes = F.col("_end") <= high - allowed if high is not None else F.lit(False)
        append_once(shown(windows.where(closes)), tables.at("closed"), batch)
        reached = [(number - 1, earlier), (number, high)]
        replace_once(spark.createDataFrame(reached, _PROGRESS), tables.at("progress"), batch)
        replace_once(shown(windows.where(~closes)), tables.at("open"), batch)
        for name in ("progress", "open"):
            clean_up(spark, tables.at(name))

    writer = stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint or tables.at("checkpoint"))
    return writer.trigger(availableNow=True).start(), tables


def _made(spark: SparkSession, root: str, schema: T.StructType) -> None:
    try:
        current_version(spark, root)
    except ValueError:
        create_committed(spark, root, schema)
