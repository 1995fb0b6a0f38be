"""Double spends found as rows arrive (X2): keyed state with event-time timers.

What is kept of a group (rows equal in source, destination and amount) are the rows that the watermark has not passed, for an earlier
one may still come, and the last row before them, for as long as it can be near enough to count. Whatever the order of arrival
within the lateness allowed, rows are judged in the order of their time, as the batch operator does. Groups share a fixed number of
states, by hash of the group, each judged column by column. A timer wakes a state when the watermark reaches its next row, or when
a group's last row is too old for any other; a state without rows is removed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from steward.operators.slices import micros

#: Groups are dealt into so many states by hash, so that a batch costs a call of Python for each of these and not for each group.
BUCKETS = 2048

# Rows that wait and the last rows of groups, as the bytes of columns: the place of the row's group in ``groups``, time and id.
_STATE = T.StructType(
    [T.StructField("groups", T.ArrayType(T.StringType()))]
    + [T.StructField(f"{part}_{name}", T.BinaryType()) for part in ("pending", "last") for name in ("group", "_at", "_id")]
)
_NUMBERS = {"group": "int32", "_at": "int64", "_id": "int64"}


def _rows_of(state: tuple | None, part: str) -> pd.DataFrame:
    """The rows of one part of a state, as ``(_key, _at, _id)``."""
    if state is None:
        return pd.DataFrame({"_key": pd.Series([], dtype=object), "_at": np.array([], "int64"), "_id": np.array([], "int64")})
    held = dict(zip(_STATE.names, state))
    at = {name: np.frombuffer(bytes(held[f"{part}_{name}"]), dtype) for name, dtype in _NUMBERS.items()}
    return pd.DataFrame({"_key": np.array(held["groups"], dtype=object)[at["group"]], "_at": at["_at"], "_id": at["_id"]})


def _state_of(pending: pd.DataFrame, last: pd.DataFrame) -> tuple:
    places, groups = pd.factorize(pd.concat([pending["_key"], last["_key"]]))
    parts = []
    for rows, at in ((pending, places[: len(pending)]), (last, places[len(pending) :])):
        parts += [column.astype(dtype).tobytes() for column, dtype in zip((at, rows["_at"].to_numpy(), rows["_id"].to_numpy()), _NUMBERS.values())]
    return ([str(g) for g in groups], *parts)


def double_spend_stream(
    stream: DataFrame, same: Sequence[str], ts: str, tx_id: str, within_seconds: float = 0.5, lateness_seconds: float = 10
) -> DataFrame:
    """Rows of ``stream`` that repeat the preceding row of their group within ``within_seconds``, as a stream in append mode.

    Gives the ``same`` columns (as text, NULL being equal to NULL), ``tx_id``, ``ts``, ``previous_id`` and ``gap_micros``; the rows of
    ``operators.analytics.double_spend``, each once the watermark has passed its time. Ids are whole numbers. Rows without time are
    left out, and so are rows that come later than the watermark allows; the engine takes that of the batch before for it. Rows of
    one time are ordered by id.
    """
    limit = round(within_seconds * 1_000_000)
    if limit < 0:
        raise ValueError("within_seconds must not be negative")
    times = stream.where(F.col(f"`{ts}`").isNotNull())
    slots = [f"_k{i}" for i in range(len(same))]
    rows = times.select(
        *[F.col(f"`{c}`").cast("string").alias(s) for c, s in zip(same, slots)],
        F.col(f"`{ts}`").cast("timestamp").alias("_ts"), micros(F.col(f"`{ts}`")).alias("_at"), F.col(f"`{tx_id}`").cast("long").alias("_id"),
    ).withWatermark("_ts", f"{round(lateness_seconds * 1000)} milliseconds")
    key = F.struct(*[F.col(s) for s in slots])
    out = T.StructType(
        [T.StructField("_key", T.StringType()), T.StructField("_at", T.LongType()), T.StructField("_id", T.LongType()),
         T.StructField("previous_id", T.LongType()), T.StructField("gap_micros", T.LongType())]
    )

    def judge(bucket: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None
        new = [] if state.hasTimedOut else [part[["_key", "_at", "_id"]] for part in parts]
        waiting = pd.concat([_rows_of(held, "pending"), *new], ignore_index=True)
        last = _rows_of(held, "last")
        passed = state.getCurrentWatermarkMs() * 1000
        due = waiting["_at"] < passed
        pending = waiting[~due]
        # The last row of a group, of which the state has one at most, comes before all that are due.
        line = pd.concat([last.assign(_new=1), waiting[due].assign(_new=2)], ignore_index=True)
        line = line.sort_values(["_key", "_new", "_at", "_id"], ignore_index=True)
        same = (line["_key"] == line["_key"].shift()).to_numpy(dtype=bool)
        before = line[["_at", "_id"]].shift(fill_value=0)
        gap = line["_at"] - before["_at"]
        hit = same & (line["_new"] == 2).to_numpy() & (gap <= limit).to_numpy()
        found = line.assign(previous_id=before["_id"], gap_micros=gap)[hit]
        last = line[~line["_key"].duplicated(keep="last").to_numpy(dtype=bool)]
        last = last[last["_at"] + limit >= passed]
        if len(pending) or len(last):
            state.update(_state_of(pending, last))
            wakes = min(([int(pending["_at"].min())] if len(pending) else []) + ([int(last["_at"].min()) + limit] if len(last) else []))
            # Timers are in milliseconds and must lie beyond the watermark.
            state.setTimeoutTimestamp(max(wakes // 1000 + 1, passed // 1000 + 1))
        elif state.exists:
            state.remove()
        if len(found):
            yield found[out.names].reset_index(drop=True)

    keyed = rows.withColumn("_key", F.to_json(key, {"ignoreNullFields": "false"}))
    dealt = keyed.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)).cast("int"))
    judged = dealt.groupBy("_bucket").applyInPandasWithState(judge, out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    parts = F.from_json("_key", T.StructType([T.StructField(s, T.StringType()) for s in slots]))
    kept = stream.schema[ts].dataType
    return judged.withColumn("_parts", parts).select(
        *[F.col(f"_parts.{s}").alias(c) for s, c in zip(slots, same)], F.col("_id").alias(tx_id),
        F.timestamp_micros("_at").cast(kept).alias(ts), "previous_id", "gap_micros",
    )
