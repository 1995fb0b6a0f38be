"""X1 and X2 on events that arrive as files: a batch for each eight days, some of the events one batch late."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.session import scratch_path
from steward.streaming.double_spend import double_spend_stream
from steward.streaming.windows import count_windows

FILES = 4
BATCHES = range(5)

#: Events with their batch, each batch's watermark at four days, and that of the end.
ARRIVALS_SQL = """
    WITH a AS (SELECT *, (day(ts) - 1) // 8 + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS batch FROM events),
    h AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 4 DAYS AS mark
          FROM a GROUP BY batch),
    r AS (SELECT a.*, mark, time_bucket(INTERVAL 6 HOURS, ts) AS window_start FROM a JOIN h USING (batch)),
    f AS (SELECT max(ts) - INTERVAL 4 DAYS AS final FROM a)
"""


def arrivals(spark, sf, closing: bool = False):
    """The events as a stream. ``closing`` adds a last file with an event a year later, which moves the watermark past all."""
    path = scratch_path(spark, "arrivals")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    late = F.when(F.col("event_id") % 17 == 0, 1).otherwise(0)
    batch = F.floor((F.dayofmonth("ts") - 1) / 8) + late
    for b in BATCHES:
        # Files are taken by the time they were written, so many a batch.
        events.where(batch == b).repartition(FILES).write.parquet(f"{path}/batch-{b}")
    if closing:
        last = events.agg(F.max("ts").alias("ts")).selectExpr(
            "CAST(-1 AS BIGINT) AS event_id", "ts + INTERVAL 365 DAYS AS ts", "CAST(NULL AS BIGINT) AS user_id",
            "CAST(NULL AS STRING) AS event_type", "CAST(NULL AS DOUBLE) AS value",
        )
        last.write.parquet(f"{path}/batch-{len(BATCHES)}")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(f"{path}/*")


def _counted(spark, sf, key, **windows):
    running, tables = count_windows(arrivals(spark, sf), scratch_path(spark, "windows"), [key], "ts", 4 * 86400, **windows)
    running.awaitTermination()
    return tables


@query(
    "X1_tumbling_windows",
    ARRIVALS_SQL
    + """
    SELECT event_type, window_start, window_start + INTERVAL 6 HOURS AS window_end, count(*) AS n FROM r, f
    WHERE (mark IS NULL OR window_start + INTERVAL 6 HOURS > mark) AND window_start + INTERVAL 6 HOURS <= final
    GROUP BY event_type, window_start
    """,
)
def x1(spark, sf):
    return _counted(spark, sf, "event_type", width_seconds=6 * 3600).closed(spark)


@query(
    "X1b_session_windows",
    ARRIVALS_SQL
    + """
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOURS AS window_end, count(*) AS n FROM (
        SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM (
            SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS opens
            FROM r WHERE mark IS NULL OR ts >= mark))
    GROUP BY user_id, nth HAVING max(ts) + INTERVAL 6 HOURS <= (SELECT final FROM f)
    """,
)
def x1b(spark, sf):
    return _counted(spark, sf, "user_id", gap_seconds=6 * 3600).closed(spark)


@query(
    "X1c_late_rows",
    ARRIVALS_SQL + "SELECT event_id, ts, user_id, event_type, value FROM r WHERE window_start + INTERVAL 6 HOURS <= mark",
)
def x1c(spark, sf):
    return _counted(spark, sf, "event_type", width_seconds=6 * 3600).late(spark)


@query(
    "X2_double_spend_stream",
    """
    SELECT user_id, event_type, event_id, ts, previous_id, gap_micros FROM (
        SELECT event_id, user_id, event_type, ts, lag(event_id) OVER w AS previous_id,
               date_diff('microsecond', lag(ts) OVER w, ts) AS gap_micros
        FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
    WHERE gap_micros <= 3600000000
    """,
)
def x2(spark, sf):
    """All of Q6's rows, whatever the order of arrival within nine days."""
    found = double_spend_stream(arrivals(spark, sf, closing=True), ["user_id", "event_type"], "ts", "event_id", 3600, 9 * 86400)
    path = scratch_path(spark, "double-spends")
    running = found.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "checkpoint"))
    running.trigger(availableNow=True).start(path).awaitTermination()
    schema = found.schema
    return spark.read.schema(schema).parquet(path).withColumn("user_id", F.col("user_id").cast("long"))
