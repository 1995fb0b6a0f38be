"""Joins on time over events, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.operators.temporal_joins import asof_join, overlap_join


@query(
    "J1_asof_join",
    """
    SELECT event_id, user_id, ts, o_orderkey, o_ordertime, o_totalprice
    FROM events ASOF LEFT JOIN (
        SELECT max(o_orderkey) AS o_orderkey, o_custkey, o_orderdate + INTERVAL 25 YEARS AS o_ordertime,
               arg_max(o_totalprice, o_orderkey) AS o_totalprice
        FROM orders GROUP BY o_custkey, o_orderdate) AS o
    ON user_id = o_custkey AND ts >= o_ordertime
    """,
)
def j1(spark, sf):
    """Each event with the latest earlier order of its customer; orders are moved by 25 years to lie around the events."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.expr("o_orderdate + INTERVAL 25 YEARS").alias("o_ordertime"), "o_totalprice"
    )
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    found = asof_join(events, orders, [("user_id", "o_custkey")], "ts", "o_ordertime", tie=["o_orderkey"])
    return found.drop("o_custkey")


@query(
    "J1b_asof_join_within_types",
    """
    SELECT e.event_id, e.user_id, e.ts, v.event_id AS view_id, v.ts AS view_ts
    FROM (SELECT * FROM events WHERE event_type <> 'view') AS e
    ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') AS v ON e.user_id = v.user_id AND e.ts > v.ts
    WHERE v.ts >= e.ts - INTERVAL 6 HOURS
    """,
)
def j1b(spark, sf):
    """Each other event with the latest view of its user in the six hours before it."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    views = events.where("event_type = 'view'").selectExpr("user_id", "event_id AS view_id", "ts AS view_ts")
    others = events.where("event_type <> 'view'").drop("event_type")
    return asof_join(
        others, views, ["user_id"], "ts", "view_ts", ["view_id"], strict=True, max_age_seconds=6 * 3600, how="inner"
    )


@query(
    "J2_interval_overlaps",
    """
    SELECT o_orderkey, l_orderkey, l_linenumber, l_suppkey
    FROM (SELECT o_orderkey, o_custkey % 100 AS supplier, o_orderdate AS opened,
                 o_orderdate + to_days(CAST(1 + o_orderkey % 90 AS INT)) AS closed FROM orders)
    JOIN (SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate AS sent,
                 l_shipdate + to_days(CAST(l_quantity AS INT)) AS arrived FROM lineitem)
    ON supplier = l_suppkey AND opened < arrived AND sent < closed AND opened < closed AND sent < arrived
    """,
)
def j2(spark, sf):
    """Orders open while a supplier's parcel is on its way, open for 1 to 90 days, under way for as many days as pieces."""
    days = lambda n: F.make_dt_interval(days=n.cast("int"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 100).alias("supplier"), F.col("o_orderdate").alias("opened"),
        (F.col("o_orderdate") + days(1 + F.col("o_orderkey") % 90)).alias("closed"),
    )
    parcels = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").alias("sent"),
        (F.col("l_shipdate") + days(F.col("l_quantity"))).alias("arrived"),
    )
    pairs = overlap_join(orders, parcels, ("opened", "closed"), ("sent", "arrived"), [("supplier", "l_suppkey")])
    return pairs.select("o_orderkey", "l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "J2b_interval_overlaps_without_key",
    """
    SELECT a.event_id, b.event_id AS error_id
    FROM (SELECT event_id, ts, ts + to_seconds(CAST(round(value * 10) AS BIGINT)) AS until FROM events WHERE event_type <> 'error') AS a
    JOIN (SELECT event_id, ts, ts + to_seconds(CAST(round(value) AS BIGINT)) AS until FROM events WHERE event_type = 'error') AS b
    ON a.ts < b.until AND b.ts < a.until AND a.ts < a.until AND b.ts < b.until
    """,
)
def j2b(spark, sf):
    """Events that last ten seconds a unit of value, with the errors that last a second a unit, by time alone."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    until = lambda times: start + F.round(F.col("value") * times).cast("long") * 1_000_000
    events = table(spark, sf, "events")
    lasting = events.where("event_type <> 'error'").select("event_id", start.alias("a_from"), until(10).alias("a_to"))
    errors = events.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), start.alias("b_from"), until(1).alias("b_to"))
    return overlap_join(lasting, errors, ("a_from", "a_to"), ("b_from", "b_to")).select("event_id", "error_id")
