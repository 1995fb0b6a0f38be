"""Q1-Q7 on the driver's star schema.

Users are customers, transactions are orders (volume) or events (time), countries are nations, and reviews are
events with the type as category and the value as score.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.operators import analytics


@query(
    "Q1_row_counts",
    """
    SELECT 'Users count:' AS label, count(*) AS n FROM customer
    UNION ALL SELECT 'Accounts count:', count(*) FROM nation
    UNION ALL SELECT 'Transactions count:', count(*) FROM orders
    """,
)
def q1(spark, sf):
    return analytics.row_counts(
        {
            "Users count:": table(spark, sf, "customer"),
            "Accounts count:": table(spark, sf, "nation"),
            "Transactions count:": table(spark, sf, "orders"),
        }
    )


@query(
    "Q2_rapid_fire_by_day",
    """
    SELECT user_id, date_trunc('day', ts) AS bucket, count(*) AS tx_count
    FROM events GROUP BY user_id, date_trunc('day', ts) HAVING count(*) > 3
    """,
)
def q2(spark, sf):
    return analytics.rapid_fire_by_bucket(table(spark, sf, "events"), "user_id", "ts", "day", 3)


@query(
    "Q2b_rapid_fire_by_hour",
    """
    SELECT event_type, date_trunc('hour', ts) AS bucket, count(*) AS tx_count
    FROM events GROUP BY event_type, date_trunc('hour', ts) HAVING count(*) > 3
    """,
)
def q2b(spark, sf):
    return analytics.rapid_fire_by_bucket(table(spark, sf, "events"), "event_type", "ts", "hour", 3)


@query(
    "Q3_top_groups_by_volume",
    """
    SELECT n_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_vol
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY total_vol DESC, n_name LIMIT 5
    """,
)
def q3(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return analytics.top_groups_by_volume(
        orders,
        table(spark, sf, "customer"),
        table(spark, sf, "nation"),
        tx_account="o_custkey",
        account_id="c_custkey",
        account_owner="c_nationkey",
        owner_id="n_nationkey",
        group="n_name",
        amount="amount",
    )


@query(
    "Q3b_top_groups_by_fine_volume",
    """
    SELECT c_mktsegment, sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS total_vol
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment ORDER BY total_vol DESC, c_mktsegment LIMIT 3
    """,
)
def q3b(spark, sf):
    exact = (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)").alias("amount")
    return analytics.top_groups_by_volume(
        table(spark, sf, "lineitem").select("l_orderkey", exact),
        table(spark, sf, "orders"),
        table(spark, sf, "customer"),
        tx_account="l_orderkey",
        account_id="o_orderkey",
        account_owner="o_custkey",
        owner_id="c_custkey",
        group="c_mktsegment",
        amount="amount",
        top=3,
    )


@query(
    "Q4_mean_by_group",
    """
    SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean_value
    FROM events GROUP BY event_type ORDER BY mean_value DESC
    """,
)
def q4(spark, sf):
    means = analytics.mean_by_group(table(spark, sf, "events"), "event_type", "value", scale=2)
    return means.orderBy(F.col("mean_value").desc_nulls_last())


@query(
    "Q4b_mean_of_fine_values",
    """
    SELECT l_returnflag, CAST(sum(CAST(l_discount * l_tax AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_value
    FROM lineitem GROUP BY l_returnflag
    """,
)
def q4b(spark, sf):
    product = (F.col("l_discount") * F.col("l_tax")).cast("decimal(18,4)").alias("value")
    return analytics.mean_by_group(table(spark, sf, "lineitem").select("l_returnflag", product), "l_returnflag", "value")


@query(
    "Q5b_rapid_fire_with_null_keys",
    """
    SELECT event_id, kind, ts, tx_count FROM (
        SELECT event_id, kind, ts, count(*) OVER (
            PARTITION BY kind ORDER BY ts
            RANGE BETWEEN INTERVAL 1 HOURS PRECEDING AND CURRENT ROW) AS tx_count
        FROM (SELECT event_id, nullif(event_type, 'view') AS kind, date_trunc('minute', ts) AS ts FROM events))
    WHERE tx_count > 3
    """,
)
def q5b(spark, sf):
    kind = F.nullif(F.col("event_type"), F.lit("view")).alias("kind")
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts")
    return analytics.rapid_fire_in_frame(table(spark, sf, "events").select("event_id", kind, minute), "kind", "ts", 3600, 3)


@query(
    "Q5_rapid_fire_in_frame",
    """
    SELECT event_id, user_id, ts, tx_count FROM (
        SELECT event_id, user_id, ts, count(*) OVER (
            PARTITION BY user_id ORDER BY ts
            RANGE BETWEEN INTERVAL 12 HOURS PRECEDING AND CURRENT ROW) AS tx_count
        FROM events) WHERE tx_count > 3
    """,
)
def q5(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return analytics.rapid_fire_in_frame(events, "user_id", "ts", 12 * 3600, 3)


@query(
    "Q6_double_spend",
    """
    SELECT event_id, user_id, event_type, ts, previous_id, gap_micros FROM (
        SELECT event_id, user_id, event_type, ts, lag(event_id) OVER w AS previous_id,
               date_diff('microsecond', lag(ts) OVER w, ts) AS gap_micros
        FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
    WHERE gap_micros <= 3600000000
    """,
)
def q6(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return analytics.double_spend(events, ["user_id", "event_type"], "ts", "event_id", 3600)


@query(
    "Q7_rank_by_mean",
    """
    SELECT event_type, mean_value, rank() OVER (ORDER BY mean_value DESC) AS sentiment_rank FROM (
        SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean_value
        FROM events GROUP BY event_type)
    """,
)
def q7(spark, sf):
    return analytics.rank_by_mean(table(spark, sf, "events"), "event_type", "value", scale=2)


@query(
    "Q7b_rank_users_by_mean",
    """
    SELECT user_id, mean_value, rank() OVER (ORDER BY mean_value DESC) AS sentiment_rank FROM (
        SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean_value
        FROM events GROUP BY user_id)
    """,
)
def q7b(spark, sf):
    return analytics.rank_by_mean(table(spark, sf, "events"), "user_id", "value", scale=2)
