"""Exactly-once appends and keyed merges of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.session import scratch_path
from steward.sources.commits import append_once, create_committed, merge_once, read_committed

KEY = ["o_orderkey"]


@query("S9g_append_once", "SELECT * FROM orders")
def s9g(spark, sf):
    """The orders in two batches, each appended again after the other."""
    orders, root = table(spark, sf, "orders"), scratch_path(spark, "committed")
    create_committed(spark, root, orders.schema, KEY, buckets=8)
    for batch in (0, 1, 0, 1):
        append_once(orders.where(F.col("o_orderkey") % 2 == batch), root, f"half {batch}")
    return read_committed(spark, root)


def _merged(spark, sf):
    """Of ten orders one is changed, one deleted, one named again as it is, and one more added."""
    orders, root = table(spark, sf, "orders"), scratch_path(spark, "committed")
    create_committed(spark, root, orders.schema, KEY, buckets=8)
    append_once(orders, root, "all")
    kind = F.col("o_orderkey") % 10
    changes = orders.where(kind < 4).withColumns(
        {
            "o_totalprice": F.when(kind == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderpriority": F.when(kind == 0, F.lit(None)).otherwise(F.col("o_orderpriority")),
            "o_orderkey": F.when(kind == 3, F.col("o_orderkey") + 1_000_000_000_000).otherwise(F.col("o_orderkey")),
            "gone": kind == 1,
        }
    )
    return root, merge_once(changes, root, "changes", deletes="gone")


@query(
    "M1_keyed_merge",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate,
           CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderkey % 10 <> 1
    UNION ALL
    SELECT o_orderkey + 1000000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 10 = 3
    """,
)
def m1(spark, sf):
    root, _ = _merged(spark, sf)
    return read_committed(spark, root)


@query(
    "M1b_merge_classes",
    """
    SELECT CASE o_orderkey % 10 WHEN 0 THEN 'update' WHEN 1 THEN 'delete' WHEN 2 THEN 'same' ELSE 'insert' END AS class, count(*) AS n
    FROM orders WHERE o_orderkey % 10 < 4 GROUP BY ALL
    UNION ALL SELECT 'absent', 0
    """,
)
def m1b(spark, sf):
    _, report = _merged(spark, sf)
    return spark.createDataFrame(list(report.counts.items()), "class string, n long")
