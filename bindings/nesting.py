"""Nested records built from every row of ``orders``, ``documents`` and ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.functions import nested


def _orders(spark, sf):
    order = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.struct(
            F.col("o_custkey").alias("secret"),
            F.col("o_orderpriority").alias("priority"),
            F.create_map(F.lit("secret"), "o_orderstatus", F.lit("kept"), "o_orderpriority").alias("notes"),
        ).alias("inner"),
    )
    return table(spark, sf, "orders").select("o_orderkey", order.alias("record"))


@query(
    "F1_remove_keys",
    """
    SELECT o_orderkey, '{"status":"' || o_orderstatus || '","inner":{"priority":"' || o_orderpriority
           || '","notes":{"kept":"' || o_orderpriority || '"}}}' AS record
    FROM orders
    """,
)
def f1(spark, sf):
    orders = _orders(spark, sf)
    smaller = nested.remove_keys(F.col("record"), orders.schema["record"].dataType, ["id", "secret"])
    return orders.select("o_orderkey", F.to_json(smaller).alias("record"))


@query(
    "F2_keep_keys",
    """
    SELECT o_orderkey, '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' AS record,
           '{"kept":"' || o_orderpriority || '"}' AS notes
    FROM orders
    """,
)
def f2(spark, sf):
    orders = _orders(spark, sf)
    kind = orders.schema["record"].dataType
    notes = F.col("record.inner.notes")
    return orders.select(
        "o_orderkey",
        F.to_json(nested.keep_keys(F.col("record"), kind, ["id", "status"])).alias("record"),
        F.to_json(nested.keep_keys(notes, kind["inner"].dataType["notes"].dataType, "kept")).alias("notes"),
    )


@query(
    "F3_distinct_lists",
    """
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words, CAST(max(pos) AS BIGINT) AS last_new
    FROM (SELECT doc_id, word, min(pos) AS pos FROM (
              SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos
              FROM documents) GROUP BY doc_id, word)
    GROUP BY doc_id
    """,
)
def f3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", " ", -1).alias("list"))
    lists = nested.distinct_lists(F.create_map(F.lit("words"), "list"))
    words = docs.select("doc_id", "list", lists["words"].alias("kept"))
    return words.select(
        "doc_id",
        F.array_join("kept", " ").alias("words"),
        F.array_position("list", F.element_at("kept", -1)).alias("last_new"),
    )


@query(
    "F4_pretty_json",
    """
    SELECT p_partkey, '{' || chr(10) || '    "brand": {' || chr(10) || '        "name": "' || p_brand || '",' || chr(10)
           || '        "sizes": [' || chr(10) || '            ' || p_size || ',' || chr(10) || '            null' || chr(10)
           || '        ]' || chr(10) || '    },' || chr(10) || '    "key": ' || p_partkey || ',' || chr(10)
           || '    "made": "2024-01-01 00:00:00"' || chr(10) || '}' AS record
    FROM part
    """,
)
def f4(spark, sf):
    record = F.struct(
        F.lit("2024-01-01").cast("timestamp_ntz").alias("made"),
        F.col("p_partkey").alias("key"),
        F.struct(
            F.array("p_size", F.lit(None)).alias("sizes"),
            F.col("p_brand").alias("name"),
        ).alias("brand"),
    )
    parts = table(spark, sf, "part").select("p_partkey", record.alias("record"))
    return parts.select("p_partkey", nested.pretty_json(F.col("record"), parts.schema["record"].dataType).alias("record"))


@query(
    "F4b_pretty_json_of_floats",
    """
    SELECT p_partkey, '{' || chr(10) || '    "large": ' || CAST(p_size * 1e9 AS VARCHAR) || ',' || chr(10)
           || '    "none": ' || CASE p_partkey % 3 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' ELSE '-Infinity' END || ',' || chr(10)
           || '    "small": ' || CAST(p_size / 1e6 AS VARCHAR) || chr(10) || '}' AS record
    FROM part
    """,
)
def f4b(spark, sf):
    kind = F.col("p_partkey") % 3
    none = F.when(kind == 0, float("nan")).when(kind == 1, float("inf")).otherwise(float("-inf"))
    record = F.struct(
        (F.col("p_size") / F.lit(1e6)).alias("small"), (F.col("p_size") * F.lit(1e9)).alias("large"), none.alias("none")
    )
    parts = table(spark, sf, "part").select("p_partkey", record.alias("record"))
    return parts.select("p_partkey", nested.pretty_json(F.col("record"), parts.schema["record"].dataType).alias("record"))
