"""Totals at several grains, stored sketches of batches, and nested fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.operators import fields, grains, sketches
from steward.operators.quantiles import exact_quantiles
from steward.session import scratch_path
from steward.sources.commits import append_once, create_committed, read_committed


def _volumes(spark, sf):
    """One row per nation, segment and priority and customer: orders are summed before they meet the joins."""
    orders = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("volume"), F.count(F.lit(1)).alias("orders")
    )
    owners = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    joined = orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("n_name", "c_mktsegment", "o_orderpriority", "volume", "orders")


_VOLUMES_SQL = """
    SELECT n_name, c_mktsegment, o_orderpriority, CAST(grouping(n_name, c_mktsegment, o_orderpriority) AS BIGINT) AS grain, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY {}
"""
GRAIN_COLUMNS = ("n_name", "c_mktsegment", "o_orderpriority")


@query("R1_volume_rollup", _VOLUMES_SQL.format("ROLLUP (n_name, c_mktsegment, o_orderpriority)"))
def r1(spark, sf):
    return grains.totals_by_grains(_volumes(spark, sf), grains.rollup(GRAIN_COLUMNS), "volume", weight="orders")


@query("R1b_volume_cube", _VOLUMES_SQL.format("CUBE (n_name, c_mktsegment, o_orderpriority)"))
def r1b(spark, sf):
    return grains.totals_by_grains(_volumes(spark, sf), grains.cube(GRAIN_COLUMNS), "volume", weight="orders")


@query(
    "R1c_event_grains",
    """
    SELECT user_id, event_type, bucket, CAST(grouping(user_id, event_type, bucket) AS BIGINT) AS grain, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(28,2))) AS DECIMAL(38,2)) AS total,
           CAST(sum(CAST(value AS DECIMAL(28,2))) AS DOUBLE) / count(value) AS mean_value
    FROM (SELECT user_id, nullif(event_type, 'view') AS event_type, date_trunc('day', ts) AS bucket, value FROM events)
    GROUP BY GROUPING SETS ((user_id, event_type), (event_type, bucket), (bucket), ())
    """,
)
def r1c(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("bucket"), "value"
    )
    sets = [("user_id", "event_type"), ("event_type", "bucket"), ("bucket",), ()]
    totals = grains.totals_by_grains(events, sets, "value", scale=2)
    return totals


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _stored_sketches(spark, sf):
    """The sketches of lineitem in four batches, each appended to one table; no row is read a second time."""
    root = scratch_path(spark, "sketches")
    create_committed(spark, root, sketches.SKETCH)
    lines = table(spark, sf, "lineitem").select(*LINE_COLUMNS)
    for batch in range(4):
        append_once(sketches.sketch_batch(lines.where(F.col("l_orderkey") % 4 == batch)), root, f"batch {batch}")
    return read_committed(spark, root)


_UNPIVOT_SQL = f"UNPIVOT (SELECT columns(*)::VARCHAR FROM (SELECT {', '.join(LINE_COLUMNS)} FROM lineitem)) ON columns(*) INTO NAME \"column\" VALUE value"


@query(
    "K1_sketched_counts",
    f"""
    SELECT "column", (SELECT count(*) FROM lineitem) AS n, count(*) AS filled, true AS within_3_percent
    FROM ({_UNPIVOT_SQL}) GROUP BY "column"
    """,
)
def k1(spark, sf):
    """Rows and filled values, and whether the distinct count is within 3 % (four standard errors) of the exact one."""
    estimated = sketches.distinct_counts(_stored_sketches(spark, sf))
    lines = table(spark, sf, "lineitem").select(*LINE_COLUMNS)
    cells = lines.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in LINE_COLUMNS])))
    exact = cells.distinct().groupBy("column").agg(F.count("value").alias("exact"))
    fits = F.abs(F.col("distinct") - F.col("exact")) <= 0.03 * F.col("exact")
    return estimated.join(exact, "column").select("column", "n", "filled", fits.alias("within_3_percent"))


@query(
    "K1b_sketched_quantiles",
    """
    SELECT "column", share, true AS within_1_percent
    FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_linenumber'), ('l_extendedprice'), ('l_discount'), ('l_tax')) AS c("column"),
         (VALUES (0.01::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.99::DOUBLE)) AS s(share)
    """,
)
def k1b(spark, sf):
    """Whether each quantile is within 1 % of the exact one."""
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    numeric = ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"]
    exact = exact_quantiles(table(spark, sf, "lineitem"), numeric, shares).withColumnRenamed("value", "exact")
    found = sketches.quantiles(_stored_sketches(spark, sf), shares)
    fits = F.abs(F.col("value") - F.col("exact")) <= 0.0100001 * F.abs(F.col("exact"))
    return found.join(exact, ["column", "share"]).select("column", "share", fits.alias("within_1_percent"))


@query(
    "K1c_sketched_frequent_values",
    f"""
    SELECT "column", value, count(*) AS n FROM ({_UNPIVOT_SQL}) AS u
    GROUP BY "column", value HAVING count(*) >= 0.03 * (SELECT count(*) FROM lineitem)
    """,
)
def k1c(spark, sf):
    """Values of 3 % of the rows or more; each batch holds them often enough, so the counts are exact."""
    return sketches.frequent_values(_stored_sketches(spark, sf), 0.03)


#: A record of ragged types for each event, made alike by both engines.
_RECORD = """
    concat('{"props": ', props, ', "id": ', event_id, ', "v": ',
        CASE event_id % 6 WHEN 0 THEN '"text"' WHEN 1 THEN '12' WHEN 2 THEN '1.5' WHEN 3 THEN 'null'
            WHEN 4 THEN '{"deep": {"k": [1, "two", {"three": [true, null, []]}]}}' ELSE '[{"a": 1}, {"a": "x", "b": -3}]' END,
        CASE WHEN event_id % 10 = 0 THEN ', "more": {}' ELSE '' END, CASE WHEN event_id % 97 = 0 THEN '' ELSE '}' END)
"""


@query(
    "D4d_nested_fields",
    f"""
    WITH r AS (SELECT {_RECORD} AS record FROM events)
    SELECT path, type, count(*) AS n FROM (
        SELECT regexp_replace(fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path,
            CASE t.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer'
                WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' END AS type
        FROM (SELECT record FROM r WHERE json_valid(record)), json_tree(record) AS t
        UNION ALL SELECT '$', 'invalid' FROM r WHERE NOT json_valid(record))
    GROUP BY path, type
    """,
)
def d4d(spark, sf):
    records = table(spark, sf, "events").select(F.expr(_RECORD).alias("record"))
    return fields.nested_fields(records, "record")


@query(
    "D4e_type_conflicts",
    """
    SELECT * FROM (VALUES ('$', ['invalid', 'object']), ('$.v', ['array', 'integer', 'number', 'object', 'string']),
        ('$.v[].a', ['integer', 'string']), ('$.v.deep.k[]', ['integer', 'object', 'string']),
        ('$.v.deep.k[].three[]', ['array', 'boolean'])) AS c(path, types)
    WHERE (SELECT count(*) FROM events) > 1000
    """,
)
def d4e(spark, sf):
    """Fields found in two parts of the events, merged."""
    records = table(spark, sf, "events").select("event_id", F.expr(_RECORD).alias("record"))
    parts = [fields.nested_fields(records.where(F.col("event_id") % 2 == half), "record") for half in range(2)]
    return fields.type_conflicts(fields.merged_fields(parts))
