"""Profiles of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.functions.nested import json_depth
from steward.operators import profile


def _profile_sql(name: str, columns: str) -> str:
    per_column = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total, count(nullif(CAST({c} AS VARCHAR), '')) AS filled, "
        f"count(DISTINCT nullif(CAST({c} AS VARCHAR), '')) AS distinct_values FROM {name}"
        for c in columns.split()
    )
    return (
        f"SELECT *, round(distinct_values / filled, 2) AS uniqueness, round(filled / total, 2) AS completeness "
        f"FROM ({per_column}) WHERE filled > 0"
    )


DOCUMENTS = _profile_sql("documents", "doc_id text lang source n_chars")
CUSTOMER = _profile_sql("customer", "c_custkey c_name c_nationkey c_acctbal c_mktsegment")
LINEITEM = _profile_sql(
    "lineitem",
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
    "l_shipdate",
)


@query("D1_D2_profile_documents", DOCUMENTS)
def d1(spark, sf):
    return profile.column_profile(table(spark, sf, "documents"))


@query(
    "D2_completeness_of_sparse_columns",
    """
    SELECT 'given' AS column_name, count(*) AS total, count(g) AS filled, count(DISTINCT g) AS distinct_values,
           round(count(DISTINCT g) / count(g), 2) AS uniqueness, round(count(g) / count(*), 2) AS completeness
    FROM (SELECT CASE WHEN event_type = 'click' THEN NULL WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS g
          FROM events)
    """,
)
def d2(spark, sf):
    kind = F.col("event_type")
    given = F.when(kind == "click", "").when(kind != "error", F.col("user_id").cast("string"))
    sparse = table(spark, sf, "events").select(
        given.alias("given"), F.lit(None).cast("string").alias("never"), F.col("ts").alias("created_at")
    )
    return profile.column_profile(sparse)


@query(
    "D3_candidate_keys",
    f"SELECT column_name, uniqueness, CAST(1 AS INT) AS level FROM ({CUSTOMER}) WHERE uniqueness = 1.0",
)
def d3(spark, sf):
    return profile.candidate_keys(table(spark, sf, "customer"), 1)


@query(
    "D3b_candidate_keys_exact",
    f"""
    SELECT * FROM (SELECT column_name, distinct_values / filled AS uniqueness,
                          CAST(dense_rank() OVER (ORDER BY distinct_values / filled DESC) AS INT) AS level
                   FROM ({CUSTOMER})) WHERE level <= 3
    """,
)
def d3b(spark, sf):
    return profile.candidate_keys(table(spark, sf, "customer"), 3, exact=True)


@query(
    "D3c_candidate_keys_prefiltered",
    f"""
    SELECT * FROM (SELECT column_name, uniqueness, CAST(dense_rank() OVER (ORDER BY uniqueness DESC) AS INT) AS level
                   FROM ({LINEITEM})) WHERE level <= 2
    """,
)
def d3c(spark, sf):
    return profile.candidate_keys(table(spark, sf, "lineitem"), 2, prefilter_error=0.06)


@query("D4_json_fields", "SELECT DISTINCT unnest(json_keys(CAST(props AS JSON))) AS field FROM events")
def d4(spark, sf):
    return profile.json_fields(table(spark, sf, "events"), "props")


@query(
    "D4b_map_fields",
    "SELECT DISTINCT field FROM (SELECT event_type AS field FROM events UNION ALL SELECT 'user' FROM events)",
)
def d4b(spark, sf):
    records = table(spark, sf, "events").select(
        F.create_map(F.col("event_type"), F.col("value"), F.lit("user"), F.col("user_id").cast("double")).alias("record")
    )
    return profile.map_fields(records, "record")


@query(
    "D4c_align_ragged",
    """
    SELECT c_acctbal AS acctbal, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_acctbal, s_suppkey, s_name, NULL FROM supplier
    """,
)
def d4c(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS acctbal", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_name AS name", "s_acctbal AS acctbal")
    return profile.align([supplier, customer])


# A document record whose nesting is known from its number. The text holds brackets, quotes and line breaks.
def _records(spark, sf):
    text = F.concat(F.lit('}{"\\['), F.col("text"))
    flat, listed = F.struct("doc_id", text.alias("t")), F.struct(F.array(F.struct(text.alias("t"))).alias("l"))
    kind = F.col("doc_id") % 4
    nested = (
        F.when(kind == 0, F.to_json(flat))
        .when(kind == 1, F.to_json(F.struct(F.lit(1).alias("a"), flat.alias("b"))))
        .when(kind == 2, F.to_json(F.struct(F.struct(flat.alias("c")).alias("b"), F.create_map().alias("e"))))
        .otherwise(F.to_json(listed))
    )
    return table(spark, sf, "documents").select("doc_id", nested.alias("record"))


@query(
    "D5_json_depth",
    "SELECT doc_id, CAST(CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS INT) AS depth FROM documents",
)
def d5(spark, sf):
    return _records(spark, sf).select("doc_id", json_depth(F.col("record")).alias("depth"))


@query("D5b_max_depth", "SELECT max(CAST(CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS INT)) AS depth FROM documents")
def d5b(spark, sf):
    return profile.max_depth(_records(spark, sf), "record")


@query(
    "D5c_max_depth_of_maps",
    """
    WITH r AS (SELECT json_object('a', CASE WHEN event_type = 'view' THEN json_object('user', user_id) ELSE json_object() END) AS j FROM events)
    SELECT CAST(max(length(fullkey) - length(replace(fullkey, '.', ''))) AS INT) AS depth FROM r, json_tree(j)
    """,
)
def d5c(spark, sf):
    inner = F.when(F.col("event_type") == "view", F.create_map(F.lit("user"), F.col("user_id")))
    record = F.create_map(F.lit("a"), F.coalesce(inner, F.create_map().cast("map<string,bigint>")))
    return profile.max_depth(table(spark, sf, "events").select(record.alias("record")), "record")


@query(
    "D1b_profile_of_maps",
    """
    SELECT 'record' AS column_name, count(*) AS total, count(*) AS filled,
           count(DISTINCT (event_type, user_id)) AS distinct_values FROM events
    """,
)
def d1b(spark, sf):
    # The entries come in one order or the other.
    kind, user = F.array(F.lit("kind"), F.col("event_type")), F.array(F.lit("user"), F.col("user_id").cast("string"))
    pairs = F.when(F.col("event_id") % 2 == 0, F.array(kind, user)).otherwise(F.array(user, kind))
    entries = F.transform(pairs, lambda p: F.struct(p[0].alias("key"), p[1].alias("value")))
    records = table(spark, sf, "events").select(F.map_from_entries(entries).alias("record"))
    return profile.column_profile(records).select("column_name", "total", "filled", "distinct_values")
