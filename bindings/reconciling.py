"""Bags of rows compared, and keys checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.operators import keys, reconcile


def _customers(spark, sf):
    incoming = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"))
    return incoming, table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))


def _parts(spark, sf):
    incoming = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey"), F.col("l_quantity").cast("int").alias("n"))
    return incoming, table(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), F.col("p_size").alias("n"))


# Whole rows with NULLs in them: what users did, with another kind of event unknown on either side.
def _events(spark, sf):
    events = table(spark, sf, "events")
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    incoming = events.select("user_id", kind.alias("kind"))
    other = F.when(F.col("event_type") != "view", F.col("event_type"))
    return incoming, events.select(other.alias("kind"), "user_id")


INCOMING = "SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, user_id FROM events"
STORED = "SELECT CASE WHEN event_type <> 'view' THEN event_type END AS kind, user_id FROM events"


@query("E1_fresh_rows", "SELECT o_custkey AS custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
def e1(spark, sf):
    return reconcile.fresh_rows(*_customers(spark, sf))


@query("E1b_fresh_rows_with_nulls", f"{INCOMING} EXCEPT ALL {STORED}")
def e1b(spark, sf):
    return reconcile.fresh_rows(*_events(spark, sf))


@query(
    "E1c_fresh_rows_by_digest",
    """
    SELECT doc_id, text, lang, CAST(n_chars AS DOUBLE) AS size FROM documents
    EXCEPT ALL SELECT doc_id, text, CASE WHEN quality = 1 THEN lang END, CAST(n_chars AS DOUBLE)
    FROM documents JOIN labels USING (doc_id)
    """,
)
def e1c(spark, sf):
    # The stored side has the labelled documents, some of them with an unknown language.
    documents, size = table(spark, sf, "documents"), F.col("n_chars").cast("double").alias("size")
    known = F.when(F.col("quality") == 1, F.col("lang")).alias("lang")
    stored = documents.join(table(spark, sf, "labels"), "doc_id").select("doc_id", "text", known, size)
    return reconcile.fresh_rows_by_digest(documents.select("doc_id", "text", "lang", size), stored)


@query("E2_matched_rows", "SELECT o_custkey AS custkey FROM orders INTERSECT ALL SELECT c_custkey FROM customer")
def e2(spark, sf):
    return reconcile.matched_rows(*_customers(spark, sf))


@query(
    "E2b_match_counters",
    f"""
    SELECT (SELECT count(*) FROM events) AS incoming_rows, (SELECT count(*) FROM events) AS stored_rows,
           (SELECT count(*) FROM ({INCOMING} INTERSECT ALL {STORED})) AS matched,
           (SELECT count(*) FROM ({INCOMING} EXCEPT ALL {STORED})) AS fresh,
           (SELECT count(*) FROM ({STORED} EXCEPT ALL {INCOMING})) AS stored_only
    """,
)
def e2b(spark, sf):
    return reconcile.match_counters(*_events(spark, sf))


@query(
    "E3_stored_only_rows",
    """
    SELECT p_partkey AS partkey, p_size AS n FROM part
    EXCEPT ALL SELECT l_partkey, CAST(l_quantity AS INT) FROM lineitem
    """,
)
def e3(spark, sf):
    return reconcile.stored_only_rows(*_parts(spark, sf))


KEY = ["l_orderkey", "l_linenumber"]


@query(
    "S10_key_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def s10(spark, sf):
    return keys.key_violations(table(spark, sf, "lineitem"), KEY)


@query(
    "S10b_keys_taken",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1 OR o_custkey IN (SELECT c_custkey FROM customer)",
)
def s10b(spark, sf):
    stored = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return keys.key_violations(table(spark, sf, "orders"), ["o_custkey"], stored)


@query(
    "S10c_rows_with_bad_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    """,
)
def s10c(spark, sf):
    lines = table(spark, sf, "lineitem").select(*KEY, "l_partkey")
    return keys.split_violations(lines, keys.key_violations(lines, KEY), KEY)[1]


# Nested rows: a zero of either sign in a list, and two map entries in either order.
def _nested(spark, sf):
    events = table(spark, sf, "events")
    zero = F.when(F.col("event_id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))

    def rows(df, first, second):
        entries = F.map_from_arrays(F.array(F.lit(first), F.lit(second)), F.array(F.lit(1), F.lit(1)))
        return df.select("user_id", F.array(zero).alias("zeros"), entries.alias("entries"))

    return rows(events, "a", "b"), rows(events.where("event_type <> 'view'"), "b", "a")


NESTED_SQL = """
    SELECT user_id, count(*) - count(*) FILTER (event_type <> 'view') AS n FROM events
    GROUP BY user_id HAVING count(*) > count(*) FILTER (event_type <> 'view')
"""


@query("E1d_fresh_nested_rows", NESTED_SQL)
def e1d(spark, sf):
    return reconcile.fresh_rows(*_nested(spark, sf)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("E1e_fresh_nested_rows_by_digest", NESTED_SQL)
def e1e(spark, sf):
    return reconcile.fresh_rows_by_digest(*_nested(spark, sf)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
