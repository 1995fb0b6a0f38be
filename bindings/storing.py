"""Whole tables written, read back and appended, in the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.registry import query, table
from bindings.typing import LINE_TYPES, TEXTS_SQL, texts
from steward.operators.coerce import REJECT, accepted, coerce
from steward.operators.profile import align
from steward.session import scratch_path
from steward.plans.load import load_fresh
from steward.sources import files, schemas, sinks, tables


def _declared(spark, schema) -> tuple[str, str]:
    """A new table below the shared scratch folder: its name and its path."""
    name, path = f"scratch_{uuid.uuid4().hex}", scratch_path(spark, "table")
    schemas.declare_table(spark, name, schema, location=path)
    return name, path


def _contents(spark, name, path):
    """The table's rows, readable after its name is gone."""
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


@query(
    "S1_read_csv",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def s1(spark, sf):
    path = scratch_path(spark, "documents.csv")
    sinks.write_csv(table(spark, sf, "documents"), path)
    return accepted(files.read_csv(spark, path))


@query(
    "S1b_read_csv_empty_as_null",
    "SELECT CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_type NOT IN ('view', 'click') THEN event_type END AS kind FROM events",
)
def s1b(spark, sf):
    path = scratch_path(spark, "events.csv")
    kind = F.col("event_type")
    given = F.when(kind == "view", "").when(kind != "click", kind)
    sinks.write_csv(table(spark, sf, "events").select("user_id", given.alias("kind")), path)
    return accepted(files.read_csv(spark, path, newline_free=True))


@query(
    "S2_typed_load",
    """
    SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate,
           o_orderpriority = '1-URGENT' AS urgent FROM orders
    """,
)
def s2(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        "o_orderdate",
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    path = scratch_path(spark, "orders.csv")
    sinks.write_csv(orders, path)
    name, place = _declared(spark, orders.schema)
    sinks.load_csv(spark, path, name, newline_free=True)
    return _contents(spark, name, place)


@query("S3_read_json_arrays", "SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT conv_id, turn, NULL, NULL FROM conversations")
def s3(spark, sf):
    # Each line holds an array of two records, the second without some of the keys.
    talk = table(spark, sf, "conversations")
    pair = F.concat(
        F.lit("["), F.to_json(F.struct(*talk.columns)), F.lit(","), F.to_json(F.struct("conv_id", "turn")), F.lit("]")
    )
    path = scratch_path(spark, "conversations.json")
    talk.select(pair.alias("value")).write.text(path)
    return accepted(files.read_json(spark, path, schema=talk.schema, lines=True))


#: Orders as lines of text: of seven, one is short, one has a value too many and one an unreadable number.
RAGGED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderkey % 7 AS kind FROM orders
"""


def _ragged(spark, sf):
    orders = table(spark, sf, "orders")
    kind = F.col("o_orderkey") % 7
    line = (
        F.when(kind == 1, F.col("o_orderkey").cast("string"))
        .when(kind == 2, F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.lit("EXTRA")))
        .when(kind == 3, F.concat_ws(",", "o_orderkey", F.lit("bad"), "o_orderstatus"))
        .otherwise(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus"))
    )
    path = scratch_path(spark, "ragged.csv")
    # The first line of each part brings the header, as writers of delimited files leave it.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    header = F.lit("o_orderkey,o_custkey,o_orderstatus\n")
    orders.select(F.when(first, F.concat(header, line)).otherwise(line).alias("value")).write.text(path)
    return path


LINES = "o_orderkey long, o_custkey long, o_orderstatus string"


@query(
    "S1c_read_ragged_csv",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN kind IN (1, 2) THEN 1 ELSE 0 END AS notes FROM ({RAGGED_SQL})
    """,
)
def s1c(spark, sf):
    lines = files.read_csv(spark, _ragged(spark, sf), newline_free=True)
    return lines.select("o_orderkey", F.size(REJECT).alias("notes"))


@query(
    "S2b_typed_load_of_ragged_csv",
    f"SELECT o_orderkey, o_custkey, o_orderstatus FROM ({RAGGED_SQL}) WHERE kind NOT IN (1, 2, 3)",
)
def s2b(spark, sf):
    schema = T.StructType.fromDDL(LINES)
    name, place = _declared(spark, schema)
    sinks.load_csv(spark, _ragged(spark, sf), name, newline_free=True)
    return _contents(spark, name, place)


@query(
    "S2c_rejects_of_ragged_csv",
    f"""
    SELECT o_orderkey, CASE kind
        WHEN 1 THEN 'line does not fit the table: ' || o_orderkey
        WHEN 2 THEN 'line does not fit the table: ' || concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'EXTRA')
        ELSE 'o_custkey: not a valid bigint' END AS reason
    FROM ({RAGGED_SQL}) WHERE kind IN (1, 2, 3)
    """,
)
def s2c(spark, sf):
    schema = T.StructType.fromDDL(LINES)
    name, _ = _declared(spark, schema)
    report = sinks.load_csv(spark, _ragged(spark, sf), name, newline_free=True)
    spark.sql(f"DROP TABLE {name}")
    return report.rejects.select("o_orderkey", F.explode(REJECT).alias("reason"))


@query("S3b_read_json_document", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s3b(spark, sf):
    # Documents of at most a thousand records each, one to a file.
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = scratch_path(spark, "customer.json")
    text = F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*customer.columns))), ",\n"), F.lit("]"))
    documents = customer.groupBy(F.expr("c_custkey DIV 1000").alias("document")).agg(text.alias("value"))
    documents.write.partitionBy("document").text(path)
    return accepted(files.read_json(spark, f"{path}/*", customer.schema))


@query(
    "S3c_read_broken_json",
    """
    SELECT CASE WHEN e.event_id % 5 = 1 THEN NULL ELSE e.event_id END AS event_id,
           CASE WHEN e.event_id % 5 IN (1, 2) THEN NULL ELSE e.user_id END AS user_id,
           CASE WHEN e.event_id % 5 IN (1, 2) THEN 1 ELSE 0 END AS notes
    FROM events e
    """,
)
def s3c(spark, sf):
    # Of five records, one is cut off and one holds a text where a number belongs.
    kind = F.col("event_id") % 5
    whole = F.to_json(F.struct("event_id", "user_id"))
    line = F.when(kind == 1, '{"event_id": ').when(kind == 2, F.to_json(F.struct("event_id", F.lit("bad").alias("user_id"))))
    path = scratch_path(spark, "broken.json")
    table(spark, sf, "events").select(line.otherwise(whole).alias("value")).write.text(path)
    records = files.read_json(spark, path, T.StructType.fromDDL("event_id long, user_id long"), lines=True)
    return records.select("event_id", "user_id", F.size(REJECT).alias("notes"))


def _loaded(spark, sf, times):
    """The supplier file loaded into a table that holds a third of it already."""
    supplier = table(spark, sf, "supplier")
    path = scratch_path(spark, "supplier.csv")
    sinks.write_csv(supplier, path)
    name, place = _declared(spark, supplier.schema)
    sinks.append_rows(supplier.where("s_suppkey % 3 = 0"), name)
    reports = [load_fresh(spark, path, ".csv", name, newline_free=True) for _ in range(times)]
    return reports, _contents(spark, name, place)


@query("S9d_load_fresh", "SELECT * FROM supplier")
def s9d(spark, sf):
    return _loaded(spark, sf, 1)[1]


@query(
    "S9e_load_fresh_twice",
    "SELECT count(*) AS rows, count(*) FILTER (s_suppkey % 3 <> 0) AS first_load, 0 AS second_load FROM supplier".replace(" 0 AS", " CAST(0 AS BIGINT) AS"),
)
def s9e(spark, sf):
    reports, rows = _loaded(spark, sf, 2)
    first, second = (F.lit(r.append.appended).cast("bigint") for r in reports)
    return rows.agg(F.count(F.lit(1)).alias("rows")).select("rows", first.alias("first_load"), second.alias("second_load"))


@query(
    "S9f_load_fresh_rejects",
    f"SELECT o_orderkey, kind FROM ({RAGGED_SQL}) WHERE kind IN (1, 2, 3)",
)
def s9f(spark, sf):
    name, _ = _declared(spark, T.StructType.fromDDL(LINES))
    report = load_fresh(spark, _ragged(spark, sf), ".csv", name, newline_free=True)
    spark.sql(f"DROP TABLE {name}")
    return report.unreadable.select("o_orderkey", (F.col("o_orderkey") % 7).alias("kind"))


@query("S4_S5_extract_table", "SELECT * FROM customer")
def s5(spark, sf):
    customer = table(spark, sf, "customer")
    name, place = _declared(spark, customer.schema)
    sinks.append_rows(customer, name)
    rows = tables.extract_table(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return rows


@query(
    "S6_bound_query",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000.5 AND o_orderpriority <> 'it''s' GROUP BY o_orderstatus",
)
def s6(spark, sf):
    view = f"scratch_{uuid.uuid4().hex}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    text = (
        f"SELECT o_orderstatus, count(*) AS n FROM {view} "
        "WHERE o_totalprice > :low AND o_orderpriority <> :odd GROUP BY o_orderstatus"
    )
    return tables.bound_query(spark, text, low=100000.5, odd="it's")


@query(
    "S7_write_ragged_csv",
    """
    SELECT CAST(c_acctbal AS VARCHAR) AS acctbal, CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment
    FROM customer UNION ALL SELECT NULL, CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier
    """,
)
def s7(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS acctbal", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    path = scratch_path(spark, "parties.csv")
    sinks.write_csv(align([supplier, customer]), path)
    return accepted(files.read_csv(spark, path))


@query("S8_write_json", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s8(spark, sf):
    events = table(spark, sf, "events")
    path = scratch_path(spark, "events.json")
    sinks.write_json(events, path)
    return accepted(files.read_json(spark, path, schema=events.schema, lines=True))


GOOD_LINES_SQL = f"""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, i AS number_text, b AS flag_text
    FROM (SELECT *, TRY_CAST(trunc(TRY_CAST(number_text AS DOUBLE)) AS BIGINT) AS i,
                 TRY_CAST(flag_text AS BOOLEAN) AS b FROM ({TEXTS_SQL}))
    WHERE i IS NOT NULL AND b IS NOT NULL
"""
KEY = ["l_orderkey", "l_linenumber"]


def _appended(spark, sf, key):
    typed = coerce(texts(spark, sf), LINE_TYPES)
    name, place = _declared(spark, typed.drop(REJECT).schema)
    # Without a key one pass over the file is enough; with one, the typed rows are stored and read again.
    report = sinks.append_rows(typed, name, key, stage=bool(key))
    return report, _contents(spark, name, place)


@query("S9_append_rows", GOOD_LINES_SQL)
def s9(spark, sf):
    return _appended(spark, sf, ())[1]


@query(
    "S9b_append_with_key",
    f"""
    SELECT * FROM ({GOOD_LINES_SQL}) WHERE (l_orderkey, l_linenumber) IN (
        SELECT l_orderkey, l_linenumber FROM ({GOOD_LINES_SQL}) GROUP BY ALL HAVING count(*) = 1)
    """,
)
def s9b(spark, sf):
    return _appended(spark, sf, KEY)[1]


@query(
    "S9c_append_counts",
    f"""
    SELECT (SELECT count(*) FROM lineitem) AS attempted, (SELECT count(*) FROM unique_lines) AS appended,
           (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM unique_lines) AS rejected
    FROM (SELECT 1)
    """.replace(
        "unique_lines",
        f"(SELECT l_orderkey, l_linenumber FROM ({GOOD_LINES_SQL}) GROUP BY ALL HAVING count(*) = 1)",
    ),
)
def s9c(spark, sf):
    report, _ = _appended(spark, sf, KEY)
    rejects = report.rejects.agg(F.count(F.lit(1)).alias("rejected"))
    return rejects.select(
        F.lit(report.attempted).cast("bigint").alias("attempted"),
        F.lit(report.appended).cast("bigint").alias("appended"),
        "rejected",
    )


@query("S11_repair_header", "SELECT p_partkey, p_name FROM part")
def s11(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return files.repair_header(part.toDF("﻿p_partkey", "p_name"))


@query("S14_run_statements", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def s14(spark, sf):
    view, grouped = f"scratch_{uuid.uuid4().hex}", f"scratch_{uuid.uuid4().hex}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    results = tables.run_statements(
        spark,
        [
            f"CREATE TEMPORARY VIEW {grouped} AS SELECT o_orderstatus, count(*) AS n FROM {view} GROUP BY o_orderstatus",
            f"SELECT * FROM {grouped}",
        ],
    )
    return results[-1]
