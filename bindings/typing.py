"""Typing of texts that are derived from every row of ``lineitem``, ``events``, ``nation`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.functions import casting, normalize
from steward.operators import coerce

# A numeric text per line item, in every form that the casts tell apart. The text is the same in both dialects.
NUMBER_TEXT = """
    CASE l_linenumber
        WHEN 1 THEN concat(l_partkey, '.', CAST(l_quantity AS INT))
        WHEN 2 THEN concat('-', l_partkey, '.', CAST(l_quantity AS INT))
        WHEN 3 THEN concat(' ', l_partkey, ' ')
        WHEN 4 THEN concat(l_partkey, 'e3')
        WHEN 5 THEN concat(l_partkey, '_000')
        WHEN 6 THEN CASE l_suppkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' WHEN 2 THEN 'abc' WHEN 3 THEN ''
                                       ELSE concat(l_partkey, 'd') END
        ELSE concat('9007199254740', 100 + l_partkey % 900) END
"""
FLAG_TEXT = """
    CASE l_linenumber WHEN 1 THEN 't' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'f' WHEN 4 THEN 'FALSE' WHEN 5 THEN 'yes'
                      WHEN 6 THEN l_returnflag ELSE '' END
"""
# A time stamp text per event, with and without fraction and offset.
TIME_TEXT_SPARK = """
    CASE event_id % 5
        WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') || '+00'
        WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') || '+00'
        WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') || '+00'
        WHEN 3 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')
        ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') || '-04' END
"""
TIME_RESULT_SQL = """
    CASE event_id % 5
        WHEN 1 THEN strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f')
        WHEN 2 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f')
        WHEN 4 THEN strftime(ts + INTERVAL 4 HOURS, '%Y-%m-%d %H:%M:%S.%f')
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END || '+00'
"""
TEXTS_SQL = f"SELECT l_orderkey, l_linenumber, {NUMBER_TEXT} AS number_text, {FLAG_TEXT} AS flag_text FROM lineitem"


def texts(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(NUMBER_TEXT).alias("number_text"), F.expr(FLAG_TEXT).alias("flag_text")
    )


@query(
    "C1_cast_integer",
    f"""
    SELECT number_text, count(*) AS n, max(TRY_CAST(trunc(TRY_CAST(number_text AS DOUBLE)) AS BIGINT)) AS as_integer
    FROM ({TEXTS_SQL}) GROUP BY number_text
    """,
)
def c1(spark, sf):
    return (
        texts(spark, sf)
        .withColumn("as_integer", casting.as_integer(F.col("number_text")))
        .groupBy("number_text")
        .agg(F.count(F.lit(1)).alias("n"), F.max("as_integer").alias("as_integer"))
    )


@query(
    "C2_cast_float",
    f"""
    SELECT l_orderkey, number_text, CASE WHEN isfinite(f) THEN f END AS finite,
           CASE WHEN isnan(f) THEN 'nan' WHEN isinf(f) THEN 'inf' END AS special
    FROM (SELECT *, TRY_CAST(number_text AS DOUBLE) AS f FROM ({TEXTS_SQL}))
    """,
)
def c2(spark, sf):
    f, infinite = F.col("f"), F.abs(F.col("f")) == float("inf")
    return (
        texts(spark, sf)
        .withColumn("f", casting.as_float(F.col("number_text")))
        .select(
            "l_orderkey",
            "number_text",
            F.when(~F.isnan(f) & ~infinite, f).alias("finite"),
            F.when(F.isnan(f), "nan").when(infinite, "inf").alias("special"),
        )
    )


@query(
    "C3_cast_text",
    "SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, CAST(l_linenumber AS VARCHAR) AS linenumber, l_returnflag FROM lineitem",
)
def c3(spark, sf):
    return table(spark, sf, "lineitem").select(
        casting.cast_as(F.col("l_orderkey"), "str").alias("orderkey"),
        casting.cast_as(F.col("l_linenumber"), "character varying").alias("linenumber"),
        casting.cast_as(F.col("l_returnflag"), "text").alias("l_returnflag"),
    )


@query(
    "C4_cast_boolean",
    f"""
    SELECT flag_text, TRY_CAST(flag_text AS BOOLEAN) AS token, length(flag_text) > 0 AS truthy, count(*) AS n
    FROM ({TEXTS_SQL}) GROUP BY flag_text
    """,
)
def c4(spark, sf):
    flag = F.col("flag_text")
    return (
        texts(spark, sf)
        .groupBy(
            flag,
            casting.as_boolean(flag).alias("token"),
            casting.as_boolean(flag, mode="truthy").alias("truthy"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "C5_cast_collections",
    """
    SELECT o_orderkey, array_to_string(string_split(o_orderpriority, ''), '|') AS letters,
           o_orderstatus AS status_entry, o_orderpriority AS priority_entry, o_orderdate AS day
    FROM orders
    """,
)
def c5(spark, sf):
    # The first pair repeats a key; the last pair with that key counts.
    pair = "struct('{0}' AS k, {1} AS v)"
    pairs = F.expr(
        f"array({pair.format('status', 'o_orderpriority')}, {pair.format('priority', 'o_orderpriority')}, "
        f"{pair.format('status', 'o_orderstatus')})"
    )
    return (
        table(spark, sf, "orders")
        .withColumn("entries", casting.cast_as(pairs, "dict"))
        .select(
            "o_orderkey",
            F.array_join(casting.cast_as(F.col("o_orderpriority"), "list"), "|").alias("letters"),
            F.col("entries")["status"].alias("status_entry"),
            F.col("entries")["priority"].alias("priority_entry"),
            casting.cast_as(F.col("o_orderdate"), "datetime").alias("day"),
        )
    )


REJECTS_SQL = f"""
    SELECT concat_ws('; ', CASE WHEN i IS NULL THEN 'number_text: not a valid integer' END,
                           CASE WHEN b IS NULL THEN 'flag_text: not a valid boolean' END) AS reasons, count(*) AS n
    FROM (SELECT *, TRY_CAST(trunc(TRY_CAST(number_text AS DOUBLE)) AS BIGINT) AS i,
                 TRY_CAST(flag_text AS BOOLEAN) AS b FROM ({TEXTS_SQL}))
    GROUP BY reasons
"""
LINE_TYPES = {"l_orderkey": "int", "l_linenumber": "int", "number_text": "integer", "flag_text": "boolean"}


@query("C6_reject_reasons", REJECTS_SQL)
def c6(spark, sf):
    typed = coerce.coerce(texts(spark, sf), LINE_TYPES)
    return typed.groupBy(F.array_join(coerce.REJECT, "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "C7_normalize_flags",
    f"""
    SELECT nullif(flag_text, '') AS text, CASE WHEN flag_text IN ('t', 'TRUE') THEN true
           WHEN flag_text IN ('f', 'FALSE') THEN false END AS flag, count(*) AS n
    FROM ({TEXTS_SQL}) GROUP BY flag_text
    """,
)
def c7(spark, sf):
    flag = F.col("flag_text")
    grouped = texts(spark, sf).groupBy(
        normalize.empty_to_null(flag).alias("text"), normalize.flag_to_boolean(flag).alias("flag")
    )
    return grouped.agg(F.count(F.lit(1)).alias("n"))


@query("C8_canonical_time_text", f"SELECT event_id, {TIME_RESULT_SQL} AS canonical FROM events")
def c8(spark, sf):
    given = table(spark, sf, "events").select("event_id", F.expr(TIME_TEXT_SPARK).alias("given"))
    return given.select("event_id", normalize.canonical_time_text(F.col("given")).alias("canonical"))


@query("C9_time_to_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events")
def c9(spark, sf):
    return table(spark, sf, "events").select("event_id", normalize.time_text(F.col("ts"), zone=False).alias("ts_text"))


@query(
    "C10_coerce_through_database_types",
    """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice, o_orderstatus, o_orderpriority = '1-URGENT' AS urgent
    FROM orders
    """,
)
def c10(spark, sf):
    # What the stored table says about itself (C12) types the file, which holds texts only.
    stored = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", (F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    )
    database = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    learned = coerce.declared_types(stored)
    lookup = {database[c]: learned[c] for c in database}
    file = stored.select(*[F.col(c).cast("string").alias(c) for c in stored.columns])
    return coerce.coerce_through(file, database, lookup).drop(coerce.REJECT)


@query(
    "C11_coerce_rows",
    f"""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           TRY_CAST(trunc(TRY_CAST(number_text AS DOUBLE)) AS BIGINT) AS number_text,
           TRY_CAST(flag_text AS BOOLEAN) AS flag_text
    FROM ({TEXTS_SQL})
    """,
)
def c11(spark, sf):
    return coerce.coerce(texts(spark, sf), LINE_TYPES).drop(coerce.REJECT)


@query(
    "C4b_truth_of_typed_values",
    """
    SELECT event_id, user_id % 3 <> 0 AS number, value > 50 AS flag, event_type <> 'view' AS word FROM events
    """,
)
def c4b(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        (F.col("user_id") % 3).alias("number"),
        (F.col("value") > 50).alias("flag"),
        F.when(F.col("event_type") == "view", "").otherwise("false").alias("word"),
    )
    kinds = {f.name: f.dataType for f in events.schema}
    truths = [casting.as_boolean(F.col(c), mode="truthy", held=kinds[c]).alias(c) for c in ("number", "flag", "word")]
    return events.select("event_id", *truths)


@query(
    "C5b_collections_stay",
    "SELECT event_id, CAST(user_id AS VARCHAR) || '|' || event_type AS items, event_type AS entry FROM events",
)
def c5b(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.array(F.col("user_id").cast("string"), "event_type").alias("items"),
        F.create_map(F.lit("kind"), F.col("event_type")).alias("entries"),
    )
    typed = coerce.coerce(events, {"event_id": "int", "items": "list", "entries": "dict"})
    return typed.select("event_id", F.array_join("items", "|").alias("items"), F.col("entries")["kind"].alias("entry"))


@query(
    "C12_coerce_by_learned_types",
    """
    SELECT event_id, ts, value, CASE WHEN value > 50 THEN true ELSE false END AS high, event_type AS first,
           CAST(user_id AS BIGINT) AS user_entry, 0 AS notes FROM events
    """,
)
def c12(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "ts", "value", (F.col("value") > 50).alias("high"), F.array("event_type").alias("items"),
        F.create_map(F.lit("user"), F.col("user_id")).alias("entries"),
    )
    typed = coerce.coerce(events, coerce.declared_types(events))
    return typed.select(
        "event_id", "ts", "value", "high", F.col("items")[0].alias("first"), F.col("entries")["user"].alias("user_entry"),
        F.size("_reject").alias("notes"),
    )
