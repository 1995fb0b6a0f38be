"""Synthetic tables keyed by the rows of the driver's tables.

Each customer is a user, each order and document a transaction and a review, each supplier a planted burst and pair, and
each part an account of the compact scenario. The oracle draws the same numbers from the same md5 digests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.registry import query, table
from steward.operators import analytics
from steward.plans import generate, scenarios
from steward.session import scratch_path, stored
from steward.plans.generate import (
    ACCOUNT_CODES,
    ACCOUNT_TYPES,
    CATEGORIES,
    COUNTRIES,
    CURRENCIES,
    KYC,
    KYC_CODES,
    SENTIMENTS,
    SHARES,
    TX_TYPES,
    WORDS,
)

# --- the draws in SQL -------------------------------------------------------------------------------------------------


def _md5(name: str, *parts: str) -> str:
    joined = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5('0:{name}|' || {joined})"


def _draw(bound: int | str, name: str, *parts: str) -> str:
    return f"(CAST('0x' || substr({_md5(name, *parts)}, 1, 15) AS BIGINT) % {bound})"


def _pick(values: list[str], name: str, *parts: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[1 + {_draw(len(values), name, *parts)}]"


def _uuid(name: str, *parts: str) -> str:
    h = _md5(name, *parts)
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-4' || substr({h}, 14, 3) || '-a' || substr({h}, 18, 3) "
        f"|| '-' || substr({h}, 21, 12)"
    )


def _cents(low: int, high: int, name: str, *parts: str) -> str:
    return f"CAST(CAST({_draw(high - low + 1, name, *parts)} + {low} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def _before(days: int, name: str, *parts: str) -> str:
    return f"TIMESTAMP '2025-01-01' - to_seconds({_draw(days * 86400, name, *parts)})"


N_USERS = "(SELECT count(*) FROM customer)"


def _account(name: str, *parts: str) -> str:
    return _uuid("account", _draw(f"(2 * {N_USERS})", name, *parts))


def _rows(spark, sf, name, key):
    return table(spark, sf, name).select(F.col(key).cast("bigint").alias("row"))


def _users(spark, sf):
    return table(spark, sf, "customer").count()


USERS = "(SELECT c_custkey AS n FROM customer)"

G1 = f"""
    SELECT {_uuid('user', 'n')} AS user_id, {_pick(KYC, 'kyc', 'n')} AS kyc_status,
           {_pick(COUNTRIES, 'country', 'n')} AS country, {_before(730, 'created', 'n')} AS created_at
    FROM {USERS}
"""
G2 = f"""
    SELECT {_uuid('account', 'a')} AS account_id, {_uuid('user', 'n')} AS user_id,
           {_pick(ACCOUNT_TYPES, 'type', 'a')} AS account_type, {_pick(CURRENCIES, 'currency', 'a')} AS currency
    FROM (SELECT n, (n // 3) * 6 + list_sum(s[1:n % 3]) + unnest(range(s[1 + n % 3])) AS a
          FROM (SELECT n, CASE WHEN n // 3 < {N_USERS} // 3
                          THEN ({SHARES})[1 + {_draw(6, 'shares', '(n // 3)')}] ELSE [2, 2, 2] END AS s FROM {USERS}))
""".replace("list_sum(s[1:n % 3])", "CAST(coalesce(list_sum(s[1:n % 3]), 0) AS BIGINT)")
_other = "(other + CASE WHEN other >= src THEN 1 ELSE 0 END)"
G3 = f"""
    SELECT {_uuid('tx', 'n')} AS tx_id, {_uuid('account', 'src')} AS src_account_id,
           CASE WHEN tx_type = 'Internal' THEN {_uuid('account', _other)} END AS dest_account_id,
           {_cents(100, 500000, 'amount', 'n')} AS amount, tx_type, {_before(365, 'time', 'n')} AS timestamp
    FROM (SELECT o_orderkey AS n, {_pick(TX_TYPES, 'txtype', 'o_orderkey')} AS tx_type,
                 {_draw(f'(2 * {N_USERS})', 'src', 'o_orderkey')} AS src,
                 {_draw(f'(2 * {N_USERS} - 1)', 'dest', 'o_orderkey')} AS other FROM orders)
"""
G4 = f"""
    SELECT {_uuid('bursttx', 'n', 'step')} AS tx_id, {_account('burstsrc', 'n')} AS src_account_id,
           {_account('burstdest', 'n', 'step')} AS dest_account_id,
           {_cents(1000, 10000, 'burstamount', 'n', 'step')} AS amount,
           'Internal' AS tx_type, {_before(365, 'bursttime', 'n')} + to_seconds(2 * step) AS timestamp
    FROM (SELECT s_suppkey AS n, unnest(range(5)) AS step FROM supplier)
"""
G5 = f"""
    SELECT {_uuid('pairtx', 'n', 'step')} AS tx_id, {_account('pairsrc', 'n')} AS src_account_id,
           {_account('pairdest', 'n')} AS dest_account_id, {_cents(50000, 100000, 'pairamount', 'n')} AS amount,
           'Internal' AS tx_type,
           {_before(365, 'pairtime', 'n')} + to_milliseconds({_draw(491, 'pairdelay', 'n', 'step')} + 10) AS timestamp
    FROM (SELECT s_suppkey AS n, unnest(range(2)) AS step FROM supplier)
"""


@query("G1_users", G1)
def g1(spark, sf):
    return generate.users_v1(_rows(spark, sf, "customer", "c_custkey"))


@query("G2_accounts", G2)
def g2(spark, sf):
    return generate.accounts_v1(_rows(spark, sf, "customer", "c_custkey"), _users(spark, sf))


@query("G3_transactions", G3)
def g3(spark, sf):
    return generate.transactions_v1(_rows(spark, sf, "orders", "o_orderkey"), _users(spark, sf))


@query("G4_rapid_fire", G4)
def g4(spark, sf):
    return generate.rapid_fire_v1(_rows(spark, sf, "supplier", "s_suppkey"), _users(spark, sf))


@query("G5_double_spend", G5)
def g5(spark, sf):
    return generate.double_spend_v1(_rows(spark, sf, "supplier", "s_suppkey"), _users(spark, sf))


@query(
    "G6_compact_users",
    f"""
    SELECT {_uuid('user', 'n')} AS user_id, {_pick(KYC_CODES, 'kyc', 'n')} AS kyc,
           {_pick(COUNTRIES, 'country', 'n')} AS country FROM {USERS}
    """,
)
def g6_users(spark, sf):
    return generate.users_v2(_rows(spark, sf, "customer", "c_custkey"))


@query(
    "G6b_compact_accounts",
    f"""
    SELECT {_uuid('account', 'p_partkey')} AS account_id,
           {_uuid('user', _draw(N_USERS, 'owner', 'p_partkey'))} AS user_id,
           {_pick(ACCOUNT_CODES, 'type', 'p_partkey')} AS type FROM part
    """,
)
def g6_accounts(spark, sf):
    return generate.accounts_v2(_rows(spark, sf, "part", "p_partkey"), _users(spark, sf))


@query(
    "G6c_compact_transactions",
    f"""
    SELECT {_uuid('tx', 'o_orderkey')} AS tx_id,
           {_uuid('account', _draw('(SELECT count(*) FROM part)', 'src', 'o_orderkey'))} AS src_id,
           {_cents(100, 500000, 'amount', 'o_orderkey')} AS amount, {_before(365, 'time', 'o_orderkey')} AS ts
    FROM orders
    """,
)
def g6_transactions(spark, sf):
    return generate.transactions_v2(_rows(spark, sf, "orders", "o_orderkey"), table(spark, sf, "part").count())


@query(
    "G7_reviews",
    f"""
    SELECT {_uuid('review', 'n')} AS review_id, {_pick(CATEGORIES, 'category', 'n')} AS category,
           upper(sentence[1]) || substr(sentence, 2) || '.' AS text,
           CAST(CAST({_draw(201, 'score', 'n')} - 100 AS DECIMAL(5,0)) * 0.01 AS DECIMAL(5,2)) AS sentiment_score,
           {_pick(SENTIMENTS, 'sentiment', 'n')} AS sentiment_label
    FROM (SELECT n, string_agg({_pick(WORDS, 'word', 'n', 'i')}, ' ' ORDER BY i) AS sentence
          FROM (SELECT doc_id AS n, unnest(range(1, {_draw(9, 'length', 'doc_id')} + 7)) AS i FROM documents) GROUP BY n)
    """,
)
def g7(spark, sf):
    return generate.review_table(_rows(spark, sf, "documents", "doc_id"))


@query(
    "G8_scenario_counts",
    f"""
    SELECT 'Users count:' AS label, count(*) AS n FROM customer
    UNION ALL SELECT 'Accounts count:', 2 * count(*) FROM customer
    UNION ALL SELECT 'Transactions count:', (SELECT count(*) FROM orders) + 5 * count(*) + 2 * count(*) FROM supplier
    """,
)
def g8(spark, sf):
    suppliers = table(spark, sf, "supplier").count()
    chosen = scenarios.scenario("fintech_v1")
    tables = chosen.generate(
        spark,
        rows=table(spark, sf, "orders").count(),
        users=_users(spark, sf),
        bursts=suppliers,
        pairs=suppliers,
    )
    return chosen.reports["row_counts"](tables)


@query(
    "G8b_scenario_run",
    f"""
    SELECT 'Users count:' AS label, count(*) AS n FROM customer
    UNION ALL SELECT 'Accounts count:', 2 * count(*) FROM customer
    UNION ALL SELECT 'Transactions count:', (SELECT count(*) FROM orders) + 5 * count(*) + 2 * count(*) FROM supplier
    """,
)
def g8b(spark, sf):
    # The whole way: generated, written as files, loaded into tables with their keys checked, and reported.
    suppliers = table(spark, sf, "supplier").count()
    namespace = f"scratch_{uuid.uuid4().hex}"
    run = scenarios.run_scenario(
        spark,
        "fintech_v1",
        scratch_path(spark, "scenario"),
        namespace,
        rows=table(spark, sf, "orders").count(),
        users=_users(spark, sf),
        bursts=suppliers,
        pairs=suppliers,
    )
    report = stored(run.reports["row_counts"], "report")
    spark.sql(f"DROP DATABASE {namespace} CASCADE")
    return report


@query(
    "Q6b_double_spend_in_generated",
    f"""
    SELECT tx_id, previous_id, gap_micros FROM (
        SELECT tx_id, lag(tx_id) OVER w AS previous_id,
               date_diff('microsecond', lag(timestamp) OVER w, timestamp) AS gap_micros
        FROM ({G3} UNION ALL {G4} UNION ALL {G5})
        WINDOW w AS (PARTITION BY src_account_id, dest_account_id, amount ORDER BY timestamp, tx_id))
    WHERE gap_micros <= 500000
    """,
)
def q6b(spark, sf):
    tx = _all_transactions(spark, sf)
    found = analytics.double_spend(tx, ["src_account_id", "dest_account_id", "amount"], "timestamp", "tx_id", 0.5)
    return found.select("tx_id", "previous_id", "gap_micros")


@query(
    "Q5b_rapid_fire_in_generated",
    f"""
    SELECT tx_id, tx_count FROM (
        SELECT tx_id, count(*) OVER (PARTITION BY src_account_id ORDER BY timestamp
                                     RANGE BETWEEN INTERVAL 10 SECONDS PRECEDING AND CURRENT ROW) AS tx_count
        FROM ({G3} UNION ALL {G4} UNION ALL {G5}))
    WHERE tx_count > 3
    """,
)
def q5b(spark, sf):
    tx = _all_transactions(spark, sf)
    return analytics.rapid_fire_in_frame(tx, "src_account_id", "timestamp", 10, 3).select("tx_id", "tx_count")


@query(
    "Q2c_rapid_fire_by_minute_in_generated",
    f"""
    SELECT src_account_id, date_trunc('minute', timestamp) AS bucket, count(*) AS tx_count
    FROM ({G3} UNION ALL {G4} UNION ALL {G5})
    GROUP BY src_account_id, date_trunc('minute', timestamp) HAVING count(*) > 3
    """,
)
def q2c(spark, sf):
    return analytics.rapid_fire_by_bucket(_all_transactions(spark, sf), "src_account_id", "timestamp", "minute", 3)


def _all_transactions(spark, sf):
    return g3(spark, sf).unionByName(g4(spark, sf)).unionByName(g5(spark, sf))
