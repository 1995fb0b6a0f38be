"""Invariants, determinism, and recall on planted fraud."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from steward.functions import draws
from steward.operators import analytics
from steward.plans import generate, scenarios
from steward.sources.schemas import FINTECH, FINTECH_V1, REVIEWS, UUID_PATTERN


@pytest.fixture(scope="module")
def v1(spark):
    return {name: df.cache() for name, df in generate.fintech_v1(spark).items()}


def shape(df):
    return [(f.name, f.dataType) for f in df.schema.fields]


def test_schemas(spark, v1):
    for tables, specs in ((v1, FINTECH_V1), (generate.fintech(spark), FINTECH), (generate.reviews(spark), REVIEWS)):
        assert set(tables) == set(specs)
        for name, spec in specs.items():
            assert shape(tables[name]) == [(f.name, f.dataType) for f in spec.schema.fields], name


def test_v1_counts_and_keys(v1):
    users, accounts, tx = v1["users"], v1["accounts"], v1["transactions"]
    assert (users.count(), tx.count()) == (1000, 10_290)
    assert 1000 <= accounts.count() <= 3000
    per_user = accounts.groupBy("user_id").count()
    assert {r["count"] for r in per_user.collect()} == {1, 2, 3} and per_user.count() == 1000
    assert accounts.join(users, "user_id", "left_anti").isEmpty()
    ids = accounts.select("account_id")
    assert tx.join(ids, tx.src_account_id == ids.account_id, "left_anti").isEmpty()
    assert tx.where("dest_account_id IS NOT NULL").join(ids, tx.dest_account_id == ids.account_id, "left_anti").isEmpty()
    for df, key in ((users, "user_id"), (accounts, "account_id"), (tx, "tx_id")):
        assert df.select(key).distinct().count() == df.count()
        assert df.where(~F.col(key).rlike(UUID_PATTERN)).isEmpty()


@pytest.mark.parametrize("users", [1, 2, 3, 4, 5, 6, 7])
def test_account_numbers_have_no_gaps(spark, users):
    accounts = generate.accounts_v1(generate.row_numbers(spark, users), users)
    made = {r.account_id for r in accounts.collect()}
    numbers = spark.range(generate.account_total(users)).select(generate.account_id(0, F.col("id")).alias("a"))
    assert made == {r.a for r in numbers.collect()}
    tx = generate.transactions_v1(generate.row_numbers(spark, 300), users)
    assert tx.where("src_account_id = dest_account_id").isEmpty()


def test_v1_values(v1):
    tx = v1["transactions"]
    anchor = generate.ANCHOR
    assert tx.where("(tx_type = 'Internal') <> (dest_account_id IS NOT NULL)").isEmpty()
    assert {r.tx_type for r in tx.select("tx_type").distinct().collect()} == set(generate.TX_TYPES)
    low, high, first, last = tx.agg(F.min("amount"), F.max("amount"), F.min("timestamp"), F.max("timestamp")).first()
    assert 1 <= low and high <= 5000
    assert anchor - timedelta(days=365) <= first and last <= anchor + timedelta(seconds=10)
    users = v1["users"]
    assert {r.kyc_status for r in users.select("kyc_status").distinct().collect()} == set(generate.KYC)
    assert users.where(F.length("country") != 2).isEmpty()
    assert users.agg(F.min("created_at")).first()[0] >= anchor - timedelta(days=730)


def test_sources_are_uniform_over_accounts(v1):
    per_user = v1["accounts"].groupBy("user_id").agg(F.count("*").alias("n"))
    owners = v1["accounts"].join(per_user, "user_id").select("account_id", "n")
    tx = v1["transactions"].join(owners, F.col("src_account_id") == F.col("account_id")).groupBy("n").count()
    accounts = {r.n: r["count"] for r in owners.groupBy("n").count().collect()}
    for row in tx.collect():
        assert abs(row["count"] / accounts[row.n] - 10_290 / sum(accounts.values())) < 0.5


def test_planted_fraud_is_found(spark):
    bursts = generate.rapid_fire_v1(generate.row_numbers(spark, 50), 1000)
    pairs = generate.double_spend_v1(generate.row_numbers(spark, 20), 1000)
    tx = generate.transactions_v1(generate.row_numbers(spark, 10_000), 1000).unionByName(bursts).unionByName(pairs)
    found = analytics.rapid_fire_in_frame(tx, "src_account_id", "timestamp", 10)
    missed = bursts.select("src_account_id").distinct().join(found, "src_account_id", "left_anti")
    assert bursts.count() == 250 and missed.isEmpty()
    same = ["src_account_id", "dest_account_id", "amount"]
    repeated = analytics.double_spend(tx, same, "timestamp", "tx_id")
    assert repeated.join(pairs.select("tx_id"), "tx_id", "left_semi").count() == 20
    gaps = repeated.agg(F.max("gap_micros")).first()[0]
    assert gaps <= 490_000


def test_same_rows_for_any_partitioning(spark):
    rows = generate.row_numbers(spark, 500)
    for make in (
        generate.users_v1,
        lambda r: generate.accounts_v1(r, 500),
        lambda r: generate.transactions_v1(r, 500),
        lambda r: generate.rapid_fire_v1(r, 500),
        generate.review_table,
    ):
        one, many = make(rows.coalesce(1)), make(rows.repartition(7))
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    assert not generate.users_v1(rows, seed=1).exceptAll(generate.users_v1(rows, seed=0)).isEmpty()


def test_compact_fintech(spark):
    tables = generate.fintech(spark, rows=2000)
    assert {n: df.count() for n, df in tables.items()} == {"users": 1000, "accounts": 1500, "transactions": 2000}
    assert tables["accounts"].join(tables["users"], "user_id", "left_anti").isEmpty()
    ids = tables["accounts"].select(F.col("account_id").alias("src_id"))
    assert tables["transactions"].join(ids, "src_id", "left_anti").isEmpty()


def test_reviews(spark):
    df = generate.reviews(spark, rows=5000)["reviews"]
    assert {r.category for r in df.select("category").distinct().collect()} == set(generate.CATEGORIES)
    low, high = df.agg(F.min("sentiment_score"), F.max("sentiment_score")).first()
    assert (float(low), float(high)) == (-1.0, 1.0)
    words = {r.n for r in df.select(F.size(F.split("text", " ")).alias("n")).distinct().collect()}
    assert words == set(range(6, 15))
    assert df.where(~F.col("text").rlike(r"^[A-Z][a-z ]*\.$")).isEmpty()
    # The label does not depend on the score.
    shares = df.groupBy("sentiment_label").agg(F.avg("sentiment_score").alias("m"), F.count("*").alias("n")).collect()
    assert len(shares) == 3 and all(abs(float(r.m)) < 0.08 and r.n > 1500 for r in shares)


def test_draws(spark):
    df = spark.range(2000).select(
        draws.draw("s", F.col("id")).alias("d"), draws.below(7, "s", F.col("id")).alias("b"), draws.money("1", "2", "s", F.col("id")).alias("m")
    )
    low, high = df.agg(F.min("d"), F.max("d")).first()
    assert 0 <= low and high < 2**60
    assert {r.b for r in df.select("b").distinct().collect()} == set(range(7))
    assert df.where("m < 1 OR m > 2").isEmpty()


def test_registry():
    assert set(scenarios.SCENARIOS) == {"fintech", "fintech_v1", "nlp"}
    with pytest.raises(ValueError, match="unknown scenario"):
        scenarios.scenario("weather")


@pytest.mark.parametrize("name", list(scenarios.SCENARIOS))
def test_run_scenario(spark, tmp_path, name):
    namespace = f"ns_{name}_{datetime.now().strftime('%H%M%S%f')}"
    run = scenarios.run_scenario(spark, name, str(tmp_path), namespace, rows=400)
    assert all(load.rejected == 0 for load in run.loads.values())
    generated = scenarios.scenario(name).generate(spark, rows=400)
    for table, df in generated.items():
        assert df.exceptAll(run.tables[table]).isEmpty(), table
        assert df.count() == run.tables[table].count() == run.loads[table].appended
    for report in run.reports.values():
        report.collect()
    if scenarios.SCENARIOS[name].tables.get("users") and scenarios.SCENARIOS[name].tables["users"].key:
        with pytest.raises(Exception, match="already stored"):
            scenarios.run_scenario(spark, name, str(tmp_path), namespace, rows=400)
    spark.sql(f"DROP DATABASE {namespace} CASCADE")
