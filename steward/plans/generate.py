"""Reproducible synthetic fintech and review data.

Each table is a projection of a frame of row numbers: a row's values are draws keyed by its number, so the data is the
same for any partitioning, cluster or retry, needs no shuffle, and scales with the number of rows asked for. A foreign
key is the identifier worked out from a drawn row number, so no table is joined to make another.

Times lie before an ``anchor``, which is an argument and never the current time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steward.functions import draws

# The code lists of the scenarios.
KYC = ["verified", "pending", "failed"]
ACCOUNT_TYPES = ["checking", "savings", "investment"]
CURRENCIES = ["USD", "EUR", "GBP", "JPY"]
TX_TYPES = ["Internal", "Deposit", "Withdrawal"]
KYC_CODES = ["V", "P"]
ACCOUNT_CODES = ["C", "S"]
CATEGORIES = ["Electronics", "Home Decor", "Clothing", "Books", "Software"]
SENTIMENTS = ["positive", "neutral", "negative"]

#: Country codes to draw from unless the caller gives others.
COUNTRIES = (
    "AR AT AU BE BG BR CA CH CL CN CO CY CZ DE DK EE EG ES FI FR GB GR HR HU ID IE IL IN IS IT JP KE KR LT LU LV MA MT MX "
    "MY NG NL NO NZ PE PH PK PL PT RO RS SA SE SG SI SK TH TR TW UA US UY VN ZA"
).split()
#: Words that review texts are made of unless the caller gives others.
WORDS = (
    "able about after again air always answer arrive back best better bring build buy call change clear close cold "
    "color come cover day deliver early easy end expect fast feel fit fix give good hand hard help high hold home "
    "keep kind large last learn light long look love make money move need never nice number offer old open order "
    "part pay place price quick quiet read return safe same screen sell send service short simple small soft start "
    "strong take team time try use value wait want week work worth write year"
).split()

ANCHOR = datetime(2025, 1, 1)
YEAR = 365 * 24 * 3600
# Every order in which three neighbouring users can have one, two and three accounts.
SHARES = [[1, 2, 3], [1, 3, 2], [2, 1, 3], [2, 3, 1], [3, 1, 2], [3, 2, 1]]


#: Rows that one task makes, so that a written part stays below about 1 GB.
ROWS_PER_TASK = 4_000_000


def row_numbers(spark: SparkSession, n: int) -> DataFrame:
    """``n`` rows numbered from 0 in the column ``row``, spread over the cluster."""
    tasks = max(1, min(n, spark.sparkContext.defaultParallelism), -(-n // ROWS_PER_TASK))
    return spark.range(0, n, 1, tasks).select(F.col("id").alias("row"))


def _anchor(anchor: datetime) -> Column:
    return F.lit(anchor.isoformat(sep=" ")).cast("timestamp_ntz")


def _salt(seed: int, name: str) -> str:
    return f"{seed}:{name}"


def user_id(seed: int, user: Column) -> Column:
    return draws.uuid_text(_salt(seed, "user"), user)


def account_id(seed: int, account: Column) -> Column:
    return draws.uuid_text(_salt(seed, "account"), account)


def account_total(users: int) -> int:
    """How many accounts ``users`` users have together."""
    return 2 * users


def users_v1(
    rows: DataFrame, seed: int = 0, anchor: datetime = ANCHOR, countries: Sequence[str] = COUNTRIES
) -> DataFrame:
    """Users with a status, a country and a creation time in the last two years (G1)."""
    n = F.col("row")
    return rows.select(
        user_id(seed, n).alias("user_id"),
        draws.choice(KYC, _salt(seed, "kyc"), n).alias("kyc_status"),
        draws.choice(countries, _salt(seed, "country"), n).alias("country"),
        draws.seconds_before(_anchor(anchor), 2 * YEAR, _salt(seed, "created"), n).alias("created_at"),
    )


def accounts_v1(user_rows: DataFrame, users: int, seed: int = 0) -> DataFrame:
    """One to three accounts for each user row (G2), ``users`` being the number of all users.

    Three neighbouring users share six accounts, one, two and three in a drawn order; those left over at the end have
    two each. So the accounts are numbered without gaps, from the user's number alone, and a draw of an account number
    is uniform over accounts.
    """
    user, account = F.col("row"), F.col("account")
    trio, place = F.expr("row div 3"), user % 3
    shares = F.array(*[F.array(*[F.lit(n) for n in share]) for share in SHARES])
    drawn = F.element_at(shares, (draws.below(len(SHARES), _salt(seed, "shares"), trio) + 1).cast("int"))
    share = F.when(trio < users // 3, F.col("_drawn")).otherwise(F.array(F.lit(2), F.lit(2), F.lit(2)))
    before = F.when(place > 0, share[0]).otherwise(0) + F.when(place > 1, share[1]).otherwise(0)
    first = trio * 6 + before
    return (
        user_rows.select("row", drawn.alias("_drawn"))
        .select("row", first.alias("_first"), share[place.cast("int")].alias("_n"))
        .select("row", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("account"))
        .select(
            account_id(seed, account).alias("account_id"),
            user_id(seed, user).alias("user_id"),
            draws.choice(ACCOUNT_TYPES, _salt(seed, "type"), account).alias("account_type"),
            draws.choice(CURRENCIES, _salt(seed, "currency"), account).alias("currency"),
        )
    )


def _account(seed: int, name: str, users: int, *parts: Column) -> Column:
    """The number of an account, uniform over all accounts."""
    return draws.below(account_total(users), _salt(seed, name), *parts)


def _other_account(seed: int, name: str, users: int, taken: Column, *parts: Column) -> Column:
    """The number of an account other than ``taken``: one of the rest is drawn, and those from ``taken`` on move up."""
    drawn = draws.below(account_total(users) - 1, _salt(seed, name), *parts)
    return drawn + F.when(drawn >= taken, 1).otherwise(0)


def transactions_v1(rows: DataFrame, users: int, seed: int = 0, anchor: datetime = ANCHOR) -> DataFrame:
    """Ordinary transactions of the last year (G3). Only internal ones have a destination, another account."""
    n = F.col("row")
    numbered = rows.select("row", _account(seed, "src", users, n).alias("_src"))
    named = numbered.select(
        draws.uuid_text(_salt(seed, "tx"), n).alias("tx_id"),
        account_id(seed, F.col("_src")).alias("src_account_id"),
        account_id(seed, _other_account(seed, "dest", users, F.col("_src"), n)).alias("_other_id"),
        draws.money("1", "5000", _salt(seed, "amount"), n).alias("amount"),
        draws.choice(TX_TYPES, _salt(seed, "txtype"), n).alias("tx_type"),
        draws.seconds_before(_anchor(anchor), YEAR, _salt(seed, "time"), n).alias("timestamp"),
    )
    destination = F.when(F.col("tx_type") == "Internal", F.col("_other_id")).alias("dest_account_id")
    return named.select("tx_id", "src_account_id", destination, "amount", "tx_type", "timestamp")


def rapid_fire_v1(bursts: DataFrame, users: int, seed: int = 0, anchor: datetime = ANCHOR) -> DataFrame:
    """Planted bursts: for each row five internal transactions of one source, two seconds apart."""
    n, step = F.col("row"), F.col("step")
    base = draws.seconds_before(_anchor(anchor), YEAR, _salt(seed, "bursttime"), n)
    return bursts.select("row", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("step")).select(
        draws.uuid_text(_salt(seed, "bursttx"), n, step).alias("tx_id"),
        account_id(seed, _account(seed, "burstsrc", users, n)).alias("src_account_id"),
        account_id(seed, _account(seed, "burstdest", users, n, step)).alias("dest_account_id"),
        draws.money("10", "100", _salt(seed, "burstamount"), n, step).alias("amount"),
        F.lit("Internal").alias("tx_type"),
        (base + F.make_dt_interval(secs=(step * 2).cast("decimal(18,6)"))).alias("timestamp"),
    )


def double_spend_v1(pairs: DataFrame, users: int, seed: int = 0, anchor: datetime = ANCHOR) -> DataFrame:
    """Planted pairs: for each row two equal transactions, each 10 to 500 ms after one base time."""
    n, step = F.col("row"), F.col("step")
    base = draws.seconds_before(_anchor(anchor), YEAR, _salt(seed, "pairtime"), n)
    millis = draws.below(491, _salt(seed, "pairdelay"), n, step) + 10
    return pairs.select("row", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("step")).select(
        draws.uuid_text(_salt(seed, "pairtx"), n, step).alias("tx_id"),
        account_id(seed, _account(seed, "pairsrc", users, n)).alias("src_account_id"),
        account_id(seed, _account(seed, "pairdest", users, n)).alias("dest_account_id"),
        draws.money("500", "1000", _salt(seed, "pairamount"), n).alias("amount"),
        F.lit("Internal").alias("tx_type"),
        (base + F.make_dt_interval(secs=millis.cast("decimal(18,6)") / 1000)).alias("timestamp"),
    )


def fintech_v1(
    spark: SparkSession,
    rows: int = 10_000,
    users: int = 1_000,
    bursts: int = 50,
    pairs: int = 20,
    seed: int = 0,
    anchor: datetime = ANCHOR,
) -> dict[str, DataFrame]:
    """Users, accounts and transactions with planted fraud."""
    people = row_numbers(spark, users)
    transactions = (
        transactions_v1(row_numbers(spark, rows), users, seed, anchor)
        .unionByName(rapid_fire_v1(row_numbers(spark, bursts), users, seed, anchor))
        .unionByName(double_spend_v1(row_numbers(spark, pairs), users, seed, anchor))
    )
    return {
        "users": users_v1(people, seed, anchor),
        "accounts": accounts_v1(people, users, seed),
        "transactions": transactions,
    }


def users_v2(rows: DataFrame, seed: int = 0, countries: Sequence[str] = COUNTRIES) -> DataFrame:
    """Users of the compact fintech scenario."""
    n = F.col("row")
    return rows.select(
        user_id(seed, n).alias("user_id"),
        draws.choice(KYC_CODES, _salt(seed, "kyc"), n).alias("kyc"),
        draws.choice(countries, _salt(seed, "country"), n).alias("country"),
    )


def accounts_v2(rows: DataFrame, users: int, seed: int = 0) -> DataFrame:
    """Accounts, each with a random owner."""
    n = F.col("row")
    return rows.select(
        account_id(seed, n).alias("account_id"),
        user_id(seed, draws.below(users, _salt(seed, "owner"), n)).alias("user_id"),
        draws.choice(ACCOUNT_CODES, _salt(seed, "type"), n).alias("type"),
    )


def transactions_v2(rows: DataFrame, accounts: int, seed: int = 0, anchor: datetime = ANCHOR) -> DataFrame:
    """Transactions, each from a random account."""
    n = F.col("row")
    source = draws.below(accounts, _salt(seed, "src"), n)
    return rows.select(
        draws.uuid_text(_salt(seed, "tx"), n).alias("tx_id"),
        account_id(seed, source).alias("src_id"),
        draws.money("1", "5000", _salt(seed, "amount"), n).alias("amount"),
        draws.seconds_before(_anchor(anchor), YEAR, _salt(seed, "time"), n).alias("ts"),
    )


def fintech(
    spark: SparkSession,
    rows: int = 10_000,
    users: int = 1_000,
    accounts: int = 1_500,
    seed: int = 0,
    anchor: datetime = ANCHOR,
) -> dict[str, DataFrame]:
    """The compact fintech scenario."""
    return {
        "users": users_v2(row_numbers(spark, users), seed),
        "accounts": accounts_v2(row_numbers(spark, accounts), users, seed),
        "transactions": transactions_v2(row_numbers(spark, rows), accounts, seed, anchor),
    }


def review_table(rows: DataFrame, seed: int = 0, words: Sequence[str] = WORDS) -> DataFrame:
    """Reviews (G7): a sentence of 6 to 14 words, a score in [-1, 1] and a label that is independent of it."""
    n = F.col("row")
    length = draws.below(9, _salt(seed, "length"), n) + 6
    places = F.sequence(F.lit(1).cast("bigint"), length)
    sentence = F.array_join(F.transform(places, lambda i: draws.choice(words, _salt(seed, "word"), n, i)), " ")
    score = (draws.below(201, _salt(seed, "score"), n) - 100).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(2,2)")
    return rows.select(
        draws.uuid_text(_salt(seed, "review"), n).alias("review_id"),
        draws.choice(CATEGORIES, _salt(seed, "category"), n).alias("category"),
        F.concat(F.upper(F.substring(sentence, 1, 1)), F.substr(sentence, F.lit(2)), F.lit(".")).alias("text"),
        score.cast("decimal(5,2)").alias("sentiment_score"),
        draws.choice(SENTIMENTS, _salt(seed, "sentiment"), n).alias("sentiment_label"),
    )


def reviews(spark: SparkSession, rows: int = 10_000, seed: int = 0) -> dict[str, DataFrame]:
    """The review scenario."""
    return {"reviews": review_table(row_numbers(spark, rows), seed)}
