"""Q2-Q7 against brute force on small fixtures with ties, skew and boundary cases."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from steward.operators import analytics

START = datetime(2024, 1, 1)


def transactions(spark, n=600, seed=1, hot=0.5, span=300):
    """``n`` rows, a share ``hot`` of one key, times on half seconds so that ties occur."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", "c"])
        rows.append((i, key, rng.choice(["x", "y", None]), rng.choice([1.5, 2.5]), START + timedelta(seconds=rng.randrange(span * 2) / 2)))
    rows += [(n, None, "x", 1.5, START), (n + 1, "a", "x", 1.5, None)]
    return rows, spark.createDataFrame(rows, "id long, src string, dest string, amount double, ts timestamp_ntz")


@pytest.mark.parametrize("frame,slices", [(10, None), (10, 1), (10, 3.7), (10, 1000), (0.5, None)])
def test_frame_count_is_the_range_count(spark, frame, slices):
    rows, df = transactions(spark)
    got = {
        (r.id, r.tx_count) for r in analytics.rapid_fire_in_frame(df, "src", "ts", frame, 3, slice_seconds=slices).collect()
    }
    want = set()
    timed = [r for r in rows if r[4] is not None]
    for r in timed:
        n = sum(1 for o in timed if o[1] == r[1] and timedelta(0) <= r[4] - o[4] <= timedelta(seconds=frame))
        if n > 3:
            want.add((r[0], n))
    assert got == want and want


def test_frame_with_several_keys_and_old_dates(spark):
    rows = [(i, "a", i % 2, datetime(1960, 1, 1) + timedelta(seconds=i)) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, k string, p int, ts timestamp_ntz")
    got = analytics.rapid_fire_in_frame(df, ["k", "p"], "ts", 6, 3)
    assert {r.id for r in got.collect()} == set(range(6, 20))
    assert got.columns == ["id", "k", "p", "ts", "tx_count"]


def test_burst_across_a_minute_is_seen_by_the_frame_only(spark):
    def burst(second):
        return [(i, "a", START + timedelta(seconds=second + 2 * i)) for i in range(5)]

    for second, seen in [(0, 1), (53, 1), (54, 0), (55, 0), (57, 0), (58, 1)]:
        df = spark.createDataFrame(burst(second), "id long, src string, ts timestamp_ntz")
        assert analytics.rapid_fire_by_bucket(df, "src", "ts").count() == seen, second
        assert analytics.rapid_fire_in_frame(df, "src", "ts", 10).count() == 2


def test_bucket_keeps_the_time_type(spark):
    _, df = transactions(spark)
    assert dict(analytics.rapid_fire_by_bucket(df, "src", "ts").dtypes)["bucket"] == "timestamp_ntz"


@pytest.mark.parametrize("slices", [None, 1, 2.5, 1000])
def test_double_spend_is_the_lag(spark, slices):
    rows, df = transactions(spark, n=500, hot=0.7)
    got = {
        (r.id, r.previous_id, r.gap_micros)
        for r in analytics.double_spend(df, ["src", "dest", "amount"], "ts", "id", 1, slice_seconds=slices).collect()
    }
    want, groups = set(), {}
    for r in rows:
        if r[4] is not None:
            groups.setdefault(r[1:4], []).append((r[4], r[0]))
    for members in groups.values():
        members.sort()
        for (t0, i0), (t1, i1) in zip(members, members[1:]):
            if t1 - t0 <= timedelta(seconds=1):
                want.add((i1, i0, int((t1 - t0).total_seconds() * 1e6)))
    assert got == want and want


def test_slice_must_hold_the_limit(spark):
    _, df = transactions(spark, n=5)
    with pytest.raises(ValueError):
        analytics.double_spend(df, ["src"], "ts", "id", 10, slice_seconds=5)
    with pytest.raises(ValueError):
        analytics.rapid_fire_in_frame(df, "src", "ts", 0)


def test_top_groups_by_volume(spark):
    tx = spark.createDataFrame([(1, "10.10"), (1, "0.20"), (2, "10.30"), (3, "1"), (None, "99"), (9, "99")], "acc int, amt string")
    tx = tx.select("acc", F.col("amt").cast("decimal(18,2)"))
    accounts = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, "u3")], "account int, owner string")
    owners = spark.createDataFrame([("u1", "DE"), ("u2", "AT"), ("u3", "FR")], "user string, country string")
    args = dict(tx_account="acc", account_id="account", account_owner="owner", owner_id="user", group="country", amount="amt")
    got = analytics.top_groups_by_volume(tx, accounts, owners, **args).collect()
    assert [(r.country, str(r.total_vol)) for r in got] == [("AT", "10.30"), ("DE", "10.30"), ("FR", "1.00")]
    assert analytics.top_groups_by_volume(tx, accounts, owners, **args, top=1).count() == 1


def test_mean_and_rank(spark):
    rows = [("a", "0.10"), ("a", "0.20"), ("b", "0.15"), ("c", "-1"), ("d", None), ("e", "1.00")]
    df = spark.createDataFrame(rows, "cat string, score string").select("cat", F.col("score").cast("decimal(5,2)"))
    means = {r.cat: r.mean_value for r in analytics.mean_by_group(df, "cat", "score").collect()}
    assert means == {"a": 0.15, "b": 0.15, "c": -1.0, "d": None, "e": 1.0}
    ranks = {r.cat: r.sentiment_rank for r in analytics.rank_by_mean(df, "cat", "score").collect()}
    assert ranks == {"e": 1, "a": 2, "b": 2, "c": 4, "d": 5}
    alone = {r.cat: r.sentiment_rank for r in analytics.rank_by_mean(df.where("cat = 'a'"), "cat", "score").collect()}
    assert alone == {"a": 1}


def test_many_groups_are_ranked_alike(spark):
    rng = random.Random(8)
    # Half of the groups share one mean, some have none.
    rows = [(f"g{i}", str(rng.choice([0, 0, 0, rng.randrange(-300, 300) / 100])) if i % 50 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "cat string, score string").select("cat", F.col("score").cast("decimal(5,2)"))
    got = analytics.rank_by_mean(df, "cat", "score")
    assert got.dtypes == [("cat", "string"), ("mean_value", "double"), ("sentiment_rank", "bigint")]
    values = sorted((float(v) if v is not None else float("-inf") for _, v in rows), reverse=True)
    first = {}
    for i, v in enumerate(values):
        first.setdefault(v, i + 1)
    assert {r.cat: r.sentiment_rank for r in got.collect()} == {
        c: first[float(v) if v is not None else float("-inf")] for c, v in rows
    }


def test_small_values_keep_their_digits(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.004), ("b", 0.25)], "cat string, score double")
    means = {r.cat: r.mean_value for r in analytics.mean_by_group(df, "cat", "score").collect()}
    assert means == {"a": 0.004, "b": 0.25}
    assert {r.cat: r.sentiment_rank for r in analytics.rank_by_mean(df, "cat", "score").collect()} == {"b": 1, "a": 2}


def test_unknown_units_are_refused(spark):
    _, df = transactions(spark, n=5)
    with pytest.raises(ValueError):
        analytics.rapid_fire_by_bucket(df, "src", "ts", unit="minutes")


def test_columns_of_any_name(spark):
    rows = [(i, "a", START + timedelta(seconds=i), 1) for i in range(6)]
    names = ["a.b", "n", "_at", "_slice"]
    df = spark.createDataFrame(rows, "x long, y string, z timestamp_ntz, w int").toDF(*names)
    assert analytics.double_spend(df, ["n"], "_at", "a.b", 1).columns == [*names, "previous_id", "gap_micros"]
    assert analytics.double_spend(df, ["n"], "_at", "a.b", 1).count() == 5
    assert analytics.rapid_fire_in_frame(df, "n", "_at", 3).columns == [*names, "tx_count"]


def test_a_hot_instant_and_a_hot_key_are_spread(spark):
    # A third of the rows at one instant, another third of one key within one frame.
    rows = spark.range(30_000).select(
        F.col("id"), F.expr("if(id % 3 = 2, concat('k', id), 'hot')").alias("k"),
        F.expr("timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, if(id % 3 = 0, 1, id * 0.001))").alias("ts"),
    )
    got = analytics.rapid_fire_in_frame(rows, "k", "ts", 60, 3)
    assert got.where("id = 0").first().tx_count == 10_000 + 334  # and those of up to one second
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text


def test_row_counts(spark):
    got = analytics.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert [tuple(r) for r in got] == [("a", 3), ("b", 0)]
    with pytest.raises(ValueError):
        analytics.row_counts({})
