"""E1-E3 and S10 against multiset arithmetic."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from steward.operators import keys, reconcile


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_the_three_parts(spark):
    file = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, v string")
    table = spark.createDataFrame([(None, 1), ("x", 3)], "v string, id int").select("v", "id")
    swap = lambda rows: Counter((v, i) for i, v in rows)
    assert bag(reconcile.fresh_rows(file, table)) == swap([(1, None), (2, "x")])
    assert bag(reconcile.matched_rows(file, table)) == swap([(1, None)])
    assert bag(reconcile.stored_only_rows(file, table)) == swap([(3, "x")])
    assert tuple(reconcile.match_counters(file, table).first()) == (3, 2, 1, 2, 1)


def test_random_bags(spark):
    rng = random.Random(5)
    draw = lambda n: [(rng.choice([None, 1, 2, 3]), rng.choice([None, "x"])) for _ in range(n)]
    a, b = draw(200), draw(150)
    left, right = spark.createDataFrame(a, "i int, s string"), spark.createDataFrame(b, "i int, s string")
    assert bag(reconcile.fresh_rows(left, right)) == Counter(a) - Counter(b)
    assert bag(reconcile.matched_rows(left, right)) == Counter(a) & Counter(b)
    assert bag(reconcile.stored_only_rows(left, right)) == Counter(b) - Counter(a)


def test_random_bags_by_digest(spark):
    rng = random.Random(6)
    times = [None, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1)]
    draw = lambda n: [(rng.choice([None, 0.0, 1.5]), rng.choice([None, "", "x"]), rng.choice(times)) for _ in range(n)]
    a, b = draw(200), draw(100)
    left, right = (spark.createDataFrame(rows, "d double, s string, t timestamp_ntz") for rows in (a, b))
    assert bag(reconcile.fresh_rows_by_digest(left, right.select("t", "s", "d")).select("d", "s", "t")) == Counter(a) - Counter(b)
    minus = left.select((-F.col("d")).alias("d"), "s", "t")
    assert bag(reconcile.fresh_rows_by_digest(minus.where("d = 0"), left)) == Counter()
    lists = left.select(F.array("d", F.lit(None)).alias("l"), F.struct("s", "t").alias("r"))
    other = right.select(F.array("d", F.lit(None)).alias("l"), F.struct("s", "t").alias("r"))
    want = Counter((str(x), str(y)) for x, y in lists.collect()) - Counter((str(x), str(y)) for x, y in other.collect())
    got = Counter((str(x), str(y)) for x, y in reconcile.fresh_rows_by_digest(lists, other).collect())
    assert got == want


@pytest.mark.parametrize("compare", [reconcile.fresh_rows, reconcile.fresh_rows_by_digest])
def test_nested_values_are_equal_as_values(spark, compare):
    one = spark.sql("SELECT array(0.0D) AS l, named_struct('d', -0.0D) AS s, map('a', 1, 'b', 2) AS n, 5 AS `a.b`, 1 AS _hash")
    other = spark.sql("SELECT array(-0.0D) AS l, named_struct('d', 0.0D) AS s, map('b', 2, 'a', 1) AS n, 5 AS `a.b`, 1 AS _hash")
    assert compare(one, other).count() == 0
    assert compare(one.unionAll(one), other).columns == one.columns and compare(one.unionAll(one), other).count() == 1


def test_a_small_batch_meets_a_reduced_table(spark, sf):
    table = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = reconcile.fresh_rows(table.limit(5), table)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in text and "BroadcastHashJoin" in text


def test_empty_sides(spark):
    some = spark.createDataFrame([(1,)], "i int")
    none = some.where("i > 1")
    assert tuple(reconcile.match_counters(none, none).first()) == (0, 0, 0, 0, 0)
    assert bag(reconcile.fresh_rows(some, none)) == Counter([(1,)])


def test_shape_is_checked(spark):
    one = spark.createDataFrame([(1,)], "i int")
    with pytest.raises(ValueError, match="columns differ"):
        reconcile.fresh_rows(one, one.toDF("j"))
    with pytest.raises(ValueError, match="types differ"):
        reconcile.fresh_rows(one.select(F.col("i").cast("string")), one)


@pytest.mark.parametrize("per_task", [1, 7, 1000])
def test_many_copies_are_repeated_in_batches(spark, per_task):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7), ("d", 8), ("e", 100), (None, 15)], "v string, n long")
    got = bag(reconcile.repeat_rows(df, "n", per_task))
    assert got == Counter({("b",): 1, ("c",): 7, ("d",): 8, ("e",): 100, (None,): 15})


ROWS = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e"), (4, "f"), (4, "f"), (4, "f")]


def test_key_violations(spark):
    df = spark.createDataFrame(ROWS, "k int, v string")
    stored = spark.createDataFrame([(3,), (9,)], "k int")
    assert bag(keys.key_violations(df, ["k"])) == Counter([(1, 2), (None, 1), (4, 3)])
    assert bag(keys.key_violations(df, ["k"], stored)) == Counter([(1, 2), (None, 1), (3, 1), (4, 3)])


def test_split_by_violations(spark):
    df = spark.createDataFrame(ROWS, "k int, v string")
    good, bad = keys.split_violations(df, keys.key_violations(df, ["k"]), ["k"])
    assert bag(good) == Counter([(2, "c"), (3, "e")])
    assert bag(bad) == Counter(ROWS) - bag(good)


@pytest.mark.parametrize("names", [("n", "_bad"), ("a.b", "n"), ("_taken", "_key0")])
def test_keys_of_any_name(spark, names):
    df = spark.createDataFrame(ROWS, "k int, v string").toDF(*names)
    stored = spark.createDataFrame([(3,), (9,)], "k int").toDF(names[0])
    violations = keys.key_violations(df, [names[0]], stored)
    assert {r[0] for r in violations.collect()} == {None, 1, 3, 4}
    good, bad = keys.split_violations(df, violations, [names[0]])
    assert bag(good) == Counter([(2, "c")]) and bag(bad) == Counter(ROWS) - bag(good) and good.columns == list(names)
