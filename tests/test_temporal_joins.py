"""As-of and overlap joins against brute force: hot keys, ties, NULLs, empty sides."""

import random
from datetime import datetime, timedelta

import pytest

from steward.operators import temporal_joins
from steward.operators.temporal_joins import asof_join, overlap_join

START = datetime(2024, 1, 1)


def sides(seed=1, n=400, hot=0.6):
    rng = random.Random(seed)

    def rows(first):
        out = []
        for i in range(n):
            key = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
            at = None if rng.random() < 0.05 else START + timedelta(seconds=rng.randrange(600) / 2 * rng.choice([1, 100]))
            out.append((first + i, key, at))
        return out

    return rows(0), rows(10_000)


def brute_asof(left, right, strict, age):
    out = []
    for i, k, t in left:
        earlier = [
            (u, j) for j, r, u in right
            if k is not None and r == k and t is not None and u is not None and (u < t or (u == t and not strict))
        ]
        best = max(earlier, default=None)
        if best and age is not None and t - best[0] > timedelta(seconds=age):
            best = None
        out.append((i, best[1] if best else None))
    return sorted(out)


@pytest.mark.parametrize("strict,age", [(False, None), (True, None), (False, 20), (True, 0.5)])
@pytest.mark.parametrize("width", [3600, 10, 0.7])
def test_asof_equals_brute_force(spark, strict, age, width):
    left, right = sides()
    l = spark.createDataFrame(left, "id long, k string, ts timestamp_ntz")
    r = spark.createDataFrame(right, "rid long, k string, at timestamp_ntz")
    options = dict(strict=strict, max_age_seconds=age, slice_seconds=width)
    got = asof_join(l, r, ["k"], "ts", "at", **options)
    assert got.columns == ["id", "k", "ts", "rid", "at"]
    want = brute_asof(left, right, strict, age)
    assert sorted((x.id, x.rid) for x in got.collect()) == want
    inner = asof_join(l, r, ["k"], "ts", "at", how="inner", **options)
    assert sorted((x.id, x.rid) for x in inner.collect()) == [p for p in want if p[1] is not None]


def test_asof_across_blocks_of_slices(spark, monkeypatch):
    """What is current is carried over many empty slices and blocks."""
    monkeypatch.setattr("steward.operators.slices.BLOCK_SLICES", 4)
    left, right = sides(seed=2, n=150)
    l = spark.createDataFrame(left, "id long, k string, ts timestamp_ntz")
    r = spark.createDataFrame(right, "rid long, k string, at timestamp_ntz")
    got = asof_join(l, r, ["k"], "ts", "at", slice_seconds=3)
    assert sorted((x.id, x.rid) for x in got.collect()) == brute_asof(left, right, False, None)


def test_asof_ties_keys_and_names(spark):
    l = spark.createDataFrame([(1, 2, "x", START)], "a long, b int, _at string, ts timestamp")
    r = spark.createDataFrame(
        [(1, 2, START, 5, {"m": 1}), (1, 2, START, 7, {"m": 2}), (1, 2, START, 6, None)],
        "a long, c int, at timestamp, v int, `_found` map<string,int>",
    )
    got = asof_join(l, r, ["a", ("b", "c")], "ts", "at", tie=["v"])
    assert got.columns == ["a", "b", "_at", "ts", "c", "at", "v", "_found"] and got.first().v == 7
    assert asof_join(l, r, ["a", ("b", "c")], "ts", "at").first().v == 7
    none = r.where("v > 9")
    assert asof_join(l, none, ["a"], "ts", "at").first().v is None and asof_join(l, none, ["a"], "ts", "at", how="inner").count() == 0
    assert asof_join(l.where("a > 9"), r, ["a"], "ts", "at").count() == 0
    for bad in (dict(how="outer"), dict(slice_seconds=0)):
        with pytest.raises(ValueError):
            asof_join(l, r, ["a"], "ts", "at", **bad)
    with pytest.raises(ValueError):
        asof_join(l, r.withColumnRenamed("v", "TS"), ["a"], "ts", "at")


def test_hot_instants_are_one_row_before_the_windows(spark):
    """Half of all rows at one key and instant: the window's input has that instant once a side."""
    left = spark.range(50_000).selectExpr("id", "if(id % 2 = 0, 'hot', concat('k', id % 50)) AS k", "timestamp'2024-01-01' AS ts")
    right = left.selectExpr("id AS rid", "k", "ts AS at")
    got = asof_join(left, right, ["k"], "ts", "at", tie=["rid"])
    assert got.count() == 50_000 and got.where("rid IS NULL").count() == 0
    assert got.where("k = 'hot'").agg({"rid": "min"}).first()[0] == 49_998


def intervals(rng, n, key_share=0.5):
    out = []
    for i in range(n):
        start = rng.randrange(-500, 3000)
        length = rng.choice([0, 1, 2, 3, 7, 8, 9, 64, 65, 500, 2000, -5])
        key = "hot" if rng.random() < key_share else rng.choice(["a", "b", None])
        out.append((i, key, None if rng.random() < 0.03 else start, None if rng.random() < 0.03 else start + length))
    return out


def brute_overlaps(left, right, keyed):
    return sorted(
        (i, j)
        for i, k, a, b in left
        for j, q, c, d in right
        if None not in (a, b, c, d) and (not keyed or (k is not None and k == q)) and a < b and c < d and a < d and c < b
    )


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("cell", [20_000, 3])
def test_overlaps_equal_brute_force(spark, keyed, cell):
    rng = random.Random(9)
    left, right = intervals(rng, 150), intervals(rng, 170)
    l = spark.createDataFrame(left, "i long, k string, a long, b long")
    r = spark.createDataFrame(right, "j long, k string, c long, d long" if keyed else "j long, q string, c long, d long")
    got = overlap_join(l, r, ("a", "b"), ("c", "d"), ["k"] if keyed else [], cell_rows=cell)
    assert sorted((x.i, x.j) for x in got.select("i", "j").collect()) == brute_overlaps(left, right, keyed)


def test_overlaps_of_times_and_repeated_rows(spark):
    day = timedelta(days=1)
    l = spark.createDataFrame([(1, START, START + day)] * 40, "i long, a timestamp_ntz, b timestamp_ntz")
    r = spark.createDataFrame(
        [(1, START + day, START + 2 * day), (2, START - day, START), (3, START + day / 2, START + 400 * day)],
        "j long, c timestamp_ntz, d timestamp_ntz",
    )
    got = overlap_join(l, r, ("a", "b"), ("c", "d"), cell_rows=7)
    assert [x.j for x in got.collect()] == [3] * 40
    assert overlap_join(l.where("i > 1"), r, ("a", "b"), ("c", "d")).count() == 0
    assert overlap_join(l, r.where("j > 9"), ("a", "b"), ("c", "d")).count() == 0
    with pytest.raises(ValueError):
        overlap_join(l, r.withColumnRenamed("c", "a"), ("a", "b"), ("a", "d"))


def test_hot_cells_are_dealt_into_parts(spark):
    """One bin with most rows of both sides: no part holds more than a cell may have, by far."""
    l = spark.range(3000).selectExpr("id AS i", "id % 4 AS a", "id % 4 + 2 AS b")
    r = spark.range(2000).selectExpr("id AS j", "id % 4 AS c", "id % 4 + 2 AS d")
    whole = overlap_join(l, r, ("a", "b"), ("c", "d"))
    parts = overlap_join(l, r, ("a", "b"), ("c", "d"), cell_rows=250)
    assert whole.count() == parts.count() == parts.distinct().count()
    assert "_p#" in parts._jdf.queryExecution().optimizedPlan().toString()
    assert temporal_joins.CELL_ROWS == 20_000


def test_rows_are_shuffled_once_a_bin_and_without_foreign_keys(spark):
    """Rows met the hot cells by a shuffle of their own, and keys that one side lacks were shown in every bin."""
    l = spark.range(200).selectExpr("id AS i", "id % 2 AS k", "id AS a", "id + 5 AS b")
    r = spark.range(5000).selectExpr("id AS j", "id AS k", "id % 200 AS c", "id % 200 + 9 AS d")
    got = overlap_join(l, r, ("a", "b"), ("c", "d"), ["k"], cell_rows=3)
    want = [(i, j) for i in range(200) for j in range(2) if i % 2 == j and i < j + 9 and j < i + 5]
    assert sorted((x.i, x.j) for x in got.select("i", "j").collect()) == want
    text = got._jdf.queryExecution().sparkPlan().toString()
    assert text.count("SortMergeJoin") == 2 and "LeftSemi" in text and text.count("BroadcastHashJoin") >= 4
