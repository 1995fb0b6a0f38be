"""D1-D5 on small fixtures, including the language's rounding."""

import random

import pytest
from pyspark.sql import functions as F

from steward.functions.nested import data_depth, json_depth
from steward.operators import profile


def by_column(df):
    return {r.column_name: r.asDict() for r in df.collect()}


def test_profile_counts_empty_as_absent(spark):
    rows = [("1", "a", "", "x"), ("2", "a", None, "y"), ("3", "", None, "z"), ("3", None, "", "z")]
    df = spark.createDataFrame(rows, "id string, kind string, never string, created_at string")
    got = by_column(profile.column_profile(df))
    assert set(got) == {"id", "kind"}
    assert got["id"] == dict(column_name="id", total=4, filled=4, distinct_values=3, uniqueness=0.75, completeness=1.0)
    assert got["kind"] == dict(column_name="kind", total=4, filled=2, distinct_values=1, uniqueness=0.5, completeness=0.5)
    with pytest.raises(ValueError):
        profile.column_profile(df.select("created_at"))


def test_long_texts_and_types(spark):
    long = "x" * 500
    rows = [(long + "a", 0.0, [1], b"a"), (long + "b", -0.0, [1], b"b"), (long + "a", 1.5, [2], None)]
    df = spark.createDataFrame(rows, "t string, d double, l array<int>, b binary")
    got = {c: r["distinct_values"] for c, r in by_column(profile.column_profile(df)).items()}
    assert got == {"t": 2, "d": 2, "l": 2, "b": 2}


def test_ratios_round_as_the_language_does(spark):
    rng = random.Random(3)
    pairs = {(d, n) for n in (8, 16, 40, 200, 400, 1000) for d in range(1, n + 1)}
    pairs |= {(rng.randrange(1, 10**12), 10**12) for _ in range(200)}
    df = spark.createDataFrame(sorted(pairs), "d long, n long")
    got = profile._ratio(df, "r", "d", "n").collect()
    assert [(r.d, r.n, r.r) for r in got] == [(r.d, r.n, round(r.d / r.n, 2)) for r in got]


def test_candidate_keys(spark):
    rows = [(i, f"n{i}", i // 2, i % 3, "", i) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, name string, half long, third long, none string, updated_at long")
    for error in (None, 0.06):
        levels = lambda n: {(r.column_name, r.level) for r in profile.candidate_keys(df, n, prefilter_error=error).collect()}
        assert levels(1) == {("id", 1), ("name", 1)}
        assert levels(2) == {("id", 1), ("name", 1), ("half", 2)}
        assert levels(9) == {("id", 1), ("name", 1), ("half", 2), ("third", 3)}
    for bad in (None, 0, 1.5):
        with pytest.raises(ValueError):
            profile.candidate_keys(df, bad)


def test_exact_levels_split_what_rounding_joins(spark):
    df = spark.range(1000).select(F.col("id").alias("a"), F.greatest("id", F.lit(1)).alias("b"))
    assert profile.candidate_keys(df, 1).count() == 2
    assert [r.column_name for r in profile.candidate_keys(df, 1, exact=True).collect()] == ["a"]


def test_fields_and_alignment(spark):
    df = spark.createDataFrame([('{"b":1,"a":2}',), ('{"c":{"d":1}}',), (None,), ("{}",)], "j string")
    assert sorted(r.field for r in profile.json_fields(df, "j").collect()) == ["a", "b", "c"]
    maps = spark.createDataFrame([({"x": 1},), ({"y": 2, "x": 3},)], "m map<string,int>")
    assert sorted(r.field for r in profile.map_fields(maps, "m").collect()) == ["x", "y"]
    union = profile.align([spark.createDataFrame([(1, 2)], "b int, a int"), spark.createDataFrame([(3,)], "c int")])
    assert union.columns == ["a", "b", "c"]
    assert {tuple(r) for r in union.collect()} == {(2, 1, None), (None, None, 3)}


DEPTHS = {
    "3": 0,
    "{}": 0,
    "{ }": 0,
    '{"a":1}': 1,
    '{"a":{}}': 1,
    '{"a":{"b":{}}}': 2,
    '{"a":{"b":{"c":1}},"q":"}{"}': 3,
    '[{"a":1}]': 0,
    '{"a":[{"b":{"c":1}}]}': 1,
    '{"a":[{"b":{"c":1}}],"d":{"e":1}}': 2,
    '{"a\\"{":"\\\\","b":{"c":"]"}}': 2,
    '{"t":"' + "\\n{" * 20000 + '","b":{"c":1}}': 2,
}


def test_json_depth(spark):
    df = spark.createDataFrame([(t,) for t in DEPTHS], "t string")
    got = {r.t: r.d for r in df.select("t", json_depth(F.col("t")).alias("d")).collect()}
    assert got == DEPTHS
    assert profile.max_depth(df, "t").first().depth == 3


def test_depth_of_data(spark):
    df = spark.sql(
        "SELECT 1 AS a, named_struct('b', named_struct('c', 1)) AS s, map('k', map('l', 1)) AS m, array(named_struct('x', 1)) AS l,"
        " map('k', map()) AS e, cast(map() AS map<string,map<string,int>>) AS n, cast(NULL AS struct<b:struct<c:int>>) AS z"
    )
    depths = df.select(*[data_depth(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]).first().asDict()
    assert depths == {"a": 0, "s": 2, "m": 2, "l": 0, "e": 1, "n": 0, "z": 0}
    assert profile.max_depth(df).first().depth == 3
    assert profile.max_depth(df, "s").first().depth == 2 and profile.max_depth(df, "e").first().depth == 1
    assert profile.max_depth(df.limit(0), "m").first().depth == 0


def test_maps_are_equal_in_any_order(spark):
    df = spark.sql("SELECT map('a', 0.0D, 'b', 2.0D) AS m UNION ALL SELECT map('b', 2.0D, 'a', -0.0D)")
    assert profile.column_profile(df).first().distinct_values == 1


def test_a_precision_beyond_the_sketches_is_refused(spark):
    with pytest.raises(ValueError):
        profile.candidate_keys(spark.range(10), prefilter_error=0.001)
    assert profile.candidate_keys(spark.range(10), prefilter_error=0.0044).count() == 1
