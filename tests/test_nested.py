"""F1-F4."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from steward.functions import nested


def test_remove_keys_at_every_level(spark):
    df = spark.sql(
        "SELECT named_struct('id', 1, 'n', 2, 'inner', named_struct('secret', 's', 'keep', 'k', 'm', map('secret', 1, 'k', 2)),"
        " 'l', array(named_struct('secret', 1))) AS r"
    )
    got = df.select(nested.remove_keys(F.col("r"), df.schema["r"].dataType, ["id", "secret"]).alias("r")).first().r
    assert got.asDict(True) == {"n": 2, "inner": {"keep": "k", "m": {"k": 2}}, "l": [{"secret": 1}]}
    maps = spark.sql("SELECT map('a', map('x', 1, 'y', 2), 'x', map('y', 3)) AS m")
    got = maps.select(nested.remove_keys(F.col("m"), maps.schema["m"].dataType, "x").alias("m")).first().m
    assert got == {"a": {"y": 2}}


def test_absent_record_stays_absent(spark):
    df = spark.createDataFrame([(None,)], "r struct<a:int,b:int>")
    kind = df.schema["r"].dataType
    assert df.select(nested.remove_keys(F.col("r"), kind, "a").alias("r")).first().r is None
    assert df.select(nested.keep_keys(F.col("r"), kind, "a").alias("r")).first().r is None
    assert df.select(nested.pretty_json(F.col("r"), kind).alias("r")).first().r == "null"


def test_keep_keys(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', 2) AS s, map('a', 1, 'b', 2) AS m, 1 AS i")
    kind = {f.name: f.dataType for f in df.schema.fields}
    assert df.select(nested.keep_keys(F.col("s"), kind["s"], ["b"]).alias("r")).first().r.asDict() == {"b": 2}
    assert df.select(nested.keep_keys(F.col("m"), kind["m"], "a").alias("r")).first().r == {"a": 1}
    for column, names in (("s", ["z"]), ("i", ["a"])):
        with pytest.raises(ValueError):
            nested.keep_keys(F.col(column), kind[column], names)


def test_distinct_lists(spark):
    df = spark.createDataFrame([({"w": [1, 2, 1, None, None], "e": []},)], "m map<string,array<int>>")
    assert df.select(nested.distinct_lists(F.col("m")).alias("m")).first().m == {"w": [1, 2, None], "e": []}


def test_pretty_json_is_the_language_dump(spark):
    schema = (
        "z int, a struct<y:array<int>,x:map<string,double>,e:array<int>>, t timestamp_ntz, d date, q string, m decimal(5,2), n string,"
        " b boolean, f timestamp_ntz"
    )
    row = (
        1,
        ([1, None], {"k": 1.5, "b": 2.0}, []),
        datetime(2024, 1, 1),
        date(2024, 1, 2),
        'say "hi"\n\\é',
        Decimal("1.25"),
        None,
        True,
        datetime(2024, 1, 1, 0, 0, 0, 123000),
    )
    df = spark.createDataFrame([row], schema)
    struct = F.struct(*df.columns)
    kind = df.select(struct.alias("r")).schema["r"].dataType
    got = df.select(nested.pretty_json(struct, kind).alias("r")).first().r

    def default(value):
        return str(value) if isinstance(value, (date, datetime)) else None

    plain = dict(zip(df.columns, row))
    plain["a"] = dict(zip(["y", "x", "e"], row[1]))
    assert got == json.dumps(plain, indent=4, sort_keys=True, default=default, ensure_ascii=False)


def test_floats_are_written_as_the_language_writes_them(spark):
    values = [0.0, -0.0, 1.0, 1.5, 1e7, 1e10, -1.25e15, 1e16, 1.5e300, 1e-3, 1e-4, -1.25e-4, 1e-5, 2.5e-7, 123456789.125]
    values += [float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "i int, v array<double>")
    kind = df.schema["v"].dataType
    got = {r.i: r.t for r in df.select("i", nested.pretty_json(F.col("v"), kind).alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [json.dumps([v], indent=4) for v in values]
