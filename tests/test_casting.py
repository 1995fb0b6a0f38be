"""C1-C12 on the literals that tell the rules apart."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.functions import casting, normalize
from steward.operators import coerce

NUMBERS = {
    "12.9": (12, 12.9),
    "-12.9": (-12, -12.9),
    "-0.5": (0, -0.5),
    "1e3": (1000, 1000.0),
    " 7 ": (7, 7.0),
    "\t7\n": (7, 7.0),
    "1_000": (1000, 1000.0),
    "1__0": (None, None),
    "_1": (None, None),
    "1d": (None, None),
    "1f": (None, None),
    "0x1p3": (None, None),
    "+.5": (0, 0.5),
    "5.": (5, 5.0),
    ".": (None, None),
    "1 2": (None, None),
    "9007199254740993": (9007199254740992, 9007199254740992.0),
    "1e30": (None, 1e30),
    "9223372036854775808": (None, 2.0**63),
    "-9223372036854775808": (-(2**63), -(2.0**63)),
    "9223372036854774784": (9223372036854774784, 9223372036854774784.0),
    "inf": (None, math.inf),
    "-Infinity": (None, -math.inf),
    "abc": (None, None),
    "": (None, None),
    None: (None, None),
    "yes": (None, None),
    "1": (1, 1.0),
}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def read(spark, values, make):
    rows = frame(spark, values).select("v", make(F.col("v")).alias("r")).collect()
    return {row.v: row.r for row in rows}


def test_integer_and_float(spark):
    ints, floats = read(spark, NUMBERS, casting.as_integer), read(spark, NUMBERS, casting.as_float)
    assert ints == {k: v[0] for k, v in NUMBERS.items()}
    assert floats == {k: v[1] for k, v in NUMBERS.items()}


def test_nan(spark):
    assert math.isnan(read(spark, ["NaN"], casting.as_float)["NaN"])
    assert read(spark, ["NaN"], casting.as_integer)["NaN"] is None


def test_float_accepts_what_the_language_accepts(spark):
    """Same verdict and value as ``float`` on every short text over the characters of literals."""
    import itertools

    texts = ["".join(t) for n in range(1, 5) for t in itertools.product("1.e+-_ ", repeat=n)]

    def want(text):
        try:
            value = float(text)
            return value if math.isfinite(value) else math.inf
        except ValueError:
            return None

    got = read(spark, texts, casting.as_float)
    assert {t: got[t] for t in texts} == {t: want(t) for t in texts}


def test_text_keeps_null(spark):
    assert read(spark, ["x", None], casting.as_text) == {"x": "x", None: None}


def test_boolean_modes(spark):
    values = ["t", "TRUE", "yes", "1", " T ", "f", "FALSE", "no", "0", "12.9", "abc", "", None]
    token = read(spark, values, casting.as_boolean)
    assert [token[v] for v in values] == [True] * 5 + [False] * 4 + [None] * 4
    truthy = read(spark, values, lambda c: casting.as_boolean(c, mode="truthy"))
    assert [truthy[v] for v in values] == [True] * 11 + [False] * 2
    with pytest.raises(ValueError):
        casting.as_boolean(F.col("v"), mode="maybe")


def test_collections(spark):
    assert read(spark, ["abc", "", None], casting.as_items) == {"abc": ["a", "b", "c"], "": [], None: None}
    pairs = spark.createDataFrame(
        [([("a", 1), ("b", 2), ("a", 3)],), ([],), (None,)], "v array<struct<left:string,right:int>>"
    )
    got = [row.r for row in pairs.select(casting.as_mapping(F.col("v")).alias("r")).collect()]
    assert got == [{"a": 3, "b": 2}, {}, None]


def test_unknown_type_name():
    for name in ("numeric", "uuid", "timestamp", "complex"):
        with pytest.raises(ValueError, match="unknown type name"):
            casting.cast_as(F.lit("1"), name)


def test_strict_fails_at_run_time(spark):
    for value, name in (("abc", "int"), ("", "float"), ("maybe", "bool")):
        with pytest.raises(Exception, match="cannot read"):
            frame(spark, [value]).select(casting.cast_as(F.col("v"), name, strict=True)).collect()
    assert frame(spark, ["7", None]).select(casting.as_integer(F.col("v"), strict=True).alias("r")).collect()[1].r is None


def test_normalize(spark):
    flags = ["t", "TRUE", "f", "FALSE", "true", "T", "", None]
    got = read(spark, flags, normalize.flag_to_boolean)
    assert [got[v] for v in flags] == [True, True, False, False, None, None, None, None]
    assert read(spark, ["", "x", None], normalize.empty_to_null) == {"": None, "x": "x", None: None}


def test_canonical_time(spark):
    want = {
        "2019-07-14 10:32:22.123+00": "2019-07-14 10:32:22.123000+00",
        "2019-07-14 10:32:22+00": "2019-07-14 10:32:22.000000+00",
        "2019-07-14 10:32:22.123456": "2019-07-14 10:32:22.123456+00",
        "2019-07-14 10:32:22.123456+00": "2019-07-14 10:32:22.123456+00",
        "2019-07-14 10:32:22.5-04": "2019-07-14 14:32:22.500000+00",
        "bad": None,
        None: None,
    }
    assert read(spark, want, normalize.canonical_time_text) == want
    stored = spark.sql("SELECT TIMESTAMP '2019-07-14 10:32:22.5' AS v").select(normalize.time_text(F.col("v")).alias("r"))
    assert stored.first().r == "2019-07-14 10:32:22.500000+00"


def test_coerce_rows_and_rejects(spark):
    df = spark.createDataFrame([("1", "t", "a"), ("x", "maybe", "b"), (None, None, None)], "n string, b string, s string")
    typed = coerce.coerce(df, {"n": "integer", "b": "boolean", "s": "text"})
    assert typed.dtypes[:3] == [("n", "bigint"), ("b", "boolean"), ("s", "string")]
    assert coerce.accepted(typed).collect() == [(1, True, "a"), (None, None, None)]
    (bad,) = coerce.rejected(typed).collect()
    assert bad[coerce.REJECT] == ["n: not a valid integer", "b: not a valid boolean"]
    with pytest.raises(ValueError, match="no type is declared"):
        coerce.coerce(df, {"n": "int"})
    with pytest.raises(Exception, match="cannot read"):
        coerce.coerce(df, {"n": "int", "b": "bool", "s": "str"}, strict=True).collect()


def test_numbers_are_coerced_without_text(spark):
    df = spark.createDataFrame([(12.9, 7), (float("nan"), 8), (-0.5, None)], "d double, i int")
    rows = coerce.coerce(df, {"d": "int", "i": "integer"}).collect()
    assert [(r.d, r.i, len(r[coerce.REJECT])) for r in rows] == [(12, 7, 0), (None, 8, 1), (0, None, 0)]
    with pytest.raises(Exception, match="cannot read"):
        coerce.coerce(df, {"d": "int", "i": "int"}, strict=True).collect()


def test_coerce_through_database_types(spark):
    df = spark.createDataFrame([("1", "2.5")], "n string, x string")
    typed = coerce.coerce_through(df, {"n": "int4", "x": "float8"}, {"int4": "int", "float8": "float"})
    assert typed.select("n", "x").first() == (1, 2.5)
    with pytest.raises(ValueError, match="int4"):
        coerce.coerce_through(df, {"n": "int4", "x": "float8"}, {"float8": "float"})


def test_declared_types(spark):
    df = spark.sql("SELECT 1 AS i, 1.5D AS f, 'x' AS s, true AS b, current_date() AS d, array(1) AS l, map('a', 1) AS m")
    assert coerce.declared_types(df) == dict(i="int", f="float", s="str", b="bool", d="datetime", l="list", m="dict")


def test_conform(spark):
    schema = T.StructType().add("id", "long").add("flag", "boolean").add("amt", T.DecimalType(18, 2)).add("t", "string")
    df = spark.createDataFrame(
        [
            ("9007199254740993", "TRUE", "10.555", "t"),
            ("12.9", "", "5", ""),
            ("x", "f", "1", "f"),
            ("9223372036854775808", "n", "2", "g"),
        ],
        "id string, flag string, amt string, t string",
    )
    rows = coerce.conform(df, schema)
    got = [(r.id, r.flag, None if r.amt is None else str(r.amt), r.t, len(r[coerce.REJECT])) for r in rows.collect()]
    assert got == [
        (9007199254740993, True, "10.56", "t", 0),
        (12, None, "5.00", None, 0),
        (None, False, "1.00", "f", 1),
        (None, False, "2.00", "g", 1),
    ]
    with pytest.raises(ValueError, match="no column"):
        coerce.conform(df.withColumn("more", F.lit(1)), schema)
    assert coerce.conform(df.select("id"), schema).first().flag is None


def test_typed_values_are_cast_by_their_type(spark):
    df = spark.sql("SELECT true AS b, 0 AS n, 0.0D AS d, 'f' AS t, array(1) AS l, map('k', 1) AS m, '' AS e")
    typed = coerce.coerce(df, {"b": "int", "n": "int", "d": "float", "t": "str", "l": "list", "m": "dict", "e": "str"}).first()
    assert (typed.b, typed.n, typed.d, typed.l, typed.m, typed[coerce.REJECT]) == (1, 0, 0.0, [1], {"k": 1}, [])
    kinds = {f.name: f.dataType for f in df.schema}
    truths = df.select(*[casting.as_boolean(F.col(c), mode="truthy", held=kinds[c]).alias(c) for c in df.columns]).first().asDict()
    assert truths == {"b": True, "n": False, "d": False, "t": True, "l": True, "m": True, "e": False}
    learned = coerce.coerce(df, coerce.declared_types(df))
    assert learned.first()[coerce.REJECT] == [] and dict(learned.dtypes)["b"] == "boolean"
