"""Grains, sketches and nested fields against brute force: NULLs, merging orders, error bounds, ragged records."""

import json
import math
import random
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from steward.operators import sketches as sketches_module
from steward.operators.fields import merged_fields, nested_fields, type_conflicts
from steward.operators.grains import cube, rollup, totals_by_grains
from steward.operators.sketches import (
    ACCURACY, REGISTER_BITS, SKETCH, SUPPORT, distinct_counts, frequent_values, merged_sketch, quantiles, sketch_batch,
)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_grains_equal_a_loop(spark):
    rng = random.Random(1)
    rows = [(rng.choice("xy"), rng.choice([1, 2, None]), rng.choice(["p", None]), rng.choice([1.25, -0.5, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, `b.c` int, d string, v double")
    columns = ["a", "b.c", "d"]
    for sets in (rollup(columns), cube(columns), [("a",), ("a",), ("d", "b.c")]):
        got = totals_by_grains(df, sets, "v", scale=2)
        named = list(dict.fromkeys(c for g in sets for c in g))
        want = {}
        for g in dict.fromkeys(sets):
            grain = sum(1 << (len(named) - 1 - i) for i, c in enumerate(named) if c not in g)
            for r in rows:
                key = (*[dict(zip(columns, r))[c] if c in g else None for c in named], grain)
                n, valued, total = want.get(key, (0, 0, 0.0))
                want[key] = (n + 1, valued + (r[3] is not None), total + (r[3] or 0))
        found = {tuple(r[: len(named) + 1]): r for r in map(tuple, got.collect())}
        assert found.keys() == want.keys()
        for key, (n, valued, total) in want.items():
            r = found[key]
            assert r[-3] == n and (float(r[-2]) if valued else r[-2]) == (total if valued else None)
            assert r[-1] is None if not valued else math.isclose(r[-1], total / valued)


def test_rows_are_summed_before_they_are_multiplied(spark):
    text = plan(totals_by_grains(spark.range(10).selectExpr("id % 2 AS a", "id % 3 AS b", "id AS v"), cube(["a", "b"]), "v"))
    assert text.index("Expand") < text.rindex("Aggregate") and text.count("Expand") == 1


def test_weights_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 10, 3), ("a", None, 2), ("b", 5, 1)], "k string, v int, w int")
    got = {r["k"]: (r["n"], r["total"], r["mean_value"]) for r in totals_by_grains(df, [("k",), ()], "v", weight="w").collect()}
    assert got == {"a": (5, 10, 10 / 3), "b": (1, 5, 5.0), None: (6, 15, 15 / 4)}
    assert [r["n"] for r in totals_by_grains(df.where("w > 9"), rollup(["k"]), "v").collect()] in ([0], [])
    for bad in ([], [("n",)]):
        with pytest.raises(ValueError):
            totals_by_grains(df.withColumn("n", F.lit(1)), bad, "v")


def numbers(seed, n):
    rng = random.Random(seed)
    special = [None, 0.0, math.inf, -math.inf]
    return [(rng.choice(["", None, "hot", "hot", f"t{rng.randrange(5000)}"]), rng.choice(special) if rng.random() < 0.05 else rng.lognormvariate(2, 3) * rng.choice([1, 1, -1]), rng.randrange(12)) for _ in range(n)]


SCHEMA = "t string, x double, `i.j` int"


def frozen(df):
    return sorted(map(tuple, df.select(*SKETCH.names).collect()), key=str)


def test_merging_has_no_order(spark):
    parts = [sketch_batch(spark.createDataFrame(numbers(s, 2000), SCHEMA)).cache() for s in range(3)]
    want = frozen(merged_sketch(parts))
    for order in permutations(range(3)):
        first = merged_sketch([parts[order[0]], parts[order[1]]])
        assert frozen(merged_sketch([first, parts[order[2]]])) == want
    whole = spark.createDataFrame([r for s in range(3) for r in numbers(s, 2000)], SCHEMA)
    by_kind = lambda rows: [r for r in rows if r[1] != "frequent"]
    for cut in (1, 7):
        assert by_kind(frozen(sketch_batch(whole.repartition(cut)))) == by_kind(want)


def test_estimates_are_within_their_errors(spark):
    batches = [numbers(s, 4000) for s in range(4)]
    rows = [r for b in batches for r in b]
    sketch = merged_sketch([sketch_batch(spark.createDataFrame(b, SCHEMA)) for b in batches]).cache()
    counts = {r["column"]: r for r in distinct_counts(sketch).collect()}
    for at, name in enumerate(["t", "x", "i.j"]):
        values = [r[at] for r in rows if r[at] not in (None, "")]
        assert (counts[name]["n"], counts[name]["filled"]) == (len(rows), len(values))
        assert abs(counts[name]["distinct"] - len(set(values))) <= 4 * 1.04 / math.sqrt(1 << REGISTER_BITS) * len(set(values))
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    for r in quantiles(sketch, shares).collect():
        at = ["t", "x", "i.j"].index(r["column"])
        values = sorted(v[at] for v in rows if v[at] is not None)
        exact = values[max(math.ceil(r["share"] * len(values)), 1) - 1]
        assert r["value"] == exact if math.isinf(exact) else abs(r["value"] - exact) <= ACCURACY * 1.0001 * abs(exact), (r, exact)
    found = {(r["column"], r["value"]): r["n"] for r in frequent_values(sketch, 0.02).collect()}
    true = Counter(r[0] for r in rows if r[0])
    filled = sum(true.values())
    assert all(("t", v) in found for v, n in true.items() if n >= 0.02 * filled)
    assert all(true[v] - SUPPORT * filled <= n <= true[v] for (c, v), n in found.items() if c == "t")
    assert found["t", "hot"] == true["hot"] and len([k for k in found if k[0] == "i.j"]) == 12


def test_large_distinct_counts(spark):
    sketch = sketch_batch(spark.range(300_000).selectExpr("id", "id % 50000 AS m"))
    got = {r["column"]: r["distinct"] for r in distinct_counts(sketch).collect()}
    assert abs(got["id"] - 300_000) < 0.033 * 300_000 and abs(got["m"] - 50_000) < 0.033 * 50_000
    assert sketch.groupBy("column").count().agg(F.max("count")).first()[0] < 40_000


def test_odd_batches(spark):
    empty = sketch_batch(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and distinct_counts(empty).count() == 0 and quantiles(empty, [0.5]).count() == 0
    nothing = sketch_batch(spark.createDataFrame([(None, None, None)] * 3, SCHEMA))
    assert sorted((r["column"], r["n"], r["filled"], r["distinct"]) for r in distinct_counts(nothing).collect()) == [
        ("i.j", 3, 0, 0), ("t", 3, 0, 0), ("x", 3, 0, 0)
    ]
    with pytest.raises(ValueError):
        sketch_batch(spark.createDataFrame([([1],)], "a array<int>"))
    with pytest.raises(ValueError):
        sketch_batch(spark.createDataFrame([(1,)], "a int"), ["b"])
    with pytest.raises(ValueError):
        frequent_values(empty, SUPPORT)


def brute_fields(texts):
    out = Counter()

    def walk(path, v):
        kind = (
            "null" if v is None else "boolean" if isinstance(v, bool) else "integer" if isinstance(v, int) and abs(v) < 1 << 63
            else "number" if isinstance(v, (int, float)) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"
        )
        out[path, kind] += 1
        for item in v if isinstance(v, list) else ():
            walk(path + "[]", item)
        for k, item in v.items() if isinstance(v, dict) else ():
            walk(path + "." + (k if k.replace("_", "a").isalnum() and k.isascii() else "`" + k.replace("`", "``") + "`"), item)

    for t in texts:
        if t is not None:
            try:
                walk("$", json.loads(t))
            except ValueError:
                out["$", "invalid"] += 1
    return out


TEXTS = [
    '{"a": 1, "b": [1, "x", {"c": null}], "d": {"e": 1.5, "f": true, "g.h": "s", "": 1, "k`q": [[], [[2]]]}}',
    '{"a": "text", "b": {"c": [1]}}', "[]", "3", "null", '"s"', "bad{", None, '{"a": 123456789012345678901234567890, "é": 2}',
    '{"deep": ' * 30 + "1" + "}" * 30, '{"a": []}', '{"a": []}', "",
]


def test_nested_fields_equal_a_walk(spark):
    df = spark.createDataFrame([(t, 1, "x") for t in TEXTS], "`j.s` string, path int, n string")
    got = {(r["path"], r["type"]): r["n"] for r in nested_fields(df, "j.s").collect()}
    assert got == dict(brute_fields(TEXTS))


def test_fields_merge_and_conflict(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "j string")
    parts = [nested_fields(df.where(F.coalesce(F.length("j") % 3, F.lit(0)) == k), "j") for k in range(3)]
    want = sorted(map(tuple, nested_fields(df, "j").collect()))
    for order in permutations(parts):
        assert sorted(map(tuple, merged_fields(order).select("path", "type", "n").collect())) == want
    conflicts = {r["path"]: r["types"] for r in type_conflicts(nested_fields(df, "j")).collect()}
    assert conflicts["$.a"] == ["array", "integer", "number", "string"] and "$.b[]" in conflicts and "$.d.e" not in conflicts
    assert nested_fields(df.where("false"), "j").count() == 0


def test_counts_combine_before_the_shuffle(spark, sf):
    text = merged_fields([spark.createDataFrame([("a", "b", 1)], "path string, type string, n long")])
    assert "partial_sum" in text._jdf.queryExecution().executedPlan().toString()


def test_a_batch_makes_two_counters_a_value(spark):
    """Five counters a value, each with the names of its column and kind, were hashed; cells hold what rows and registers need."""
    df = spark.createDataFrame(numbers(3, 500), SCHEMA)
    rows = []
    keep = sketches_module.stored
    try:
        sketches_module.stored = lambda counted, label: rows.append(counted) or keep(counted, label)
        sketch_batch(df)
    finally:
        sketches_module.stored = keep
    counted = rows[0].select("_slot", "_count").collect()
    assert sum(r["_count"] for r in counted) == 3 * 500 + df.where("x IS NOT NULL").count() + df.where("`i.j` IS NOT NULL").count()
