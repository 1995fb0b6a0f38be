"""Exact quantiles against Spark's own, on odd values, and without an aggregate that keeps all values of a column."""

import math
import random

import pytest
from pyspark.sql import functions as F

from bindings import summarizing
from steward.operators import quantiles
from steward.operators.quantiles import exact_quantiles

SHARES = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def rows(seed=4, n=3000):
    rng = random.Random(seed)
    odd = [None, 0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 1.7e308, -1.7e308]
    wide = lambda: rng.choice(odd) if rng.random() < 0.1 else rng.lognormvariate(0, 20) * rng.choice([1, -1])
    return [(wide(), rng.randrange(10**6) + 10**9, rng.choice([1, 1, 1, 2, None]), 7.5, None) for _ in range(n)]


@pytest.mark.parametrize("fine", [4096, 2])
def test_quantiles_equal_percentile_disc(spark, monkeypatch, fine):
    monkeypatch.setattr(quantiles, "FINE", fine)
    df = spark.createDataFrame(rows(), "a double, `n.b` long, c int, d double, e double").repartition(5)
    names = df.columns
    asked = [F.expr(f"CAST(percentile_disc({s}) WITHIN GROUP (ORDER BY `{c}`) AS DOUBLE)") for c in names for s in SHARES]
    want = dict(zip([(c, s) for c in names for s in SHARES], df.agg(*asked).first()))
    got = {(r["column"], r["share"]): r["value"] for r in exact_quantiles(df, names, SHARES).collect()}
    assert got.keys() == {k for k, v in want.items() if v is not None} and len(got) == 4 * len(SHARES)
    assert all(v == want[k] or (math.isnan(v) and math.isnan(want[k])) for k, v in got.items())
    assert exact_quantiles(df.where("false"), names, SHARES).count() == 0


def test_the_query_keeps_no_column_in_one_aggregate(spark, sf, monkeypatch):
    """K1b's exact quantiles were aggregates that hold every different value of a column, all in one task."""
    monkeypatch.setattr(summarizing, "_stored_sketches", lambda spark, sf: spark.createDataFrame([], summarizing.sketches.SKETCH))
    text = summarizing.k1b(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in text.lower()
