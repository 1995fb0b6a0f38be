import math

import pytest
from pyspark.sql import functions as F

from steward.llm import topk
from steward.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank int, v string, block int"


def top(df, k=5):
    return top_k(df, F.col("vec_id") % 5 == 0, k)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "v", 4) for i, v in rows], SCHEMA)


def brute(rows, k):
    import numpy as np

    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(ints):
        if q % 5:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for other, (c, b) in enumerate(ints) if other != at)
        out += [(q, r, c, -s) for r, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def odd_rows(n=300, dims=8):
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=dims).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(40)]  # copies: ties
    rows += [(n + 100, None), (n + 105, [1.0, None]), (n + 110, [float("nan")] * dims), (n + 115, [float("inf")] * dims)]
    rows += [(n + 120, []), (n + 125, [0.5, 0.5]), (n + 130, [0.1] * (dims + 2)), (None, [1.0] * dims)]
    return rows


@pytest.mark.parametrize("blocks", [(4096, 1024), (50, 16)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", blocks[1])
    rows = odd_rows()
    got = sorted(map(tuple, top(vectors(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == brute(rows, 5)


def test_repeated_rows_and_few_candidates(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, -1.0])]
    got = sorted(map(tuple, top(vectors(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == brute(rows, 5) and len(got) == 4


def test_empty_and_too_large(spark):
    assert top(vectors(spark, [])).count() == 0
    assert top(vectors(spark, [(0, None)])).count() == 0
    with pytest.raises(ValueError):
        top(vectors(spark, [(0, [1e9]), (1, [1.0])]))
