"""Exact top-k search by inner product in three phases under a uniform threshold (operator 7).

Candidates and queries are dealt into blocks; a task holds one block of either. Phase one gathers, for each query, a short
list of the best approximate scores of each block, together at least ``k``. The k-th best of the lists, less the error bound
of the approximation, is a safe cutoff: ``k`` candidates score as much. Phase two broadcasts each query's cutoff to its
blocks, which collect all entries that may reach it. Phase three resolves the collected entries with integer arithmetic in
the task that holds both vectors, and ranks them.

A block passes on no more than its best ``k`` resolved entries of a query, which loses nothing, so that thousands of copies
of one vector cost no more than ``k`` rows a block. Query blocks times candidate blocks is the work that exactness needs;
no task holds more than a block of either, and nothing comes to the driver but counts.

Defined results: rows without an id, and vectors that are null or hold null or non-finite components, take no part; shorter vectors are continued
with zeros; ties go to the smaller id; a repeated row is a candidate for its copies, and a query of its own; with fewer
candidates than ``k`` all are returned; an empty table gives an empty result. Components beyond 2**27 after scaling are
refused, since their products could exceed a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from steward.llm.columns import picked
from steward.session import stored

CANDIDATES_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
LARGEST = 1 << 27


def scaled(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, or null where the vector takes no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(scale * x.cast("double"))))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, continued with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _approximate(queries: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single-precision scores, and for each query a bound of their error: rounding of products and of their sums."""
    scores = queries.astype(np.float32) @ vectors.astype(np.float32).T
    longest = np.sqrt((vectors.astype(np.float64) ** 2).sum(1).max(initial=0.0))
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    return scores, lengths * longest * (queries.shape[1] + 4) * float(np.finfo(np.float32).eps)


ENTRY = T.StructType(
    [
        T.StructField("query_row", T.LongType()), T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
        T.StructField("vec_row", T.LongType()), T.StructField("score", T.LongType()),
    ]
)
LISTED = T.StructType([T.StructField("query_row", T.LongType()), T.StructField("at_least", T.DoubleType())])


def _phase(queries: DataFrame, vectors: DataFrame, blocks: tuple[int, int], task, schema: T.StructType) -> DataFrame:
    """Run ``task`` on every pair of a query block and a vector block."""
    query_blocks, vector_blocks = blocks
    pairs_of_vectors = vectors.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    pairs_of_queries = queries.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1))))
    left = pairs_of_queries.withColumns({"q": F.col("block"), "c": F.col("with")}).drop("block", "with").groupBy("q", "c")
    right = pairs_of_vectors.withColumns({"q": F.col("with"), "c": F.col("block")}).drop("block", "with").groupBy("q", "c")
    return left.cogroup(right).applyInArrow(task, schema)


def top_k(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row with ``is_query`` (a condition on ``vec_id``), the ``k`` highest inner
    products with other rows."""
    rows = picked(vectors, vec_id=vec_id, embedding=embedding).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding"), scale).alias("v"), is_query.alias("is_query")
    )
    kept = stored(rows.filter("v IS NOT NULL AND vec_id IS NOT NULL").withColumn("vec_row", F.monotonically_increasing_id()), "vectors")
    facts = kept.agg(
        F.count("*").alias("n"), F.count_if("is_query").alias("queries"), F.max(F.size("v")).alias("width"),
        F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("largest"),
    ).first()
    if (facts["largest"] or 0) >= LARGEST:
        raise ValueError(f"a scaled component of {facts['largest']} may overflow a score; scale by less")
    width = facts["width"] or 0
    blocks = (max(1, -(-facts["queries"] // QUERIES_PER_BLOCK)), max(1, -(-facts["n"] // CANDIDATES_PER_BLOCK)))
    listed = max(1, -(-k // blocks[1]))

    def dealt(df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("block", F.pmod(F.xxhash64("vec_row"), F.lit(n)).cast("int"))

    candidates = dealt(kept.drop("is_query"), blocks[1])
    queries = dealt(kept.filter("is_query").drop("is_query"), blocks[0]).withColumnsRenamed(
        {"vec_id": "query_id", "vec_row": "query_row"}
    )

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_row": pa.array([], pa.int64()), "at_least": pa.array([], pa.float64())})
        scores, error = _approximate(_matrix(left["v"], width), _matrix(right["v"], width))
        own = left["query_row"].to_numpy()
        scores[own[:, None] == right["vec_row"].to_numpy()[None, :]] = -np.inf
        best = -np.partition(-scores, min(listed, scores.shape[1]) - 1, axis=1)[:, :listed]
        at_least = (best - error[:, None]).ravel()
        known = np.isfinite(at_least)
        return pa.table({"query_row": np.repeat(own, best.shape[1])[known], "at_least": at_least[known].astype(np.float64)})

    lists = _phase(queries, candidates, blocks, gather, LISTED)
    best_first = Window.partitionBy("query_row").orderBy(F.desc("at_least"))
    # The k-th best of the lists; a query whose lists are shorter has no cutoff and collects all of its few candidates.
    cutoffs = lists.withColumn("r", F.row_number().over(best_first)).filter(F.col("r") <= k)
    cutoffs = cutoffs.groupBy("query_row").agg(F.when(F.count("*") == k, F.min("at_least")).alias("cutoff"))
    told = stored(queries.join(cutoffs, "query_row", "left"), "cutoffs")

    def collect(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[] for _ in ENTRY.names]
        if left.num_rows and right.num_rows:
            exact_queries, exact_vectors = _matrix(left["v"], width), _matrix(right["v"], width)
            scores, error = _approximate(exact_queries, exact_vectors)
            own, ids = left["query_row"].to_numpy(), left["query_id"].to_pylist()
            rows_, vec_ids = right["vec_row"].to_numpy(), right["vec_id"].to_numpy(zero_copy_only=False)
            floor = np.array([-np.inf if c is None else c for c in left["cutoff"].to_pylist()])
            for i, enough in enumerate(scores >= (floor - error)[:, None]):
                entries = np.flatnonzero(enough & (rows_ != own[i]))
                resolved = exact_vectors[entries] @ exact_queries[i]
                best = np.lexsort((vec_ids[entries], -resolved))[:k]
                entries = entries[best]
                for held, values in zip(columns, (own[i], ids[i], vec_ids[entries], rows_[entries], resolved[best]), strict=True):
                    held.append(np.broadcast_to(values, len(entries)))
        flat = [np.concatenate(c) if c else np.array([], np.int64) for c in columns]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(ENTRY.names, flat, strict=True)})

    entries = _phase(told, candidates, blocks, collect, ENTRY)
    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("vec_row"))
    top = entries.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
