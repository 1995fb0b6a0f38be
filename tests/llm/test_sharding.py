import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from steward.llm.sharding import Node, even_tree, grown_tree, shard_documents, shard_of, with_shards
from tests.llm.rows import DOCS, documents

TREE = even_tree(16, regions=2, racks=2)


def shards(spark, tree, n=4000):
    return {r["id"]: r["s"] for r in spark.range(n).select("id", shard_of(F.col("id"), tree).alias("s")).collect()}


def test_sizes_checksums_and_slots(spark, odd_documents):
    got = shard_documents(odd_documents, TREE, grown_tree(TREE, 16)).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in DOCS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {r["law"] for r in got} == {"key"}


def test_growth_moves_rows_into_the_new_shard_only(spark):
    before, after = shards(spark, TREE), shards(spark, grown_tree(TREE, 16))
    moved = [i for i in before if before[i] != after[i]]
    assert {after[i] for i in moved} == {16} and 150 < len(moved) < 330  # one seventeenth of 4000 is 235


def test_shares_follow_weights(spark):
    tree = Node("root", (Node("a", shard=0, leaf_weight=3.0), Node("b", shard=1, leaf_weight=1.0), Node("c", shard=2, leaf_weight=0.0)))
    n = Counter(shards(spark, tree).values())
    assert n[2] == 0 and 2850 < n[0] < 3150


def test_a_changed_weight_moves_nothing_between_other_subtrees(spark):
    heavier = Node("root", (TREE.children[0], _scaled(TREE.children[1], 3.0)))
    before, after = shards(spark, TREE), shards(spark, heavier)
    left = {s.shard for rack in TREE.children[0].children for s in rack.children}
    for i in before:
        if before[i] != after[i]:
            assert before[i] in left and after[i] not in left


def _scaled(node, by):
    kids = tuple(_scaled(c, by) for c in node.children)
    return Node(node.name, kids, node.shard, node.leaf_weight * by)


def test_all_columns_stay_and_empty_tables_pass(spark, odd_documents):
    assert set(with_shards(odd_documents, "doc_id", TREE).columns) == set(odd_documents.columns)
    assert shard_documents(documents(spark, []), TREE, grown_tree(TREE, 16)).count() == 0


def test_no_positive_weight_is_refused():
    with pytest.raises(ValueError):
        shard_of(None, Node("root", (Node("a", shard=0, leaf_weight=0.0),)))


def drawn(key, tree):
    """The descent by a plain hash: every child waits an exponential time, the shortest wins."""
    while tree.children:
        start = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
        waits = []
        for i, child in enumerate(tree.children):
            bits = xxhash.xxh64_intdigest(child.name.encode(), seed=start) & ((1 << 53) - 1)
            waits.append((-math.log((bits + 0.5) / (1 << 53)) / child.weight if child.weight else math.inf, i))
        tree = tree.children[min(waits)[1]]
    return tree.shard


def test_the_draw_equals_an_independent_one(spark):
    uneven = Node("root", (TREE.children[0], _scaled(TREE.children[1], 2.5), Node("x", (Node("x/y", (Node("x/y/z", shard=99, leaf_weight=0.7),)),))))
    for tree in (TREE, grown_tree(TREE, 16), uneven):
        assert shards(spark, tree, 2000) == {i: drawn(i, tree) for i in range(2000)}
    null = spark.range(1).select(shard_of(F.lit(None).cast("long"), uneven)).first()[0]
    assert null == drawn(None, uneven)
