"""Hierarchical weighted hash tree (operator 4): keys descend region, rack and shard levels by weighted hash draws.

At each node every child draws an exponential waiting time from the hash of the key and the child's name, divided by the
child's weight; the shortest wins. A child is therefore chosen in proportion to its weight, and when one child's weight
changes, keys only move into it (if it grows) or out of it (if it shrinks): no key moves between its siblings, and nothing
below a node whose weight and children stay moves at all. The law is ``key``: the key and the tree decide, no other row.

Defined results: a null key is hashed as such and goes to one shard; repeated rows go to the same shard, in slots of their
own; children that draw the same time are taken in their order; a null text has size 1 and the checksum of the empty text; very
long texts are sized whole; other columns are kept apart by name or not read; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from steward.llm.columns import picked, quoted
from steward.session import stored


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``shard`` is set on leaves only; the weight of an inner node is the sum of its leaves'."""

    name: str
    children: tuple[Node, ...] = field(default=())
    shard: int | None = None
    leaf_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.leaf_weight


def even_tree(shards: int, regions: int, racks: int) -> Node:
    """``shards`` numbered leaves of weight 1, dealt in runs over ``regions`` regions of ``racks`` racks each."""
    per_rack = -(-shards // (regions * racks))
    runs = [list(range(i, min(i + per_rack, shards))) for i in range(0, shards, per_rack)]
    held = [runs[i : i + racks] for i in range(0, len(runs), racks)]
    return Node(
        "root",
        tuple(
            Node(
                f"region{r}",
                tuple(
                    Node(f"region{r}/rack{k}", tuple(Node(f"region{r}/rack{k}/shard{s}", shard=s) for s in run))
                    for k, run in enumerate(racks_of)
                ),
            )
            for r, racks_of in enumerate(held)
        ),
    )


def grown_tree(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """``tree`` with one more shard in a rack and region of its own. Since it is the only new child of the root, rows move
    into the new shard and nowhere else; a shard added to an old rack would draw rows from other racks into its siblings."""
    region = f"region{len(tree.children)}"
    leaf = Node(f"{region}/rack0/shard{shard}", shard=shard, leaf_weight=weight)
    return Node(tree.name, (*tree.children, Node(region, (Node(f"{region}/rack0", (leaf,)),))))


def _waiting_time(key: Column, child: Node) -> Column:
    low_bits = F.xxhash64(key, F.lit(child.name)).bitwiseAND(F.lit((1 << 53) - 1))
    uniform = (low_bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(uniform) / F.lit(child.weight)


def shard_of(key: Column, tree: Node) -> Column:
    """The number of the leaf that ``key`` descends to. Children of weight 0 get nothing."""
    if not tree.children:
        return F.lit(tree.shard)
    open_children = [c for c in tree.children if c.weight > 0]
    if not open_children:
        raise ValueError(f"{tree.name} has no child of positive weight")
    if len(open_children) == 1:
        return shard_of(key, open_children[0])
    draws = [F.struct(_waiting_time(key, c).alias("wait"), F.lit(i).alias("child")) for i, c in enumerate(open_children)]
    chosen = F.array_min(F.array(*draws))["child"]
    if all(c.shard is not None for c in open_children):
        return F.get(F.array(*[F.lit(c.shard) for c in open_children]), chosen)
    return F.coalesce(*[F.when(chosen == i, shard_of(key, c)) for i, c in enumerate(open_children)])


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus 1."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def text_crc32(text: Column) -> Column:
    """CRC-32 of a text's UTF-8 bytes, unsigned."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def gapless(df: DataFrame, group: str, order: list[str], chunk: str, slot: str = "slot") -> DataFrame:
    """``df`` with ``slot`` counting the rows of each ``group`` from 0, by ``chunk`` and then ``order``.

    Rows are numbered within (group, chunk), so no task holds a whole group; what came before is added from a table of one
    row per group and chunk.
    """
    per_chunk = df.groupBy(group, chunk).agg(F.count("*").alias("_rows"))
    before = F.coalesce(
        F.sum("_rows").over(Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = per_chunk.select(group, chunk, before.alias("_before"))
    local = F.row_number().over(Window.partitionBy(group, chunk).orderBy(*order)) - 1
    return (
        df.withColumn("_local", local)
        .join(starts, [group, chunk])
        .withColumn(slot, (F.col("_before") + F.col("_local")).cast("long"))
        .drop("_before", "_local")
    )


def with_shards(df: DataFrame, key: str, tree: Node, shard: str = "shard") -> DataFrame:
    """``df`` with the shard each row's ``key`` descends to: one projection, no shuffle."""
    return df.withColumn(shard, shard_of(quoted(key), tree).cast("int"))


def write_shards(df: DataFrame, key: str, tree: Node, path: str, shard: str = "shard") -> None:
    """Write ``df`` as Parquet with a folder per shard. Tasks write the shards of what they read; nothing is gathered."""
    with_shards(df, key, tree, shard).write.partitionBy(shard).parquet(path)


def shard_documents(docs: DataFrame, tree: Node, grown: Node, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The narrow rows are stored with the number of the partition they were read in; slots are counted per partition.
    """
    rows = picked(docs, doc_id=doc_id, text=text).select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree).cast("int").alias("shard"),
        shard_of(F.col("doc_id"), grown).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("chunk"),
    )
    return gapless(stored(rows, "shards"), "shard", ["doc_id", "text_crc32", "size"], "chunk").drop("chunk")
