"""N-gram Jaccard join by MinHash banding (operator 2).

Texts with the same set of word n-grams are one class; only one text of a class goes on. Bands of MinHash rows, their number
chosen for a target recall at the threshold, are shuffled by hash. The members of a bucket are compared by signature, block by
block, with a margin that no linked pair falls below in practice; what stays connected is verified on full n-gram sets, again
block by block. Tasks pass on the number of links of each text and enough links to connect what belongs together, never the
pairs of a group, so a group of thousands of near copies costs comparisons but no rows. Blocks are bounded in texts and in
n-grams, and buckets and groups of any size are cut into pairs of blocks: there is no cap on partners.

N-grams are ``n`` successive words, with A-Z lower-cased; a text of fewer words has one n-gram, all of them. Sets hold 64-bit
hashes of the n-grams.

Defined results: a null text, and one without words, has no n-gram and no link, and is a class of its own; rows with a null id
are returned with null class and no links; rows of one id with different texts are texts of their own; repeated rows are
copies; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from steward.llm.columns import aside, picked, quoted
from steward.llm.components import components
from steward.llm.runs import Forest, runs
from steward.session import stored

NGRAM = 5
THRESHOLD = 0.8
ROWS = 5
RECALL = 0.9999
#: Share of equal signature rows from which a pair is verified: five standard deviations below the threshold.
AGREEMENT = 0.6
#: Bounds of a block: texts, and n-grams.
BLOCK_TEXTS = 256
BLOCK_NGRAMS = 200_000
#: Signatures compared at once in a bucket.
BUCKET_BLOCK = 512
CACHED_WORDS = 150_000
SEED = 20_240_501


def band_count(threshold: float, rows: int, recall: float) -> int:
    """Bands needed for a pair at ``threshold`` to meet in one of them with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


_HASHES: dict[bytes, int] = {}


def _word_hash(word: bytes) -> int:
    if len(_HASHES) >= CACHED_WORDS:
        _HASHES.clear()
    h = _HASHES[word] = xxhash.xxh64_intdigest(word)
    return h


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_set(text: str | None, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = _HASHES.get
    hashes = np.array([known(w) or _word_hash(w) for w in words], dtype=np.uint64)
    width = min(n, len(hashes))
    grams = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for i in range(width):
        grams = _mixed(grams + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(grams)


@functools.cache
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    odd = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd[:, None], draw.integers(0, 1 << 63, count, dtype=np.uint64)[:, None]


def signature(grams: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of 32 bits, worked out over blocks of n-grams."""
    times, plus = _permutations(count)
    least = np.full(count, 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(grams), 2048):
        np.minimum(least, ((times * grams[None, at : at + 2048] + plus) >> np.uint64(32)).min(axis=1), out=least)
    return least.astype(np.uint32)


SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.StringType()), T.StructField("row", T.LongType()),
        T.StructField("class", T.BinaryType()), T.StructField("ngrams", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType()),
    ]
)


def signatures(rows: DataFrame, n: int, bands: int, band_rows: int) -> DataFrame:
    """Per row of ``rows(doc_id, text, text_key, row)``: fingerprint of the n-gram set, band hashes, and a byte of each MinHash
    value. All are null for texts without words."""
    schema = to_arrow_schema(SIGNED)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = _mixed(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            out = []
            for doc, key, row, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "text_key", "row", "text")), strict=True):
                grams = ngram_set(text, n)
                if not len(grams):
                    out.append((doc, key, row, None, 0, None, None))
                    continue
                values = signature(grams, bands * band_rows)
                hashed = salts.copy()
                for column in values.reshape(bands, band_rows).T:
                    hashed = _mixed(hashed + column)
                print_ = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                out.append((doc, key, row, print_, len(grams), hashed.view(np.int64), values.astype(np.uint8).tobytes()))
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)

    return rows.mapInArrow(sign, SIGNED)


def _in_block_pairs(members: DataFrame, node: str, blocks: str) -> DataFrame:
    """``members`` once for each pair of blocks that its own is part of, as ``low``, ``high`` and ``own``."""
    own = F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int"))))
    return dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", blocks)


EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def candidate_edges(classes: DataFrame, agreement: float = AGREEMENT) -> DataFrame:
    """Edges that connect the classes of a bucket whose signatures agree; for ``k`` connected ones, ``k - 1`` edges.

    ``classes`` has ``node``, ``bands`` and ``signature``.
    """
    keyed = classes.select("node", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = keyed.join(shared, "band").withColumn("blocks", F.ceil(F.col("n") / BUCKET_BLOCK)).drop("n")
    paired = _in_block_pairs(members.join(classes.select("node", "signature"), "node"), "node", "blocks")
    keys = ["band", "low", "high"]
    ordered = paired.select(*keys, "own", "node", "signature").repartition(*keys).sortWithinPartitions(*keys)

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in runs(batches, keys):
            nodes = table["node"].to_numpy()
            signed = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
            a, b = [], []
            for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                part = signed[start:end]
                if end - start < 2:
                    continue
                least = math.ceil(agreement * part.shape[1])
                forest = Forest(end - start)
                for i in range(end - start - 1):
                    for j in np.flatnonzero((part[i + 1 :] == part[i]).sum(axis=1) >= least).tolist():
                        forest.join(i, i + 1 + j)
                for i in range(end - start):
                    if forest.root(i) != i:
                        a.append(nodes[start + i])
                        b.append(nodes[start + forest.root(i)])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], EDGE.names)

    return ordered.mapInArrow(connect, EDGE)


LINKED = T.StructType(
    [T.StructField("node", T.LongType()), T.StructField("links", T.LongType()), T.StructField("joined_to", T.LongType())]
)


def _links(sets: list[np.ndarray], copies: np.ndarray, sides: np.ndarray, across: bool, threshold: float) -> tuple[np.ndarray, Forest]:
    """Linked documents of each text of a block pair, and what is connected. ``sides`` tell the blocks apart; ``across`` says
    that they are different ones, whose inner pairs are left to the tasks of each block with itself."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, numbered = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    here = np.zeros(int(numbered.max()) + 1, dtype=np.int8)
    share = round(threshold * 1_000_000)
    links, forest = np.zeros(len(sets), dtype=np.int64), Forest(len(sets))
    for i in range(len(sets) - 1):
        own = numbered[starts[i] : starts[i + 1]]
        here[own] = 1
        common = np.add.reduceat(here[numbered[starts[i + 1] :]], starts[i + 1 : -1] - starts[i + 1], dtype=np.int64)
        here[own] = 0
        linked = common * 1_000_000 >= share * (sizes[i] + sizes[i + 1 :] - common)
        if across:
            linked &= sides[i + 1 :] != sides[i]
        found = np.flatnonzero(linked) + i + 1
        links[i] += copies[found].sum()
        links[found] += copies[i]
        for j in found.tolist():
            forest.join(i, j)
    return links, forest


def verified_links(texts: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """``(node, links, joined_to)``: documents linked to each text as counted by one block pair, and a text it is connected to.

    ``texts`` has ``root`` (the group), ``low, high, own`` (its block pair and own block), ``node``, ``copies`` and ``text``.
    """
    keys = ["root", "low", "high"]
    ordered = texts.select(*keys, "own", "node", "copies", "text").repartition(*keys).sortWithinPartitions(*keys, "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in runs(batches, keys):
            out = []
            for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                part = table.slice(start, end - start)
                nodes, first = np.unique(part["node"].to_numpy(), return_index=True)  # rows with one key are one text
                if len(nodes) < 2:
                    continue
                part = part.take(first)
                sets = [ngram_set(t, n) for t in part["text"].to_pylist()]
                across = part["low"][0].as_py() != part["high"][0].as_py()
                links, forest = _links(sets, part["copies"].to_numpy(), part["own"].to_numpy(), across, threshold)
                for i in np.flatnonzero(links).tolist():
                    root = forest.root(i)
                    out.append((int(nodes[i]), int(links[i]), int(nodes[root]) if root != i else None))
            columns = zip(*out, strict=True) if out else ([], [], [])
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], LINKED.names)

    return ordered.mapInArrow(verify, LINKED)


def _classified(docs: DataFrame, doc_id: str, text: str, n: int = NGRAM, threshold: float = THRESHOLD, band_rows: int = ROWS,
                recall: float = RECALL) -> DataFrame:
    """``doc_id, text_key, root, class_id, same_set_id, n_links`` of every row; ``root`` names the class, and is null for rows
    that can have no link."""
    rows = picked(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    numbered = rows.withColumns({"text_key": text_key("doc_id", "text"), "row": F.monotonically_increasing_id()})
    signed = stored(signatures(numbered, n, band_count(threshold, band_rows, recall), band_rows), "signatures")
    linkable = F.col("class").isNotNull() & F.col("doc_id").isNotNull()

    # A class is named by the row of its least document. Copies meet by partial aggregation, not in one task.
    chosen = F.min(F.struct("doc_id", "row", "text_key", "ngrams", "bands", "signature"))
    classes = stored(
        signed.filter(linkable).groupBy("class").agg(chosen.alias("c"), F.count("*").alias("copies"))
        .select("class", "copies", F.col("c.row").alias("node"), "c.doc_id", "c.text_key", "c.ngrams", "c.bands", "c.signature"),
        "classes",
    )
    groups = stored(components(candidate_edges(classes)), "candidate-groups")
    members = groups.join(classes.select("node", "text_key", "ngrams", "copies"), "node")
    blocks = members.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("ngrams") / BLOCK_NGRAMS)).alias("blocks")
    )
    # Repeated rows share a key: one text of each, chosen by partial aggregation, goes on.
    keyed = rows.select(text_key("doc_id", "text").alias("text_key"), "text")
    texts = keyed.join(members.select("text_key"), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    held = members.drop("ngrams").join(texts, "text_key").join(blocks, "root")
    links = stored(verified_links(_in_block_pairs(held, "node", "blocks"), n, threshold), "links")

    joined = components(links.filter("joined_to IS NOT NULL").select(F.col("node").alias("a"), F.col("joined_to").alias("b")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    placed = classes.select("class", "node", "doc_id", "copies").join(joined, "node", "left").join(counted, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = placed.join(least, "root").select(
        "class", "root", "class_id", F.col("doc_id").alias("same_set_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    alone = signed.filter(~linkable).select(
        "doc_id", "text_key", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("class_id"),
        F.col("doc_id").alias("same_set_id"), F.lit(0).cast("long").alias("n_links"),
    )
    found = signed.filter(linkable).select("doc_id", "text_key", "class").join(named, "class").drop("class")
    return found.unionByName(alone)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, class_id, same_set_id, n_links``.

    ``class_id`` is the least id of all documents connected by links, ``same_set_id`` the least of those with the same n-gram
    set, ``n_links`` the number of other documents at the threshold or above. ``text_key`` is :func:`text_key` of the row.
    Settings are ``n`` words, ``threshold``, ``band_rows`` and ``recall``.
    """
    return _classified(docs, doc_id, text, **settings).drop("root")


def text_key(doc_id: str, text: str):
    """What tells the rows of a table apart: 128 bits of id and text, as text, equal for rows of one id and text only."""
    i, t = quoted(doc_id).cast("long"), quoted(text)
    return F.concat_ws(":", F.hex(F.xxhash64(i, t)), F.hex(F.xxhash64(F.lit("second"), t, i)))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id, and of its rows one. Documents without words, and
    rows without an id, stay, but of rows of one id (or none) and the same text, only one."""
    found = _classified(docs, doc_id, text, **settings).filter("root IS NOT NULL")
    named = stored(found.select("doc_id", "text_key", "root").distinct(), "classes-found")
    kept = named.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("k")).select("k.text_key")
    gone = named.select("text_key").join(kept, "text_key", "left_anti")
    (key,) = aside(docs.columns, "_text_key")
    keyed = docs.withColumn(key, text_key(doc_id, text))
    left = keyed.join(gone.select(F.col("text_key").alias(key)), key, "left_anti")
    return left.dropDuplicates([key]).drop(key)
