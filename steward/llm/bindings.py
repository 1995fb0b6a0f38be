"""The operators of this package on the driver's tables: a query each, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from steward.llm import sql
from steward.llm.workers import share_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register the decorated ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op9_quality_rules", sql.QUALITY_RULES)
def op9_quality_rules(spark, sf_dir):
    """Counts of every whole text, the base rules, and the verdict by adaptive fences."""
    from steward.llm.quality_rules import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op4_sharding")
def op4_sharding(spark, sf_dir):
    """All documents in 16 shards of 2 regions with 2 racks each; the grown tree has one more, in a region of its own."""
    from steward.llm.sharding import even_tree, grown_tree, shard_documents

    tree = even_tree(16, regions=2, racks=2)
    return shard_documents(table(spark, sf_dir, "documents"), tree, grown_tree(tree, 16))


#: The rules that the contract of operator 10 names.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


@query("op10_url_filters", sql.URL_FILTERS)
def op10_url_filters(spark, sf_dir):
    """Every page's host, path, rule and verdict."""
    from steward.llm.url_filters import judge_urls, rule

    rules = [rule(verdict, text) for verdict, text in URL_RULES]
    return judge_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op5_packing")
def op5_packing(spark, sf_dir):
    """Every document's pieces with their places in sequences of at most 1024 tokens."""
    from steward.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


@query("op7_top_k", sql.TOP_K)
def op7_top_k(spark, sf_dir):
    """The five best other rows for each vector whose id is divisible by 50."""
    from pyspark.sql import functions as F

    from steward.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def crc_remainder(column, n: int):
    """CRC-32 of an id as text, modulo ``n``: how the contracts hold rows out."""
    from pyspark.sql import functions as F

    return F.crc32(column.cast("string").cast("binary")) % n


@query("op3_lm_score")
def op3_lm_score(spark, sf_dir):
    """Every whole text scored by what the rows with remainder other than 1 teach."""
    from pyspark.sql import functions as F

    from steward.llm.lm_score import score_texts

    return score_texts(table(spark, sf_dir, "documents"), crc_remainder(F.col("doc_id"), 5) == 1)


@query("op6_segment")
def op6_segment(spark, sf_dir):
    """The three best segmentations of every whole text; the best is decoded again, its checksum being that of the text."""
    from pyspark.sql import functions as F

    from steward.llm.segment import segment_texts

    return segment_texts(table(spark, sf_dir, "documents"), n=3).select(
        "doc_id", "rank", "score",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        "decoded_crc32",
    )


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    """Every whole text scored by labelled neighbours; rows with remainder 0 are held out of learning."""
    from pyspark.sql import functions as F

    from steward.llm.classifier import quality_scores

    learn = crc_remainder(F.col("doc_id"), 5) != 0
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn)
    return scored.withColumn("held_out", F.coalesce(crc_remainder(F.col("doc_id"), 5) == 0, F.lit(False)))


@query("op8_pii")
def op8_pii(spark, sf_dir):
    """Personal data of every whole text by pattern, and the terms that reveal it."""
    from pyspark.sql import functions as F

    from steward.llm.pii import KINDS, TERM, personal_data

    found = personal_data(table(spark, sf_dir, "documents"))
    added = F.transform("terms", lambda t: F.concat(F.lit(TERM), F.lit(":"), t["start"], F.lit(":"), t["end"]))
    base = F.when(F.col("base_spans") != "", F.array("base_spans")).otherwise(F.array().cast("array<string>"))
    return found.select(
        "doc_id", *[f"n_{kind}" for kind in KINDS],
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, F.coalesce(added, F.array().cast("array<string>"))), ",").alias("spans"),
    )


@query("op2_near_duplicates", sql.NEAR_DUPLICATES)
def op2_near_duplicates(spark, sf_dir):
    """Every document with its class of near duplicates and its number of links."""
    from steward.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def with_planted_run(doc, words: list[bytes]) -> list[bytes]:
    """The contract of operator 11 makes the tail of every tenth document by hash periodic."""
    import zlib

    n, h = len(words), zlib.crc32(str(doc).encode())
    if doc is None or not n or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *[words[a + i % p] for i in range(n - a)]]


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    """Every whole text's periodic runs, the one of most periods, and what is left without repeats."""
    from pyspark.sql import functions as F

    from steward.llm.periodic_runs import periodic_runs

    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=with_planted_run)
    # The first of several with equal exponents stays: runs come by start, then period.
    more = lambda r, best: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)), lambda best, r: F.when(more(r, best), r).otherwise(best)
    )
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    """Every vector on the 16 largest principal components of the distinct ones, at unit variance."""
    from pyspark.sql import functions as F

    from steward.llm.whitening import whiten

    rows, fitted, error = whiten(table(spark, sf_dir, "embeddings"), components=16)
    shares = F.array(*[F.lit(float(s)) for s in fitted.explained]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"), "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


@query("op13_chat_format")
def op13_chat_format(spark, sf_dir):
    """All conversations, and one whose texts look like marks, formatted, encoded and read back."""
    from steward.llm.chat_format import digests, format_conversations

    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    looks = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", looks), (-7, 1, "assistant", looks)], given.schema)
    return digests(format_conversations(given.unionByName(planted)))
