"""The training-data pipeline: five stages over ``documents``, each calling one operator of ``steward.llm``.

A stage takes ``(spark, docs, sf_dir)``, where ``docs`` are the rows that the stage before kept, and returns a DataFrame. All
but the last return the columns of ``documents``; the last returns the packed pieces. The classifier learns from the labelled
rows of ``documents`` as they came, since the rules have by then removed most of what a label could call bad.

Defined results, for each stage on what it is given: null, empty and wordless texts fail the rules (fewer than 50 words), score one
half and so pass the classifier, are no near duplicates, hold no personal data, and are packed as their end token; a null id, language or
source is a value like any other, but rows without id are no near duplicates of others; of repeated rows one stays after near
duplicates, and the stages before keep or reject them alike; ties are settled as the operators say; very long texts are read whole;
columns beside those of ``documents`` are carried through the first four stages whatever their names; empty tables give an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steward.llm.classifier import fit, keep_predicted
from steward.llm.near_duplicates import keep_one
from steward.llm.packing import pack_documents
from steward.llm.pii import sanitised
from steward.llm.quality_rules import keep_good
from steward.llm.workers import share_package
from steward.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive fences keep; null and empty texts go."""
    return keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that labelled neighbours vote good; without labels, or far from all of them, a document stays."""
    share_package(spark)
    root = sf_dir.rstrip("/")
    learned = fit(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet"), "quality")
    return keep_predicted(docs, learned)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the least id; rows without id or words stay."""
    share_package(spark)
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and ``n_chars`` counted anew; a null text stays null, as does its count."""
    share_package(spark)
    return sanitised(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; a null or empty text is one piece, its end."""
    share_package(spark)
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Classifier, signatures and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
