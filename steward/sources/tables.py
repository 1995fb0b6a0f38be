"""Stored tables, databases and SQL text as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from steward.sources.files import check_database


def extract_table(spark: SparkSession, name: str, namespace: str | None = None) -> DataFrame:
    """All rows of a catalog table."""
    return spark.table(f"{namespace}.{name}" if namespace else name)


def bound_query(spark: SparkSession, text: str, **values: Any) -> DataFrame:
    """A query with ``:name`` markers bound to ``values`` (S6). Values are never pasted into the text."""
    return spark.sql(text, args=values)


def run_statements(spark: SparkSession, statements: Iterable[str]) -> list[DataFrame]:
    """Run a script, given as a list of statements, and return one DataFrame per statement."""
    return [spark.sql(statement) for statement in statements]


def run_statement_files(spark: SparkSession, paths: Iterable[str]) -> list[DataFrame]:
    """Run files that hold one statement each (S14). A path that does not exist is an error."""
    texts = []
    for path in paths:
        with open(path, encoding="utf-8") as file:
            texts.append(file.read().strip().rstrip(";"))
    return run_statements(spark, texts)


@dataclass(frozen=True)
class Database:
    """Where a database is and how to log in (S13). Without a choice the staging host and the test database are used."""

    hosts: Mapping[str, str]
    databases: Mapping[str, str]
    user: str
    password: str = field(repr=False)
    port: int = 5432
    kind: str = "postgres"

    def options(self, host: str = "STAGING", database: str = "TEST") -> dict[str, str]:
        """Options for Spark's JDBC reader and writer."""
        check_database(self.kind)
        return {
            "url": f"jdbc:postgresql://{self.hosts[host]}:{self.port}/{self.databases[database]}",
            "driver": "org.postgresql.Driver",
            "user": self.user,
            "password": self.password,
        }


def read_database(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    split_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """All rows of a database table.

    With ``split_column`` and the ``bounds`` of its values the table is read by ``partitions`` connections at once;
    rows outside the bounds are read too, by the first and the last one.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table).option("fetchsize", fetch_size)
    if split_column is not None:
        if bounds is None or partitions < 2:
            raise ValueError("a split column needs its bounds and at least two partitions")
        reader = reader.options(
            partitionColumn=split_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def write_database(
    df: DataFrame, options: Mapping[str, str], table: str, connections: int = 8, batch_size: int = 10_000
) -> None:
    """Append rows to a database table, in batches and over at most ``connections`` connections.

    A task that is retried writes its rows again, as with any JDBC sink; give the table a key if that matters.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .mode("append")
        .save()
    )
