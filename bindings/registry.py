"""Where the driver's queries are declared: a name, a Spark callable and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is declared twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


_OPENED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, opened once per application: opening reads the schema from a file footer, which is a job of its own."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _OPENED:
        _OPENED[key] = spark.read.parquet(path)
    return _OPENED[key]
