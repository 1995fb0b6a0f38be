"""Scenario registry and runner (G8): generate, write, load into declared tables, analyse."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steward.operators import analytics
from steward.plans import generate
from steward.sources import schemas
from steward.sources.sinks import AppendReport, load_csv, write_csv


@dataclass(frozen=True)
class Scenario:
    """A generator, the tables it fills, and the reports over them."""

    generate: Callable[..., dict[str, DataFrame]]
    tables: Mapping[str, schemas.TableSpec]
    reports: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]]


def _counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return analytics.row_counts({f"{name.capitalize()} count:": df for name, df in tables.items()})


def _volume(account_column: str) -> Callable[[Mapping[str, DataFrame]], DataFrame]:
    return lambda t: analytics.top_groups_by_volume(
        t["transactions"],
        t["accounts"],
        t["users"],
        tx_account=account_column,
        account_id="account_id",
        account_owner="user_id",
        owner_id="user_id",
        group="country",
        amount="amount",
    )


SCENARIOS: dict[str, Scenario] = {
    "fintech": Scenario(
        generate.fintech,
        schemas.FINTECH,
        {
            "row_counts": _counts,
            "top_countries": _volume("src_id"),
            "rapid_fire": lambda t: analytics.rapid_fire_in_frame(t["transactions"], "src_id", "ts", 10),
        },
    ),
    "fintech_v1": Scenario(
        generate.fintech_v1,
        schemas.FINTECH_V1,
        {
            "row_counts": _counts,
            "top_countries": _volume("src_account_id"),
            "rapid_fire_by_minute": lambda t: analytics.rapid_fire_by_bucket(
                t["transactions"], "src_account_id", "timestamp"
            ),
            "rapid_fire": lambda t: analytics.rapid_fire_in_frame(t["transactions"], "src_account_id", "timestamp", 10),
            "double_spend": lambda t: analytics.double_spend(
                t["transactions"], ["src_account_id", "dest_account_id", "amount"], "timestamp", "tx_id"
            ),
        },
    ),
    "nlp": Scenario(
        generate.reviews,
        schemas.REVIEWS,
        {
            "sentiment": lambda t: analytics.mean_by_group(t["reviews"], "category", "sentiment_score").orderBy(
                F.col("mean_value").desc_nulls_last()
            ),
            "sentiment_rank": lambda t: analytics.rank_by_mean(t["reviews"], "category", "sentiment_score"),
        },
    ),
}


def scenario(name: str) -> Scenario:
    """The scenario of that name; an unknown name is an error."""
    if name not in SCENARIOS:
        raise ValueError(f"unknown scenario {name!r}; known: {', '.join(SCENARIOS)}")
    return SCENARIOS[name]


@dataclass(frozen=True)
class Run:
    """A loaded scenario: its tables, what the loads reported, and its reports, which are not computed yet."""

    tables: dict[str, DataFrame]
    loads: dict[str, AppendReport]
    reports: dict[str, DataFrame]


def run_scenario(spark: SparkSession, name: str, folder: str, namespace: str, **sizes) -> Run:
    """Generate the scenario's files below ``folder`` and load them into tables of ``namespace``.

    Scenarios share table names but not columns, so give each its own namespace. Files are written over, tables
    are appended to.
    """
    chosen = scenario(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    loads, tables = {}, {}
    for table, df in chosen.generate(spark, **sizes).items():
        spec, full = chosen.tables[table], f"{namespace}.{table}"
        write_csv(df, f"{folder.rstrip('/')}/{table}.csv", mode="overwrite")
        schemas.declare_table(spark, full, spec.schema)
        # Generated values hold no line breaks, so large files can be split.
        loads[table] = load_csv(spark, f"{folder.rstrip('/')}/{table}.csv", full, key=spec.key, on_violation="fail", newline_free=True)
        tables[table] = spark.table(full)
    return Run(tables, loads, {title: report(tables) for title, report in chosen.reports.items()})
