"""The whole way from a file to a table: read, type, reconcile, append."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from steward.operators.coerce import accepted, conform, rejected
from steward.operators.reconcile import fresh_rows, fresh_rows_by_digest
from steward.sources.files import read_records
from steward.sources.sinks import AppendReport, append_rows


@dataclass(frozen=True)
class LoadReport:
    """The append, and the file rows that could not be typed, with their reasons in ``_reject``."""

    append: AppendReport
    unreadable: DataFrame


def load_fresh(
    spark: SparkSession,
    path: str,
    extension: str,
    table: str,
    key: Sequence[str] = (),
    by_digest: bool = False,
    **options,
) -> LoadReport:
    """Append to ``table`` those rows of the files that it does not hold yet.

    Rows are compared as bags after typing, ``by_digest`` where they are wide and few of them are new. Running it
    again appends nothing.
    """
    target = spark.table(table)
    typed = conform(read_records(spark, path, extension, **options), target.schema)
    compare = fresh_rows_by_digest if by_digest else fresh_rows
    fresh = compare(accepted(typed), target)
    return LoadReport(append_rows(fresh, table, key), rejected(typed))
