"""Writers: delimited, JSON, and appends with a reject channel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.operators.coerce import REJECT, accepted, conform, rejected
from steward.operators.keys import key_violations, split_violations
from steward.session import stored
from steward.sources.files import check_format, read_typed_csv

#: Six digits, so that no time stamp loses its fraction.
WRITTEN_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class KeyViolation(ValueError):
    """Rows were not loaded because their primary key is absent, repeated or taken."""


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Delimited files with a header in every part; absent values are empty, nested ones JSON text.

    For records with differing fields take their union first, see ``profile.align``.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema.fields]
    df.select(*flat).write.mode(mode).options(
        header=True,
        escape='"',
        encoding="UTF-8",
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        **WRITTEN_TIMES,
    ).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines files (S8): one object per line, so that writing and reading can be split over tasks."""
    df.write.mode(mode).options(encoding="UTF-8", **WRITTEN_TIMES).json(path)


def write_records(df: DataFrame, path: str, extension: str, mode: str = "errorifexists") -> None:
    """Files of a supported kind (S7, S8, S12): ``.csv`` or ``.json``."""
    (write_csv if check_format(extension) == ".csv" else write_json)(df, path, mode)


@dataclass(frozen=True)
class AppendReport:
    """What became of the rows of an append."""

    attempted: int
    appended: int
    #: Rows that were not appended, with the reasons in ``_reject``.
    rejects: DataFrame

    @property
    def rejected(self) -> int:
        return self.attempted - self.appended


def _key_rejects(bad: DataFrame, key: Sequence[str]) -> DataFrame:
    note = F.lit(f"key ({', '.join(key)}) is absent, repeated or already stored")
    return bad.withColumn(REJECT, F.array_append(F.col(REJECT), note))


def append_rows(
    rows: DataFrame,
    table: str,
    key: Sequence[str] = (),
    on_violation: str = "quarantine",
    mode: str = "append",
    stage: bool = True,
) -> AppendReport:
    """Append rows to a catalog table and report what could not be appended.

    ``rows`` are brought to the table's types unless they carry a ``_reject`` column already. With a ``key``, rows
    whose key is NULL, repeated among the rows or present in the table are rejected; ``on_violation="fail"`` then
    appends nothing and raises. ``mode="overwrite"`` replaces the table's rows.

    The typed rows are stored once in the shared scratch folder, so what they are made from is worked out a single
    time, and the rejects stay what they were when the table changes. The key check then reads the key columns only,
    and without violations, which is the usual case, the rows are appended without a join. Without a key, ``stage=False``
    saves the stored copy where the rows are cheap to work out; rejects are then worked out again.
    """
    if on_violation not in ("quarantine", "fail"):
        raise ValueError("on_violation is 'quarantine' or 'fail'")
    spark = rows.sparkSession
    target = spark.table(table)
    if REJECT not in rows.columns:
        rows = conform(rows, target.schema)

    seen, kept = Observation("attempted"), Observation("appended")
    # Observed just before a write, where a task that runs again is not counted again.
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    if stage or key:
        rows = counted = stored(counted, "staged-rows")
    good, rejects = accepted(counted), rejected(rows)

    if key:
        taken = target if mode == "append" else None
        violations = stored(key_violations(good, key, taken), "key-violations")
        if not violations.isEmpty():
            if on_violation == "fail":
                raise KeyViolation(f"{table}: key ({', '.join(key)}) is absent, repeated or already stored")
            fine, bad = split_violations(rows.where(F.size(REJECT) == 0), violations, key)
            good, rejects = fine.drop(REJECT), rejects.unionByName(_key_rejects(bad, key))

    good = good.select(*[F.col(f"`{c}`") for c in target.columns]).observe(kept, F.count(F.lit(1)).alias("n"))
    good.write.mode(mode).insertInto(table)
    attempted, appended = seen.get.get("n", 0), kept.get.get("n", 0)
    return AppendReport(attempted, appended, rejects if appended < attempted else rejects.where(F.lit(False)))


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    key: Sequence[str] = (),
    on_violation: str = "quarantine",
    mode: str = "append",
    newline_free: bool = False,
) -> AppendReport:
    """Load delimited files into a declared table (S2). Loading the same file twice appends it twice."""
    lines = read_typed_csv(spark, path, spark.table(table).schema, newline_free)
    return append_rows(lines, table, key, on_violation, mode)
