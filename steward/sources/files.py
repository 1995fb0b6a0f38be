"""Delimited and JSON files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.operators.coerce import REJECT, conform

CORRUPT = "_corrupt_record"
FILE_FORMATS = (".csv", ".json")
DATABASES = ("postgres", "postgresql")


def check_format(extension: str) -> str:
    """The extension in lower case, if files of that kind can be read."""
    if extension.lower() not in FILE_FORMATS:
        raise ValueError(f"file type {extension} is not supported; use one of {', '.join(FILE_FORMATS)}")
    return extension.lower()


def check_database(kind: str) -> str:
    """The kind of database in lower case, if it can be read."""
    if kind.lower() not in DATABASES:
        raise ValueError(f"database {kind} is not supported; use one of {', '.join(DATABASES)}")
    return kind.lower()


def repair_header(df: DataFrame) -> DataFrame:
    """Column names without a leading byte-order mark (S11). Needed for sources other than Spark's file readers."""
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def _csv(spark: SparkSession, newline_free: bool, **options):
    # Files whose values may hold line breaks cannot be split, so one file is one task: keep them moderate in size.
    return spark.read.options(
        header=True, sep=",", quote='"', escape='"', encoding="UTF-8", multiLine=not newline_free, **options
    )


def _noted(lines: DataFrame, names: list[str], what: str) -> DataFrame:
    """The named columns and ``_reject``, with a note for records that the reader could not make fit.

    The note also looks at a column of the record: a query of notes alone is not one that the reader allows.
    """
    first = F.length(F.col(f"`{names[0]}`"))
    unfit = F.col(CORRUPT).isNotNull() | F.coalesce(first < -1, F.lit(False))
    note = F.when(unfit, F.concat(F.lit(f"{what}: "), F.col(CORRUPT)))
    return lines.select(*[F.col(f"`{c}`") for c in names], F.array_compact(F.array(note)).alias(REJECT))


def _text_lines(spark: SparkSession, path: str | list[str], names: list[str], newline_free: bool, by_name: bool) -> DataFrame:
    """Lines as text columns with their notes. All columns are parsed, whichever are asked for, so that a line has the same
    note in every query."""
    full = T.StructType([*[T.StructField(c, T.StringType()) for c in names], T.StructField(CORRUPT, T.StringType())])
    reader = _csv(
        spark, newline_free, enforceSchema=not by_name, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False
    )
    return _noted(reader.schema(full).csv(path), names, "line does not fit the header" if by_name else "line does not fit the table")


def read_csv(spark: SparkSession, path: str | list[str], newline_free: bool = False) -> DataFrame:
    """Delimited files with a header (S1): every value is a string, an empty one is NULL, and ``_reject`` says which lines have
    fewer or more values than the header. Files whose headers differ from the first one's are an error.

    Say ``newline_free`` when no quoted value holds a line break: only then can Spark split a large file.
    """
    names = repair_header(_csv(spark, newline_free).csv(path)).columns
    return _text_lines(spark, path, names, newline_free, by_name=True)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, lines: bool = False) -> DataFrame:
    """JSON records: files that each hold one array of objects, or with ``lines`` one object per line (S3).

    Keys that a record lacks are NULL, and ``_reject`` says which records are broken or hold values of another type. Values
    are read as text and typed by expressions, so that a record has the same notes in every query. Only JSON Lines files can
    be split; with a ``schema`` no inference pass runs.
    """
    reader = spark.read.options(multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    if schema is None:
        inferred = reader.json(path).schema
        schema = T.StructType([f for f in inferred.fields if f.name != CORRUPT])
    names = schema.fieldNames()
    full = T.StructType([*[T.StructField(c, T.StringType()) for c in names], T.StructField(CORRUPT, T.StringType())])
    return conform(_noted(reader.schema(full).json(path), names, "record cannot be read"), schema, empty_as_null=False)


def read_records(spark: SparkSession, path: str, extension: str, **options) -> DataFrame:
    """Files of a supported kind (S12): ``.csv`` or ``.json``."""
    return read_csv(spark, path, **options) if check_format(extension) == ".csv" else read_json(spark, path, **options)


def read_typed_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, newline_free: bool = False
) -> DataFrame:
    """Delimited files read into a declared schema (S2), plus the ``_reject`` column of unreadable lines.

    Columns are matched by position. A line that is too short, too long or holds an unreadable value keeps what
    could be read and says so in ``_reject``.
    """
    return conform(_text_lines(spark, path, schema.fieldNames(), newline_free, by_name=False), schema)
