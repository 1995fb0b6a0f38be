"""Typing of whole rows by declared type names, with a reject channel."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.functions.casting import cast_as, truncated, unreadable
from steward.functions.normalize import empty_to_null, flag_to_boolean

#: Column added by the permissive mode: one message per value that could not be read.
REJECT = "_reject"


def declared_types(df: DataFrame) -> dict[str, str]:
    """Column to language type name, read from the schema of a typed source; no row is sampled."""
    names = [
        (T.BooleanType, "bool"),
        (T.IntegralType, "int"),
        (T.FractionalType, "float"),
        (T.StringType, "str"),
        ((T.TimestampType, T.TimestampNTZType, T.DateType), "datetime"),
        (T.ArrayType, "list"),
        (T.MapType, "dict"),
    ]

    def name_of(field: T.StructField) -> str:
        for kind, name in names:
            if isinstance(field.dataType, kind):
                return name
        raise ValueError(f"column {field.name}: no type name for {field.dataType.simpleString()}")

    return {f.name: name_of(f) for f in df.schema.fields}


def _check(df: DataFrame, types: Mapping[str, str]) -> None:
    missing = [c for c in df.columns if c not in types]
    if missing:
        raise ValueError(f"no type is declared for column(s) {', '.join(missing)}")


def coerce(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """C11: every column cast by its type name, without a shuffle.

    ``strict`` fails the job at the first value that cannot be read. Otherwise such a value is NULL and the array
    column ``_reject`` says which columns were unreadable; it is empty for good rows.
    """
    _check(df, types)
    results = {f.name: _cast(f, types[f.name], strict) for f in df.schema.fields}
    if strict:
        return df.select(*[result.alias(c) for c, result in results.items()])
    return _with_notes(df, results, types)


def _cast(field: T.StructField, type_name: str, strict: bool) -> Column:
    value = F.col(f"`{field.name}`")
    if type_name in ("tuple", "list") and isinstance(field.dataType, T.ArrayType):
        return value
    if type_name == "dict" and isinstance(field.dataType, (T.MapType, T.StructType)):
        return value
    if type_name in ("int", "integer", "float") and isinstance(field.dataType, T.BooleanType):
        return value.cast("int").cast("double" if type_name == "float" else "bigint")
    if type_name in ("int", "integer") and isinstance(field.dataType, T.NumericType) and not strict:
        return truncated(value.cast("double"))  # a number needs no detour through text
    return cast_as(value, type_name, strict)


def _with_notes(df: DataFrame, results: Mapping[str, Column], kinds: Mapping[str, str]) -> DataFrame:
    """The results under their names, and a note for each value that was given but could not be read."""
    given = [c for c in results if c in df.columns]
    earlier = [F.col(REJECT)] if REJECT in df.columns and REJECT not in results else []
    # Two projections, so that a note looks at the finished value and does not work it out again.
    both = df.select(
        *[F.col(f"`{c}`").alias(f"_given{i}") for i, c in enumerate(given)],
        *[notes.alias("_earlier") for notes in earlier],
        *[result.alias(f"_read{i}") for i, result in enumerate(results.values())],
    )
    place = {c: i for i, c in enumerate(results)}
    failed = {c: unreadable(F.col(f"_given{i}"), F.col(f"_read{place[c]}")) for i, c in enumerate(given)}
    notes = [F.when(bad, F.lit(f"{c}: not a valid {kinds[c]}")) for c, bad in failed.items()]
    reject = F.array().cast("array<string>")
    if notes:
        # Most rows are fine and get the constant empty array.
        any_bad = reduce(lambda a, b: a | b, failed.values())
        reject = F.when(any_bad, F.array_compact(F.array(*notes))).otherwise(reject)
    if earlier:
        reject = F.concat(F.col("_earlier"), reject)
    return both.select(*[F.col(f"_read{i}").alias(c) for c, i in place.items()], reject.alias(REJECT))


def coerce_through(
    df: DataFrame, column_types: Mapping[str, str], type_lookup: Mapping[str, str], strict: bool = False
) -> DataFrame:
    """As :func:`coerce`, with the type name found by way of the database type of the column."""
    _check(df, column_types)
    unknown = sorted({t for t in column_types.values() if t not in type_lookup})
    if unknown:
        raise ValueError(f"no language type for database type(s) {', '.join(unknown)}")
    return coerce(df, {c: type_lookup[t] for c, t in column_types.items()}, strict)


def conform(df: DataFrame, schema: T.StructType, empty_as_null: bool = True) -> DataFrame:
    """File rows in the column order and types of a stored table, with the ``_reject`` column; notes they have are kept.

    Empty texts become NULL, boolean columns also read ``t``/``TRUE``/``f``/``FALSE``, integers and floats follow the
    casting rules of the library, and any other type is read by Spark. A column the file lacks is NULL.
    """
    extra = [c for c in df.columns if c not in schema.fieldNames() and c != REJECT]
    if extra:
        raise ValueError(f"the table has no column(s) {', '.join(extra)}")
    if empty_as_null:
        texts = [isinstance(f.dataType, T.StringType) for f in df.schema.fields]
        df = df.select(
            *[empty_to_null(F.col(f"`{c}`")).alias(c) if text else F.col(f"`{c}`") for c, text in zip(df.columns, texts)]
        )
    results = {f.name: _conformed(df, f) for f in schema.fields if f.name != REJECT}
    return _with_notes(df, results, {f.name: f.dataType.simpleString() for f in schema.fields})


def _conformed(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    given, held, wanted = F.col(f"`{field.name}`"), df.schema[field.name].dataType, field.dataType
    if held == wanted:
        return given
    if isinstance(held, T.StringType):
        if isinstance(wanted, T.BooleanType):
            return F.coalesce(flag_to_boolean(given), cast_as(given, "boolean"))
        if isinstance(wanted, T.IntegralType):
            # Exact where the text is a plain integer, since identifiers may exceed 2^53.
            whole = given.rlike(r"^\s*[+-]?[0-9]+\s*$")
            return F.coalesce(F.when(whole, given.try_cast(wanted)), cast_as(given, "int").try_cast(wanted))
        if isinstance(wanted, (T.DoubleType, T.FloatType)):
            return cast_as(given, "float").cast(wanted)
        if isinstance(wanted, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(given, wanted)
    return given.try_cast(wanted)


def accepted(df: DataFrame) -> DataFrame:
    """Rows without a reject note, without the note column."""
    return df.where(F.size(REJECT) == 0).drop(REJECT)


def rejected(df: DataFrame) -> DataFrame:
    """Rows with a reject note, notes included."""
    return df.where(F.size(REJECT) > 0)
