"""Fields of semi-structured records at every depth (S3, D4): paths, types and how often each occurs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steward.session import stored

#: Values of these types hold further ones.
NESTED = ("object", "array")
ROOT = "$"


def _type_of(value: Column) -> Column:
    """``object``, ``array``, ``string``, ``integer``, ``number``, ``boolean`` or ``null``; NULL for what is no JSON."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (
        F.when(name.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), F.lower(name))
        .when(name == "BIGINT", "integer")
        .when(name.isin("DECIMAL", "DOUBLE", "FLOAT"), "number")
        .when(name == "VOID", "null")
        .otherwise(F.lower(name))
    )


def _counted(level: DataFrame) -> DataFrame:
    return level.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"))


def nested_fields(df: DataFrame, column: str) -> DataFrame:
    """``(path, type, n)`` for every place in the JSON texts of ``column``, conflicting types of a place being rows each.

    A path is ``$`` for the record, ``.name`` for a field of an object, with names in backquotes that hold other signs than letters,
    digits and ``_``, and ``[]`` for any element of an array. Types are ``object``, ``array``, ``string``, ``integer`` (whole numbers of
    64 bits), ``number``, ``boolean`` and ``null``; texts that are not one JSON value, objects with a repeated key among them, are
    ``invalid`` at ``$``. NULL texts count as nothing.

    The texts are parsed once. Each level of nesting is then opened from the stored nested values of the one above, so a value is
    read as often as it is deep, and only counts per path and type, combined in each task, are shuffled. The result is stored.
    """
    text = F.col(f"`{column}`")
    values = df.where(text.isNotNull()).select(F.lit(ROOT).alias("path"), F.try_parse_json(text).alias("value"))
    level = values.select("path", "value", F.coalesce(_type_of(F.col("value")), F.lit("invalid")).alias("type"))
    counts: list[DataFrame] = []
    while True:
        level = stored(level.select("path", "type", F.when(F.col("type").isin(*NESTED), F.col("value")).alias("value")), "fields")
        counts.append(_counted(level))
        nested = level.where(F.col("value").isNotNull())
        if nested.isEmpty():
            return stored(merged_fields(counts), "fields")
        level = _opened(nested)


def _opened(nested: DataFrame) -> DataFrame:
    """The elements and fields inside the nested values of a level, one row each."""
    inside = nested.sparkSession.sql(
        "SELECT n.path, n.type, e.key, e.value AS inside FROM {nested} AS n, LATERAL variant_explode(n.value) AS e", nested=nested
    )
    plain = F.col("key").rlike("^[A-Za-z0-9_]+$")
    name = F.when(plain, F.col("key")).otherwise(F.concat(F.lit("`"), F.replace("key", F.lit("`"), F.lit("``")), F.lit("`")))
    step = F.when(F.col("type") == "array", F.lit("[]")).otherwise(F.concat(F.lit("."), name))
    return inside.select(F.concat("path", step).alias("path"), _type_of(F.col("inside")).alias("type"), F.col("inside").alias("value"))


def merged_fields(counts: Sequence[DataFrame]) -> DataFrame:
    """The fields of several tables of fields together, in whatever order they are merged."""
    together = reduce(DataFrame.unionByName, [c.select("path", "type", "n") for c in counts])
    return together.groupBy("path", "type").agg(F.sum("n").alias("n"))


def type_conflicts(fields: DataFrame) -> DataFrame:
    """``(path, types)`` of places with several types, besides ``null``; the types by name."""
    kinds = F.sort_array(F.collect_set(F.when(F.col("type") != "null", F.col("type")))).alias("types")
    return fields.groupBy("path").agg(kinds).where(F.size("types") > 1)
