"""Work on nested records: maps, structs and JSON text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_set(names: str | Iterable[str]) -> set[str]:
    return {names} if isinstance(names, str) else set(names)


def remove_keys(value: Column, dtype: T.DataType, names: str | Iterable[str]) -> Column:
    """the record without the named keys, at every level of structs and maps. Arrays are not entered.

    A struct that loses all its fields becomes NULL, since a struct without fields cannot be stored.
    """
    gone = _as_set(names)
    if isinstance(dtype, T.StructType):
        kept = [
            remove_keys(value.getField(f.name), f.dataType, gone).alias(f.name) for f in dtype.fields if f.name not in gone
        ]
        if not kept:
            return F.lit(None).cast("string")
        return F.when(value.isNotNull(), F.struct(*kept))
    if isinstance(dtype, T.MapType):
        if isinstance(dtype.keyType, T.StringType):
            value = F.map_filter(value, lambda k, _: ~k.isin(*gone))
        if isinstance(dtype.valueType, (T.StructType, T.MapType)):
            value = F.transform_values(value, lambda _, v: remove_keys(v, dtype.valueType, gone))
    return value


def keep_keys(value: Column, dtype: T.DataType, names: str | Iterable[str]) -> Column:
    """the record with only the named keys of its top level."""
    wanted = _as_set(names)
    if isinstance(dtype, T.MapType):
        return F.map_filter(value, lambda k, _: k.isin(*wanted))
    if isinstance(dtype, T.StructType):
        kept = [value.getField(f.name).alias(f.name) for f in dtype.fields if f.name in wanted]
        if not kept:
            raise ValueError(f"none of {sorted(wanted)} is a field of {dtype.simpleString()}")
        return F.when(value.isNotNull(), F.struct(*kept))
    raise ValueError(f"keep_keys needs a map or struct, not {dtype.simpleString()}")


def distinct_lists(lists: Column) -> Column:
    """a map of lists with the repeats removed from each list; the first occurrence stays."""
    return F.transform_values(lists, lambda _, items: F.array_distinct(items))


def data_depth(value: Column, dtype: T.DataType) -> Column:
    """D5 for data: nested levels of structs and maps that are there and not empty; lists are not entered."""
    if isinstance(dtype, T.MapType):
        inner = F.array_max(F.transform(F.map_values(value), lambda v: data_depth(v, dtype.valueType)))
        return F.when(F.coalesce(F.size(value), F.lit(0)) > 0, inner + 1).otherwise(F.lit(0))
    if isinstance(dtype, T.StructType) and dtype.fields:
        inner = [data_depth(value.getField(f.name), f.dataType) for f in dtype.fields]
        return F.when(value.isNotNull(), F.greatest(F.lit(0), *inner) + 1).otherwise(F.lit(0))
    return F.lit(0)


def json_depth(text: Column) -> Column:
    """D5 for valid JSON text: nested levels of non-empty objects; lists are not entered.

    Escapes, strings and empty objects go first, then everything that is not a bracket, so the fold runs over the
    brackets alone, however long the text is.
    """
    bare = F.regexp_replace(text, r"(?s)\\.", "")
    bare = F.regexp_replace(bare, r'"[^"]*"', "0")
    bare = F.regexp_replace(bare, r"\{\s*\}", "")
    brackets = F.regexp_replace(bare, r"[^{}\[\]]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"), F.lit(0).alias("lists"))

    def step(state: Column, mark: Column) -> Column:
        outside = state["lists"] == 0
        now = state["now"] + F.when(outside & (mark == "{"), 1).when(outside & (mark == "}"), -1).otherwise(0)
        lists = state["lists"] + F.when(mark == "[", 1).when(mark == "]", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"), lists.alias("lists"))

    return F.aggregate(F.split(brackets, ""), start, step, lambda state: state["most"])


def _json_leaf(value: Column) -> Column:
    wrapped = F.to_json(F.array(value))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def _decimal_exponent(value: Column) -> Column:
    """A double as the language writes it: plain digits from 0.0001 up to 16 places, an exponent of two digits beyond."""
    text = value.cast("string")
    mantissa = F.substring_index(text, "E", 1)
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    # Digits without point, sign and closing zeros; the point belongs after the first one, moved by the power.
    digits = F.regexp_replace(F.regexp_replace(mantissa, "[-.]", ""), "0+$", "")
    size = F.length(digits)
    whole = F.when(size > power + 1, F.concat(F.substr(digits, F.lit(1), power + 1), F.lit("."), F.substr(digits, power + 2)))
    whole = whole.otherwise(F.concat(F.rpad(digits, power + 1, F.lit("0")), F.lit(".0")))
    exponent = F.concat(F.when(power < 0, "e-").otherwise("e+"), F.format_string("%02d", F.abs(power)))
    longer = F.concat(F.lit("."), F.substr(digits, F.lit(2)))
    scientific = F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(size > 1, longer).otherwise(""), exponent)
    moved = F.when((power >= 7) & (power < 16), whole).when(power == -4, F.concat(F.lit("0.000"), digits)).otherwise(scientific)
    return F.when(F.contains(text, F.lit("E")), F.concat(sign, moved)).otherwise(text)


def _time(value: Column) -> Column:
    whole = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    return F.concat(F.lit('"'), whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit('"'))


def _block(items: Column, opening: str, closing: str, pad: str, inner: str) -> Column:
    body = F.concat(F.lit(f"{opening}\n{inner}"), F.array_join(items, f",\n{inner}"), F.lit(f"\n{pad}{closing}"))
    return F.when(F.size(items) == 0, F.lit(opening + closing)).otherwise(body)


def pretty_json(value: Column, dtype: T.DataType, level: int = 0) -> Column:
    """the record as JSON text, one key per line, indented by four, keys sorted at every level.

    Dates and time stamps are written as text. Types that JSON has no value for (decimal, binary, interval) are
    written as ``null``. Characters outside ASCII are kept as they are.
    """
    pad, inner = "    " * level, "    " * (level + 1)
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        lines = [
            F.concat(_json_leaf(F.lit(f.name)), F.lit(": "), pretty_json(value.getField(f.name), f.dataType, level + 1))
            for f in fields
        ]
        text = _block(F.array(*lines), "{", "}", pad, inner) if lines else F.lit("{}")
    elif isinstance(dtype, T.MapType):
        keys = F.array_sort(F.map_keys(value))
        lines = F.transform(
            keys,
            lambda k: F.concat(
                _json_leaf(k.cast("string")), F.lit(": "), pretty_json(value[k], dtype.valueType, level + 1)
            ),
        )
        text = _block(lines, "{", "}", pad, inner)
    elif isinstance(dtype, T.ArrayType):
        lines = F.transform(value, lambda v: pretty_json(v, dtype.elementType, level + 1))
        text = _block(lines, "[", "]", pad, inner)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = _time(value)
    elif isinstance(dtype, T.DateType):
        text = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = _decimal_exponent(value)
    elif isinstance(dtype, (T.StringType, T.BooleanType, T.IntegralType)):
        text = _json_leaf(value)
    else:
        return F.lit("null")
    return F.when(value.isNull(), F.lit("null")).otherwise(text)
