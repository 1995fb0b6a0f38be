"""Casts of text to typed values under the language rules of the loaders this library replaces.

Every function is ``Column -> Column`` and permissive: what cannot be read becomes NULL. ``strict=True`` raises at
run time instead, and :func:`unreadable` tells a failed read from an absent value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space around a literal, the characters of decimal literals, and the words for special values and booleans.
BLANKS = " \t\n\r\f\x0b"
LITERAL_CHARACTERS = "0123456789+-.eE"
DIGIT_GROUPING = r"(?<=[0-9])_(?=[0-9])"
NOT_A_NUMBER = ["nan", "+nan", "-nan"]
INFINITE = ["inf", "+inf", "infinity", "+infinity"]
NEGATIVE_INFINITE = ["-inf", "-infinity"]
TRUE_WORDS = ["t", "true", "y", "yes", "1"]
FALSE_WORDS = ["f", "false", "n", "no", "0"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` uses it. For array expressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _guarded(value: Column, target: str, strict: bool, result: Column) -> Column:
    if not strict:
        return result
    message = F.concat(F.lit("cannot read '"), value.cast("string"), F.lit(f"' as {target}"))
    return F.when(value.isNotNull() & result.isNull(), F.raise_error(message)).otherwise(result)


def _plain(text: Column) -> Column:
    # Spark's own cast would also read suffixes such as '1d'; none of those is written with these characters.
    literal = (F.translate(text, LITERAL_CHARACTERS + BLANKS, "") == "") & (text != "")
    return F.when(literal, text.try_cast("double"))


def _finite(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(
        _plain(text), F.when(F.contains(text, F.lit("_")), _plain(F.regexp_replace(text, DIGIT_GROUPING, "")))
    )


def as_float(value: Column, strict: bool = False) -> Column:
    """A double, from decimal or exponent notation, ``nan`` or ``inf``; digits may be grouped by ``_``."""
    word = F.lower(F.btrim(value.cast("string"), F.lit(BLANKS)))
    special = (
        F.when(word.isin(NOT_A_NUMBER), F.lit(float("nan")))
        .when(word.isin(INFINITE), F.lit(float("inf")))
        .when(word.isin(NEGATIVE_INFINITE), F.lit(float("-inf")))
    )
    return _guarded(value, "float", strict, F.coalesce(_finite(value), special))


def truncated(number: Column) -> Column:
    """A double as a bigint, toward zero; NULL beyond the range."""
    # Spark turns 2^63 itself into the greatest bigint, a value that no double has.
    return F.nullif(number.try_cast("bigint"), F.lit(2**63 - 1))


def as_integer(value: Column, strict: bool = False) -> Column:
    """A bigint by way of a double, so it truncates toward zero and is exact up to 2^53 only.

    Values beyond the bigint range, ``nan`` and ``inf`` are unreadable.
    """
    return _guarded(value, "integer", strict, truncated(_finite(value)))


def as_text(value: Column, strict: bool = False) -> Column:
    """A string. An absent value stays NULL; it does not become the word ``None``."""
    return value.cast("string")


def truthy(value: Column, held: T.DataType) -> Column:
    """True for texts and collections that are not empty, numbers other than 0 and true itself; false for absent values."""
    if isinstance(held, T.BooleanType):
        holds = value
    elif isinstance(held, T.NumericType):
        holds = value != 0
    elif isinstance(held, (T.ArrayType, T.MapType)):
        holds = F.size(value) > 0
    elif isinstance(held, (T.StringType, T.BinaryType)):
        holds = F.length(value) > 0
    else:
        holds = value.isNotNull()
    return F.coalesce(holds, F.lit(False))


def as_boolean(value: Column, strict: bool = False, mode: str = "token", held: T.DataType | None = None) -> Column:
    """C4: a boolean.

    ``token`` reads t/true/y/yes/1 and f/false/n/no/0 in any case. ``truthy`` depends on the type that the column ``held``,
    a text where none is given: ``'f'`` is then true, and so is the text ``'0'``, but not the number.
    """
    if mode == "truthy":
        return truthy(value if held else value.cast("string"), held or T.StringType())
    if mode != "token":
        raise ValueError(f"unknown boolean mode {mode!r}; use 'token' or 'truthy'")
    word = F.lower(F.btrim(value.cast("string"), F.lit(BLANKS)))
    result = F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))
    return _guarded(value, "boolean", strict, result)


def unchanged(value: Column, strict: bool = False) -> Column:
    """Date-times pass through as they are."""
    return value


def as_items(value: Column, strict: bool = False) -> Column:
    """A text becomes the array of its characters; the empty text an empty array."""
    return F.when(F.length(value) == 0, F.array().cast("array<string>")).otherwise(F.split(value, ""))


def as_mapping(value: Column, strict: bool = False) -> Column:
    """An array of pairs (structs of two fields) becomes a map; for a repeated key the last pair counts."""

    def key(entry: Column) -> Column:
        return F.element_at(F.map_keys(entry), 1)

    def content(entry: Column) -> Column:
        return F.element_at(F.map_values(entry), 1)

    def last_of_each(entries: Column) -> Column:
        return let(
            F.transform(entries, key),
            lambda keys: F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), key(e))),
        )

    entries = F.transform(value, lambda pair: F.map_from_entries(F.array(pair)))
    last = let(entries, last_of_each)
    return let(last, lambda kept: F.map_from_arrays(F.transform(kept, key), F.transform(kept, content)))


#: Accepted type names and what they do.
CASTS: dict[str, Callable[..., Column]] = {
    "int": as_integer,
    "integer": as_integer,
    "float": as_float,
    "str": as_text,
    "text": as_text,
    "character varying": as_text,
    "bool": as_boolean,
    "boolean": as_boolean,
    "datetime": unchanged,
    "tuple": as_items,
    "list": as_items,
    "dict": as_mapping,
}


def cast_as(value: Column, type_name: str, strict: bool = False) -> Column:
    """Cast by type name. A name that is not known is an error when the plan is built, not a column of NULLs."""
    if type_name not in CASTS:
        raise ValueError(f"unknown type name {type_name!r}; known: {', '.join(CASTS)}")
    return CASTS[type_name](value, strict=strict)


def unreadable(value: Column, result: Column) -> Column:
    """True where a value was given and the cast made NULL of it."""
    return value.isNotNull() & result.isNull()
