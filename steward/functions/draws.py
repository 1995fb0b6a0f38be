"""Reproducible random draws: pure functions of a salt and row values, independent of partitioning and retries."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(salt: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts]).cast("binary"))


def draw(salt: str, *parts: Column) -> Column:
    """A uniform integer in ``[0, 2^60)``: the first 15 hex digits of an md5 of salt and parts."""
    return F.conv(F.substring(_digest(salt, *parts), 1, 15), 16, 10).cast("bigint")


def below(bound: int | Column, salt: str, *parts: Column) -> Column:
    """A uniform integer in ``[0, bound)``."""
    return draw(salt, *parts) % (bound if isinstance(bound, Column) else F.lit(bound))


def choice(values: Sequence, salt: str, *parts: Column) -> Column:
    """One of ``values``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (below(len(values), salt, *parts) + 1).cast("int"))


def money(low: str, high: str, salt: str, *parts: Column) -> Column:
    """A uniform amount from ``low`` to ``high``, in whole cents, as ``decimal(18,2)``."""
    first, last = int(Decimal(low) * 100), int(Decimal(high) * 100)
    cents = below(last - first + 1, salt, *parts) + F.lit(first)
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def uuid_text(salt: str, *parts: Column) -> Column:
    """An identifier in UUID form (version 4 layout) that depends on salt and parts only."""
    h = _digest(salt, *parts)
    first, second = F.substring(h, 1, 8), F.substring(h, 9, 4)
    third, fourth, last = F.substring(h, 14, 3), F.substring(h, 18, 3), F.substring(h, 21, 12)
    return F.concat(first, F.lit("-"), second, F.lit("-4"), third, F.lit("-a"), fourth, F.lit("-"), last)


def seconds_before(anchor: Column, span_seconds: int, salt: str, *parts: Column) -> Column:
    """A whole-second time in the ``span_seconds`` before ``anchor``."""
    return anchor - F.make_dt_interval(secs=below(span_seconds, salt, *parts).cast("decimal(18,6)"))
