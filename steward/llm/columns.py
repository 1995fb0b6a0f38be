"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steward.llm.workers import share_package


def aside(columns: Iterable[str], *wanted: str) -> list[str]:
    """A column name for each wanted one that no column of ``columns`` has."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once: a column used several times in an expression would be several times."""
    return F.get(F.transform(F.array(value), use), 0)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names, and nothing else: helper columns can then clash with none of the input's.

    Every operator starts from this, so this is where Python workers are told of the package, too."""
    share_package(df.sparkSession)
    return df.select(*[quoted(old).alias(new) for new, old in columns.items()])
