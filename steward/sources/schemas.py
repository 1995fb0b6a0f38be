"""Declared tables (S4): the fixed schemas of the fintech and review scenarios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """A table's columns and, where it has one, its primary key."""

    schema: T.StructType
    key: tuple[str, ...] = ()


_TEXT, _TIME = T.StringType(), T.TimestampNTZType()


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


# Names, order and types of the columns. Identifiers are UUID texts.
FINTECH_V1 = {
    "users": TableSpec(_columns(user_id=_TEXT, kyc_status=_TEXT, country=_TEXT, created_at=_TIME), ("user_id",)),
    "accounts": TableSpec(
        _columns(account_id=_TEXT, user_id=_TEXT, account_type=_TEXT, currency=_TEXT), ("account_id",)
    ),
    "transactions": TableSpec(
        _columns(
            tx_id=_TEXT,
            src_account_id=_TEXT,
            dest_account_id=_TEXT,
            amount=T.DecimalType(18, 2),
            tx_type=_TEXT,
            timestamp=_TIME,
        ),
        ("tx_id",),
    ),
}
FINTECH = {
    "users": TableSpec(_columns(user_id=_TEXT, kyc=_TEXT, country=_TEXT)),
    "accounts": TableSpec(_columns(account_id=_TEXT, user_id=_TEXT, type=_TEXT)),
    "transactions": TableSpec(_columns(tx_id=_TEXT, src_id=_TEXT, amount=T.DecimalType(18, 2), ts=_TIME)),
}
REVIEWS = {
    "reviews": TableSpec(
        _columns(
            review_id=_TEXT,
            category=_TEXT,
            text=_TEXT,
            sentiment_score=T.DecimalType(5, 2),
            sentiment_label=_TEXT,
        )
    ),
}

UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def declare_table(
    spark: SparkSession, name: str, schema: T.StructType, if_absent: bool = True, location: str | None = None
) -> None:
    """Create an empty Parquet table, at ``location`` if given. Without ``if_absent`` an existing table is an error."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {'IF NOT EXISTS ' if if_absent else ''}{name} ({columns}) USING parquet{place}")
