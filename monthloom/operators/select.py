"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.schemas import RAW_COLUMNS


def source_columns(frame: DataFrame, alias: str | None = None) -> DataFrame:
    """The fifteen raw columns, optionally out of an aliased side of a join."""
    prefix = f"{alias}." if alias else ""
    return frame.select(*[F.col(prefix + name).alias(name) for name in RAW_COLUMNS])


def cast_columns(record: str, types: Mapping[str, str]) -> list[Column]:
    """Typed columns out of a struct column, by a name -> type map."""
    return [F.col(f"{record}.{name}").cast(kind).alias(name) for name, kind in types.items()]


def scope(frame: DataFrame, **equal: str | None) -> DataFrame:
    """Equality filters; a None value does not filter."""
    for name, value in equal.items():
        if value is not None:
            frame = frame.where(F.col(name) == value)
    return frame


def valid_amount(value: Column) -> Column:
    return value.isNotNull() & (value >= 0)


def verified_country() -> Column:
    return (F.col("partner_type") == "country") & (F.col("classification_status") == "verified")


def months_closed(frame: DataFrame, start: date, end: date, month: str = "month") -> DataFrame:
    if start > end:
        raise ValueError("start month is after end month")
    return frame.where(F.col(month).between(F.lit(start), F.lit(end)))


def months_listed(frame: DataFrame, months: Sequence[date], month: str) -> DataFrame:
    """An empty list selects nothing."""
    return frame.where(F.col(month).isin(list(months)) if months else F.lit(False))


def member_or_all(frame: DataFrame, column: str, members: Sequence[str]) -> DataFrame:
    """An empty set means everything."""
    return frame.where(F.col(column).isin(list(members))) if members else frame


def differs(left: Column, right: Column) -> Column:
    """``is distinct from``."""
    return ~left.eqNullSafe(right)
