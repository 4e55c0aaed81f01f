"""Ordered first-match classifications. The order is the contract."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthloom.params import MAP_BAND_LIMITS


def _ladder(*steps: tuple[Column, str], otherwise: str) -> Column:
    return F.coalesce(*[F.when(test, F.lit(label)) for test, label in steps], F.lit(otherwise))


def share_status(world: Column, value: Column | None = None) -> Column:
    """Multi-market rows never carry a NULL value; single-market rows may (pass it)."""
    steps = [(world.isNull(), "missing_world"), (world <= 0, "invalid_world")]
    if value is not None:
        steps.append((value.isNull(), "missing_value"))
    return _ladder(*steps, otherwise="ok")


def _beyond(coverage: Column, tolerance: Decimal) -> Column:
    return F.abs(coverage - F.lit(1)) > F.lit(tolerance)


def concentration_status_multi(
    world: Column, countries: Column, coverage: Column, tolerance: Decimal
) -> Column:
    return _ladder(
        (world.isNull(), "missing_world"),
        (world <= 0, "invalid_world"),
        (countries == 0, "no_countries"),
        (_beyond(coverage, tolerance), "insufficient_coverage"),
        otherwise="ok",
    )


def concentration_status_single(
    world: Column,
    countries: Column,
    missing: Column,
    negative: Column,
    unreviewed: Column,
    coverage: Column,
    tolerance: Decimal,
) -> Column:
    return _ladder(
        (world.isNull(), "missing_world"),
        (world <= 0, "invalid_world"),
        (countries == 0, "no_countries"),
        (missing > 0, "missing_country_value"),
        (negative > 0, "negative_country_value"),
        (unreviewed > 0, "unreviewed_country"),
        (_beyond(coverage, tolerance), "insufficient_coverage"),
        otherwise="ok",
    )


def band_amount(amount: Column) -> Column:
    """Map colour class: no data, zero, then five fixed bands (0 is the lowest)."""
    above = [F.when(amount >= F.lit(limit), 1).otherwise(0) for limit in MAP_BAND_LIMITS]
    band = sum(above[1:], above[0])
    return (
        F.when(amount.isNull(), F.lit("no_data"))
        .when(amount == 0, F.lit("zero"))
        .otherwise(F.concat(F.lit("band_"), band.cast("string")))
    )
