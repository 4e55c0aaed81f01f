"""The multi-market marts: native HS editions, growth across editions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.functions import ratios, status
from monthloom.functions.calendar import add_spine, with_calendar_lookups
from monthloom.operators.aggregate import country_totals
from monthloom.operators.dimensions import conform_verified, dim_countries
from monthloom.operators.revision import accept_latest_extract, accept_latest_row
from monthloom.params import Params
from monthloom.schemas import MONTHLY_COLUMNS, PARTNER_COLUMNS

KEY = ("period_start_date", "reporter_code", "cmd_code")


def in_scope(raw: DataFrame, params: Params) -> DataFrame:
    """Flow, products and first month, as predicates the scan can use."""
    return raw.where(
        (F.col("period_start_date") >= F.lit(params.start))
        & (F.col("flow_code") == params.flow)
        & F.col("cmd_code").isin(list(params.products))
    )


def multi_market_fact(
    detail: DataFrame,
    countries: DataFrame,
    hs_codes: DataFrame,
    params: Params,
    versions: DataFrame | None = None,
) -> DataFrame:
    """Accepted extracts first, verified countries with valid amounts second.

    In the other order a partner dropped by a newer extract would come back. ``versions``
    are those that the load keeps, see ``load.scan_versions``.
    """
    known = None if versions is None else in_scope(versions, params)
    accepted = accept_latest_extract(in_scope(detail, params), versions=known)
    return conform_verified(accepted, dim_countries(countries), hs_codes)


def accepted_world(world: DataFrame, params: Params) -> DataFrame:
    totals = in_scope(world, params).where(F.col("partner_code") == params.world_code)
    return accept_latest_row(totals)


def _until(frame: DataFrame, end: date) -> DataFrame:
    return frame.where(F.col("period_start_date") <= F.lit(end))


def multi_market_monthly(fact: DataFrame, accepted: DataFrame, params: Params) -> DataFrame:
    """A complete month spine for every (reporter, product) seen in either input."""
    totals = country_totals(fact).withColumnRenamed("hs_version", "country_edition")
    world = accepted.select(
        *KEY,
        F.col("hs_version").alias("world_edition"),
        F.col("primary_value").alias("world_value"),
    )
    keys = ["reporter_code", "cmd_code"]
    scopes = totals.select(*keys).unionByName(world.select(*keys)).distinct()
    spine = add_spine(scopes, params.start, params.end, "period_start_date")
    joined = spine.join(world, list(KEY), "left").join(totals, list(KEY), "left")
    looked_up = with_calendar_lookups(
        joined, keys, "period_start_date", {"previous_year_world_value": ("world_value", -12)}
    )
    base = F.col("world_value")
    count = F.coalesce("country_count", F.lit(0))
    square = F.pow(F.nullif(base, F.lit(0)).cast("double"), F.lit(2.0))
    looked_up = ratios.with_ratios(
        looked_up,
        {
            "world_yoy": ("growth", "world_value", "previous_year_world_value"),
            "country_coverage": ("safe", "country_value", "world_value"),
        },
    )
    measured = looked_up.select(
        F.col("period_start_date").alias("month"),
        *keys,
        F.coalesce("world_edition", "country_edition").alias("hs_version"),
        "world_value",
        "previous_year_world_value",
        "world_yoy",
        "country_value",
        count.alias("country_count"),
        "country_coverage",
        (F.try_divide(F.col("sum_squares"), square) * 10000).alias("raw_hhi"),
        base.isNotNull().alias("has_world"),
        (count > 0).alias("has_countries"),
    )
    label = status.concentration_status_multi(
        base, F.col("country_count"), F.col("country_coverage"), params.tolerance
    )
    gated = F.when(F.col("hhi_status") == "ok", ratios.float_to_decimal(F.col("raw_hhi")))
    return (
        measured.withColumn("hhi_status", label).withColumn("hhi", gated).select(*MONTHLY_COLUMNS)
    )


def multi_market_partners(fact: DataFrame, accepted: DataFrame, params: Params) -> DataFrame:
    """Share, status and calendar growth per reporter, product and partner.

    The world value is read from the accepted totals within the spine, which is the
    column the month mart holds, without building that mart.
    """
    lookups = {
        "previous_month_value": ("primary_value", -1),
        "previous_year_value": ("primary_value", -12),
    }
    series = ("reporter_code", "cmd_code", "partner_code")
    grown = with_calendar_lookups(fact, series, "period_start_date", lookups)
    world = _until(accepted, params.end).select(*KEY, F.col("primary_value").alias("world_value"))
    divided = ratios.with_ratios(
        grown.join(world, list(KEY), "left"),
        {
            "market_share": ("positive", "primary_value", "world_value"),
            "mom": ("growth", "primary_value", "previous_month_value"),
            "yoy": ("growth", "primary_value", "previous_year_value"),
        },
    )
    return (
        divided.select(
            F.col("period_start_date").alias("month"),
            "reporter_code",
            "cmd_code",
            "hs_version",
            "partner_code",
            "source_name",
            "map_iso3",
            F.col("primary_value").alias("import_value"),
            "market_share",
            status.share_status(F.col("world_value")).alias("market_share_status"),
            "previous_month_value",
            "previous_year_value",
            "mom",
            "yoy",
        )
        .select(*PARTNER_COLUMNS)
    )


def as_is(frame: DataFrame) -> DataFrame:
    return frame


@dataclass(frozen=True)
class MultiMarket:
    """The marts of one build over raw detail and world rows.

    ``keep`` is applied to what several marts read: a stored table, a persisted
    frame, or by default nothing.
    """

    detail: DataFrame
    raw_world: DataFrame
    countries: DataFrame
    hs_codes: DataFrame
    params: Params
    keep: Callable[[DataFrame], DataFrame] = as_is

    @cached_property
    def fact(self) -> DataFrame:
        made = multi_market_fact(self.detail, self.countries, self.hs_codes, self.params)
        return self.keep(made)

    @cached_property
    def world(self) -> DataFrame:
        return self.keep(accepted_world(self.raw_world, self.params))

    @cached_property
    def monthly(self) -> DataFrame:
        return multi_market_monthly(self.fact, self.world, self.params)

    @cached_property
    def partners(self) -> DataFrame:
        return multi_market_partners(self.fact, self.world, self.params)
