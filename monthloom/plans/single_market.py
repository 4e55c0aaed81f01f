"""The single-market marts: one edition per series, growth inside one HS edition.

The reporter is part of every key, so one plan serves one market or all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions import ratios, status
from monthloom.functions.calendar import month_array, month_dimension
from monthloom.functions.calendar import with_calendar_lookups
from monthloom.operators.dimensions import conform_dimensions, dim_countries
from monthloom.operators.select import scope, source_columns, verified_country
from monthloom.params import Params
from monthloom.plans.multi_market import as_is
from monthloom.schemas import RAW_COLUMNS
from monthloom.sources.raw import in_range

KEY = ("period_start_date", "reporter_code", "cmd_code", "hs_version")
SERIES = ("reporter_code", "partner_code", "cmd_code", "hs_version")
MONEY = "decimal(38,9)"
MONTH_METRICS = (
    "country_value",
    "country_count",
    "country_coverage",
    "hhi_raw",
    "hhi",
    "hhi_status",
)


def staging(
    raw: DataFrame,
    start: date,
    end_exclusive: date,
    reporter: str | None = None,
    product: str | None = None,
    edition: str | None = None,
) -> DataFrame:
    """The raw columns of one scope in [start, end)."""
    ranged = in_range(source_columns(raw), "period_start_date", start, end_exclusive)
    return scope(ranged, reporter_code=reporter, cmd_code=product, hs_version=edition)


def dim_months(detail: DataFrame, world: DataFrame, params: Params) -> DataFrame:
    """The month dimension; data later than the configured end extends it."""
    months = detail.select("period_start_date").unionByName(world.select("period_start_date"))
    last = F.greatest(
        F.lit(params.end), F.coalesce(F.max("period_start_date"), F.lit(params.start))
    )
    spine = months.agg(F.explode(month_array(F.lit(params.start), last)).alias("month_start_date"))
    return month_dimension(spine)


def partner_market_share(fact: DataFrame, world: DataFrame) -> DataFrame:
    """Share of the world total, calendar growth and unit value per partner row."""
    value = F.col("primary_value")
    lookups = {
        "previous_month_value": ("primary_value", -1),
        "previous_year_value": ("primary_value", -12),
    }
    grown = with_calendar_lookups(fact, SERIES, "period_start_date", lookups)
    totals = world.select(*KEY, F.col("primary_value").alias("world_value"))
    divided = ratios.with_ratios(
        grown.join(totals, list(KEY), "left"),
        {
            "market_share": ("positive", "primary_value", "world_value"),
            "mom": ("growth", "primary_value", "previous_month_value"),
            "yoy": ("growth", "primary_value", "previous_year_value"),
            "unit_value_usd_per_kg": ("positive", "primary_value", "net_weight"),
        },
    )
    return divided.select(
        *fact.columns,
        "world_value",
        "market_share",
        status.share_status(F.col("world_value"), value).alias("market_share_status"),
        "previous_month_value",
        "previous_year_value",
        "mom",
        "yoy",
        "unit_value_usd_per_kg",
    )


def _counted(test: Column, name: str) -> Column:
    return F.count_if(test).alias(name)


def market_concentration(
    share: DataFrame, world: DataFrame, tolerance: Decimal = Decimal("0.005")
) -> DataFrame:
    """Coverage and HHI per month; a total or a detail without its counterpart stays."""
    country = F.col("partner_type") == "country"
    value = F.col("primary_value")
    unverified = ~F.col("classification_status").eqNullSafe(F.lit("verified"))
    points = F.pow(F.col("market_share").cast("double") * 100, F.lit(2.0))
    per_month = share.groupBy(*KEY).agg(
        _counted(country, "country_count"),
        _counted(country & value.isNull(), "missing_country_values"),
        _counted(country & (value < 0), "negative_country_values"),
        _counted(country & unverified, "unreviewed_countries"),
        F.sum(F.when(country, value)).cast(MONEY).alias("country_value"),
        F.sum(F.when(country, points)).alias("hhi_raw"),
    )
    totals = world.select(*KEY, F.col("primary_value").alias("world_value"))
    counts = (
        "country_count",
        "missing_country_values",
        "negative_country_values",
        "unreviewed_countries",
    )
    covered = per_month.join(totals, list(KEY), "full").select(
        *KEY,
        "world_value",
        "country_value",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in counts],
        "hhi_raw",
    )
    covered = ratios.with_ratios(
        covered, {"country_coverage": ("positive", "country_value", "world_value")}
    )
    label = status.concentration_status_single(
        F.col("world_value"),
        *[F.col(name) for name in counts],
        coverage=F.col("country_coverage"),
        tolerance=tolerance,
    )
    gated = F.when(F.col("hhi_status") == "ok", F.col("hhi_raw"))
    return covered.withColumn("hhi_status", label).withColumn("hhi", gated)


def supply_chain_mart(share: DataFrame, concentration: DataFrame) -> DataFrame:
    """Partner rows with the metrics of their month; those repeat, so never sum them."""
    metrics = concentration.select(*KEY, *MONTH_METRICS)
    return share.join(metrics, list(KEY), "left").select(*share.columns, *MONTH_METRICS)


def mapping_issues(detail: DataFrame, countries: DataFrame, observed_at: str) -> DataFrame:
    """One summary row per partner, issue and source; a row may raise several issues.

    The issues of a row are unfolded in a single pass over the detail.
    """
    reference = countries.select(
        "partner_code",
        "map_iso3",
        F.col("classification_status").alias("status"),
        F.col("reconciliation_role").alias("role"),
        "classification_note",
        "mapping_note",
        F.lit(True).alias("hit"),
    )
    reviewed = F.coalesce("classification_note", F.lit("No reviewed classification"))
    found = (
        (
            "missing_reference",
            F.col("hit").isNull(),
            F.lit("No reference for source partner_code"),
        ),
        (
            "classification_needs_review",
            ~F.col("status").eqNullSafe(F.lit("verified")),
            reviewed,
        ),
        (
            "reconciliation_unresolved",
            F.coalesce("role", F.lit("unresolved")) == "unresolved",
            reviewed,
        ),
        (
            "map_unavailable",
            F.col("map_iso3").isNull(),
            F.coalesce("mapping_note", F.lit("No verified map mapping")),
        ),
    )
    issues = F.array_compact(
        F.array(
            *[
                F.when(test, F.struct(F.lit(name).alias("issue_type"), reason.alias("reason")))
                for name, test, reason in found
            ]
        )
    )
    key = ("run_id", "period_start_date", "cmd_code", "hs_version", "partner_code")
    unfolded = (
        detail.select(*key, "source_file", "primary_value")
        .join(reference, "partner_code", "left")
        .select(*key, "source_file", "primary_value", F.inline(issues))
    )
    return (
        unfolded.groupBy(*key, "issue_type", "source_file", "reason")
        .agg(
            F.count("*").alias("row_count"),
            F.sum("primary_value").cast(MONEY).alias("primary_value_sum"),
        )
        .withColumn("observed_at", F.to_timestamp(F.lit(observed_at)))
    )


def dashboard_monthly(
    scopes: DataFrame, months: DataFrame, world: DataFrame, concentration: DataFrame
) -> DataFrame:
    """Every month of the dimension for each (reporter, product, edition) scope.

    The spine comes from the ends of the month dimension, which has no gaps.
    """
    bounds = months.agg(
        F.min("month_start_date").alias("lo"), F.max("month_start_date").alias("hi")
    )
    ends = (bounds.select("lo").scalar(), bounds.select("hi").scalar())
    spine = scopes.select("reporter_code", "cmd_code", "hs_version").distinct()
    spine = spine.withColumn("period_start_date", F.explode(month_array(*ends)))
    totals = world.select(
        *KEY, F.col("primary_value").alias("world_value"), F.lit(True).alias("world_hit")
    )
    metrics = concentration.select(
        *KEY, "country_value", "country_count", "country_coverage", "hhi", "hhi_status"
    )
    joined = spine.join(totals, list(KEY), "left").join(metrics, list(KEY), "left")
    looked_up = with_calendar_lookups(
        joined,
        ("reporter_code", "cmd_code", "hs_version"),
        "period_start_date",
        {"previous_year_world_value": ("world_value", -12)},
    )
    count = F.coalesce("country_count", F.lit(0))
    looked_up = ratios.with_ratios(
        looked_up, {"world_yoy": ("growth", "world_value", "previous_year_world_value")}
    )
    return looked_up.select(
        F.col("period_start_date").alias("month"),
        "reporter_code",
        "cmd_code",
        "hs_version",
        "world_value",
        "previous_year_world_value",
        "world_yoy",
        "country_value",
        count.alias("country_count"),
        "country_coverage",
        ratios.float_to_decimal(F.col("hhi")).alias("hhi"),
        F.coalesce("hhi_status", F.lit("missing_world")).alias("hhi_status"),
        F.col("world_hit").isNotNull().alias("has_world"),
        (count > 0).alias("has_countries"),
    )


def dashboard_partners(share: DataFrame) -> DataFrame:
    return share.where(verified_country()).select(
        F.col("period_start_date").alias("month"),
        "reporter_code",
        "cmd_code",
        "hs_version",
        "partner_code",
        "source_name",
        "map_iso3",
        F.col("primary_value").alias("import_value"),
        "market_share",
        "market_share_status",
        "previous_month_value",
        "previous_year_value",
        "mom",
        "yoy",
    )


@dataclass(frozen=True)
class SingleMarket:
    """The marts of one build over staged detail and world rows.

    ``keep`` is applied to what several marts read, see the multi-market build.
    """

    detail: DataFrame
    world: DataFrame
    countries: DataFrame
    hs_codes: DataFrame
    params: Params
    keep: Callable[[DataFrame], DataFrame] = as_is

    @cached_property
    def months(self) -> DataFrame:
        return dim_months(self.detail, self.world, self.params)

    @cached_property
    def fact(self) -> DataFrame:
        rows = self.detail.select(*RAW_COLUMNS)
        made = conform_dimensions(
            rows, dim_countries(self.countries), self.hs_codes, self.months
        )
        return self.keep(made)

    @cached_property
    def share(self) -> DataFrame:
        return self.keep(partner_market_share(self.fact, self.world))

    @cached_property
    def concentration(self) -> DataFrame:
        return market_concentration(self.share, self.world, self.params.tolerance)

    @cached_property
    def mart(self) -> DataFrame:
        return self.keep(supply_chain_mart(self.share, self.concentration))

    @cached_property
    def issues(self) -> DataFrame:
        stamp = "1970-01-01 00:00:00"
        return mapping_issues(self.detail, dim_countries(self.countries), stamp)

    @cached_property
    def monthly(self) -> DataFrame:
        keys = ["reporter_code", "cmd_code", "hs_version"]
        scopes = self.detail.select(*keys).unionByName(self.world.select(*keys)).distinct()
        listed = scopes.join(
            self.hs_codes.select("cmd_code", "hs_version"), ["cmd_code", "hs_version"], "left_semi"
        )
        return dashboard_monthly(listed, self.months, self.world, self.concentration)

    @cached_property
    def partners(self) -> DataFrame:
        return dashboard_partners(self.share)

