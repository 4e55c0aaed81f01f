"""Interactive analysis: scope, totals, ranking, trend, comparison, map and detail.

Every function works on all reporters at once (``by``) or, with ``by=()``, on one
scope that the caller has filtered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.functions import ratios
from monthloom.functions.calendar import with_calendar_lookups
from monthloom.functions.status import band_amount
from monthloom.functions.text import plain_decimal, quoted_csv_cell, search_text
from monthloom.operators import aggregate, rank
from monthloom.operators.select import member_or_all, months_closed
from monthloom.operators.sets import common_months
from monthloom.params import PAGE_SIZE

MONEY = "decimal(38,9)"
# Fixed column order of the CSV export.
CSV_COLUMNS = (
    "month",
    "reporter_code",
    "cmd_code",
    "hs_version",
    "partner_code",
    "source_name",
    "import_value",
    "market_share",
    "yoy",
    "mom",
)
# Fixed: the one geometry that is never drawn.
UNDRAWN_ISO3 = "ATA"


def in_products(
    frame: DataFrame, products: Sequence[str], reporter: str | None = None
) -> DataFrame:
    if not products:
        raise ValueError("select at least one product")
    if reporter is not None:
        frame = frame.where(F.col("reporter_code") == reporter)
    return frame.where(F.col("cmd_code").isin(list(products)))


def scope_monthly(
    monthly: DataFrame, products: Sequence[str], reporter: str | None = None
) -> DataFrame:
    """One series per reporter; world values need every product of the scope."""
    n = len(products)
    world, previous = F.col("world_value"), F.col("previous_year_world_value")
    grouped = in_products(monthly, products, reporter).groupBy("reporter_code", "month")
    summed = grouped.agg(
        aggregate.complete_sum(world, n).alias("world_value"),
        aggregate.complete_sum(previous, n).alias("previous_world"),
        F.bool_or("has_countries").alias("has_countries"),
    )
    grown = ratios.with_ratios(summed, {"world_yoy": ("cut_growth", "world_value", "previous_world")})
    return grown.select(
        "month",
        "reporter_code",
        F.lit("+".join(products)).alias("cmd_code"),
        "world_value",
        "world_yoy",
        world.isNotNull().alias("has_world"),
        "has_countries",
    )


def scope_partners(
    monthly: DataFrame,
    partners: DataFrame,
    products: Sequence[str],
    reporter: str | None = None,
) -> DataFrame:
    """Partner rows of the scope. The value may cover some of the products only;
    growth compares two complete product sets, the share uses the complete world."""
    n = len(products)
    attributes = ("source_name", "map_iso3", "market_share_status")
    key = ("reporter_code", "partner_code", "month")
    summed = (
        in_products(partners, products, reporter)
        .groupBy(*key)
        .agg(
            *[F.min_by(name, "cmd_code").alias(name) for name in attributes],
            aggregate.joined_editions(F.col("hs_version")).alias("hs_version"),
            F.sum("import_value").cast(MONEY).alias("import_value"),
            F.count("*").alias("products"),
        )
    )
    whole = F.when(F.col("products") == n, F.col("import_value"))
    looked_up = with_calendar_lookups(
        summed.withColumn("whole_value", whole),
        ("reporter_code", "partner_code"),
        "month",
        {"month_base": ("whole_value", -1), "year_base": ("whole_value", -12)},
    )
    world = scope_monthly(monthly, products, reporter).select(
        "reporter_code", "month", "world_value"
    )
    complete = F.col("products") == n
    based = looked_up.join(world, ["reporter_code", "month"], "left").withColumns(
        {
            "previous_month_value": F.when(complete, F.col("month_base")),
            "previous_year_value": F.when(complete, F.col("year_base")),
        }
    )
    divided = ratios.with_ratios(
        based,
        {
            "market_share": ("cut", "import_value", "world_value"),
            "mom": ("cut_growth", "import_value", "previous_month_value"),
            "yoy": ("cut_growth", "import_value", "previous_year_value"),
        },
    )
    return divided.select(
        "month",
        "reporter_code",
        F.lit("+".join(products)).alias("cmd_code"),
        "hs_version",
        "partner_code",
        "source_name",
        "map_iso3",
        "import_value",
        "market_share",
        "market_share_status",
        "previous_month_value",
        "previous_year_value",
        "mom",
        "yoy",
    )


def available_months(monthly: DataFrame) -> DataFrame:
    return monthly.where(aggregate.with_data()).select("reporter_code", "cmd_code", "month")


def keep_common_months(
    frame: DataFrame, monthly: DataFrame, reporters: Sequence[str], products: Sequence[str]
) -> DataFrame:
    """Only months every requested reporter and product has."""
    shared = common_months(available_months(monthly), reporters, products)
    return frame.join(shared, "month", "left_semi")


@dataclass(frozen=True)
class Analysis:
    """Scoped month and partner rows under one date range and partner selection.

    The partner selection never touches world values; ``n`` only cuts the ranking.
    """

    monthly: DataFrame
    partners: DataFrame
    start: date
    end: date
    countries: tuple[str, ...] = ()
    n: int = 10
    by: tuple[str, ...] = ("reporter_code",)

    @cached_property
    def months(self) -> DataFrame:
        return months_closed(self.monthly, self.start, self.end)

    @cached_property
    def scope(self) -> DataFrame:
        ranged = months_closed(self.partners, self.start, self.end)
        return member_or_all(ranged, "partner_code", self.countries)

    @cached_property
    def totals(self) -> DataFrame:
        """World and selected totals and their truncated share, in one aggregate."""
        none = F.lit(None).cast(MONEY)
        world = self.months.select(
            *self.by, F.col("world_value").alias("w"), none.alias("v"), F.lit(1).alias("m")
        )
        chosen = self.scope.select(
            *self.by, none.alias("w"), F.col("import_value").alias("v"), F.lit(0).alias("m")
        )
        sums = (
            world.unionByName(chosen)
            .groupBy(*self.by)
            .agg(
                F.sum("w").cast(MONEY).alias("world"),
                F.sum("v").cast(MONEY).alias("selected"),
                F.count("w").alias("world_months"),
                F.coalesce(F.sum("m"), F.lit(0)).alias("months"),
            )
        )
        return ratios.with_ratios(sums, {"selected_share": ("cut", "selected", "world")})

    @cached_property
    def rankings(self) -> DataFrame:
        return rank.partner_totals(self.scope, self.by)

    @cached_property
    def top(self) -> DataFrame:
        return rank.top_n(self.rankings, self.n, self.by)

    @cached_property
    def ranking_table(self) -> DataFrame:
        """The top rows with their share of the period's world total."""
        if self.by:
            world = self.totals.select(*self.by, "world")
            joined = self.top.join(world, list(self.by), "left")
        else:
            joined = self.top.withColumn("world", self.totals.select("world").scalar())
        return ratios.with_ratios(joined, {"world_share": ("cut", "value", "world")})

    @cached_property
    def trend(self) -> DataFrame:
        """Value per month of the range; NULL where no selected partner reports."""
        sums = self.scope.groupBy(*self.by, "month").agg(
            F.sum("import_value").cast(MONEY).alias("value")
        )
        return self.months.select(*self.by, "month").join(sums, [*self.by, "month"], "left")

    @cached_property
    def trend_segments(self) -> DataFrame:
        return rank.gap_segments(self.trend, self.by)

    @cached_property
    def yoy(self) -> DataFrame:
        """Growth of the one selected partner, otherwise of the world."""
        if len(self.countries) != 1:
            return self.months.select(
                *self.by, "month", F.col("world_yoy").alias("value"), F.lit("World YoY").alias("label")
            )
        code = self.countries[0]
        own = self.scope.select(*self.by, "month", F.col("yoy").alias("value"))
        rows = self.months.select(*self.by, "month").join(own, [*self.by, "month"], "left")
        name: Column
        if self.by:
            names = self.rankings.select(*self.by, "name")
            rows = rows.join(names, list(self.by), "left")
            name = F.col("name")
        else:
            name = self.rankings.select("name").scalar()
        label = F.concat(F.coalesce(name, F.lit(code)), F.lit(" YoY"))
        return rows.select(*self.by, "month", "value", label.alias("label"))

    @cached_property
    def month_counts(self) -> DataFrame:
        return aggregate.month_counts(self.months, self.by)

    @cached_property
    def comparison(self) -> DataFrame:
        return self.scope.where(F.col("month") == F.lit(self.end))

    @cached_property
    def scatter(self) -> DataFrame:
        return self.comparison.where(F.col("yoy").isNotNull())

    @cached_property
    def unmapped(self) -> DataFrame:
        blank = F.col("map_iso3").isNull() | (F.col("map_iso3") == "")
        rows = self.scope.where(blank)
        return rows.groupBy(*self.by).agg(F.sum("import_value").cast(MONEY).alias("unmapped"))

    @cached_property
    def annual(self) -> DataFrame:
        """Twelve months per year with the number of filled ones."""
        slots = aggregate.annual_slots(self.trend, "value", self.by)
        filled = F.count("value").over(Window.partitionBy(*self.by, "year"))
        return slots.withColumn("filled_months", filled)

    def map_distribution(self, geometry: DataFrame) -> DataFrame:
        """Amount and colour band of each drawn country; ``geometry`` has iso3."""
        drawn = geometry.where(F.col("iso3") != UNDRAWN_ISO3)
        shapes = drawn.select(F.col("iso3").alias("map_iso3")).distinct()
        totals = aggregate.map_totals(self.rankings, self.by)
        if self.by:
            keys = self.months.select(*self.by).distinct()
            codes = shapes.agg(F.collect_set("map_iso3").alias("codes"))
            # ISO3 codes are at most 26**3, so the set is a small constant.
            shapes = keys.withColumn("map_iso3", F.explode(codes.scalar()))
        painted = shapes.join(totals, [*self.by, "map_iso3"], "left")
        return painted.withColumn("band", band_amount(F.col("value")))

    def unmapped_by_geometry(self, geometry: DataFrame) -> DataFrame:
        drawn = geometry.where(F.col("iso3") != UNDRAWN_ISO3).select(
            F.col("iso3").alias("map_iso3")
        )
        lost = self.rankings.join(drawn, "map_iso3", "left_anti")
        return lost.groupBy(*self.by).agg(F.sum("value").cast(MONEY).alias("unmapped"))


def detail_rows(
    raw_partners: DataFrame,
    start: date,
    end: date,
    countries: Sequence[str] = (),
    query: str = "",
    label: str | None = None,
) -> DataFrame:
    """Native-grain rows in range, by partner selection and text search."""
    ranged = months_closed(raw_partners, start, end)
    chosen = member_or_all(ranged, "partner_code", countries)
    if not query:
        return chosen
    columns = ["source_name", *([label] if label else []), "map_iso3", "partner_code"]
    return chosen.where(search_text([F.col(name) for name in columns], query))


def detail_page(rows: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    return rank.page(rows, rank.DETAIL_ORDER, number, size)


def csv_lines(rows: DataFrame) -> DataFrame:
    """One quoted CSV line per row, in the fixed column order."""
    cells = []
    for name in CSV_COLUMNS:
        column = F.col(name)
        if dict(rows.dtypes)[name].startswith("decimal"):
            column = plain_decimal(column)
        cells.append(quoted_csv_cell(column))
    return rows.select(F.concat_ws(",", *cells).alias("line"))
