"""Grouped and global aggregates. All of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions.calendar import add_spine
from monthloom.operators.joins import null_safe_join
from monthloom.params import ROW_TARGET

MONEY = "decimal(38,9)"


def country_totals(
    fact: DataFrame, key: Sequence[str] = ("period_start_date", "reporter_code", "cmd_code")
) -> DataFrame:
    """Sum, count, newest edition and sum of squares of each month and scope.

    Grouping by edition first keeps the large step a hash aggregate: a string maximum
    would make Spark sort every row.
    """
    value = F.col("primary_value")
    per_edition = fact.groupBy(*key, "hs_version").agg(
        F.sum(value).cast(MONEY).alias("v"),
        F.count("*").alias("n"),
        F.sum(F.pow(value.cast("double"), F.lit(2.0))).alias("sq"),
    )
    return per_edition.groupBy(*key).agg(
        F.max("hs_version").alias("hs_version"),
        F.sum("v").cast(MONEY).alias("country_value"),
        F.sum("n").alias("country_count"),
        F.sum("sq").alias("sum_squares"),
    )


def representatives(frame: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Any one value per key of columns that the key determines."""
    return frame.groupBy(*key).agg(*[F.any_value(name).alias(name) for name in columns])


def exact_sum(value: Column) -> Column:
    """Nine exact digits; a sum beyond 29 whole digits raises instead of rounding."""
    return F.sum(value.cast(MONEY)).cast(MONEY)


def complete_sum(value: Column, expected: int) -> Column:
    """The sum when exactly ``expected`` rows exist and none is NULL."""
    full = (F.count("*") == expected) & (F.count(value) == expected)
    return F.when(full, F.sum(value).cast(MONEY))


def duplicates(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    return frame.groupBy(*key).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def grain_count(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with the size of their grain, by joining the grouped counts back.

    A count over a window would gather all copies of one key in a single task.
    """
    counts = frame.groupBy(*key).agg(F.count("*").alias("grain_count"))
    joined = null_safe_join(frame, counts, key, "left")
    return joined.select(*[frame[name] for name in frame.columns], "grain_count")


def watermark(audit: DataFrame) -> DataFrame:
    """Change token: number and time of the last successful load events."""
    done = audit.where(F.col("status") == "success")
    return done.agg(F.count("*").alias("events"), F.max("event_at").alias("last_event_at"))


def layer_totals(layers: dict[str, DataFrame], value: str = "primary_value") -> DataFrame:
    """Row count and exact sum of each layer side by side, in one aggregate."""
    tagged = None
    for name, frame in layers.items():
        part = frame.select(F.lit(name).alias("layer"), F.col(value).alias("v"))
        tagged = part if tagged is None else tagged.unionByName(part)
    columns = []
    for name in layers:
        here = F.col("layer") == name
        columns.append(F.count_if(here).alias(f"{name}_count"))
        columns.append(F.sum(F.when(here, F.col("v"))).cast(MONEY).alias(f"{name}_amount"))
    return tagged.agg(*columns)


def with_data() -> Column:
    return F.col("has_world") | F.col("has_countries")


def availability(monthly: DataFrame) -> DataFrame:
    """Sorted months with data per scope; a month set cannot outgrow the calendar."""
    return (
        monthly.where(with_data())
        .groupBy("reporter_code", "cmd_code")
        .agg(
            F.array_sort(F.collect_set("month")).alias("months"),
            F.min("month").alias("start_month"),
            F.max("month").alias("latest_data_month"),
        )
    )


def snapshot_counters(partners: DataFrame, target: int = ROW_TARGET) -> DataFrame:
    return partners.agg(
        F.count("*").alias("valid_detail_count"),
        F.count_if(F.col("import_value") > 0).alias("positive_amount_count"),
        (F.count("*") >= target).alias("row_target_met"),
    )


def month_counts(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Months in range, months with a world value, last month with any source."""
    return monthly.groupBy(*by).agg(
        F.count("*").alias("months"),
        F.count("world_value").alias("world_months"),
        F.max(F.when(with_data(), F.col("month"))).alias("last_month"),
    )


def map_totals(rankings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    known = rankings.where(F.col("map_iso3").isNotNull() & (F.col("map_iso3") != ""))
    return known.groupBy(*by, "map_iso3").agg(F.sum("value").cast(MONEY).alias("value"))


def joined_editions(edition: Column) -> Column:
    """Distinct editions joined by '+', sorted. There are at most seven editions."""
    return F.array_join(F.array_sort(F.collect_set(edition)), "+")


def row_multiset_digest(line: Column) -> Column:
    """Order-free 240-bit digest of many text lines.

    Each line's SHA-256 is cut into four 60-bit lanes and every lane is summed, so
    partial sums combine across tasks and no group is ever gathered in one place.
    """
    digest = F.sha2(line, 256)
    lanes = [
        F.sum(F.conv(F.substring(digest, 1 + 15 * lane, 15), 16, 10).cast("decimal(20,0)"))
        for lane in range(4)
    ]
    parts = [F.count(line).cast("string"), *[lane.cast("string") for lane in lanes]]
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws(":", *parts), 256))


def extract_summary(rows: DataFrame, key: Sequence[str], value: str, line: Column) -> DataFrame:
    """Row count, exact sum and content digest of each extract."""
    return rows.groupBy(*key).agg(
        F.count("*").alias("row_count"),
        exact_sum(F.col(value)).alias("primary_value_sum"),
        row_multiset_digest(line).alias("content_digest"),
    )


def annual_slots(
    monthly: DataFrame, value: str, by: Sequence[str] = (), month: str = "month"
) -> DataFrame:
    """Twelve slots per observed year; an absent month stays NULL."""
    keyed = monthly.select(
        *by,
        F.year(month).alias("year"),
        F.month(month).alias("slot"),
        F.col(value).alias("value"),
    )
    filled = keyed.groupBy(*by, "year", "slot").agg(F.max("value").alias("value"))
    years = filled.select(*by, "year").distinct()
    slots = years.withColumn("slot", F.explode(F.sequence(F.lit(1), F.lit(12))))
    return slots.join(filled, [*by, "year", "slot"], "left")


def scope_months(scopes: DataFrame, start: date, end: date) -> DataFrame:
    return add_spine(scopes.distinct(), start, end)
