"""Calendar months: keys, offsets, spines and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthloom.params import FIRST_MONTH, MAX_RANGE_MONTHS


def first_of_month(day: Column) -> Column:
    return F.trunc(day.cast("date"), "MM")


def month_index(month: Column) -> Column:
    """Months since year 0, so that neighbouring calendar months differ by one."""
    return F.year(month) * 12 + F.month(month)


def shift_month(month: Column, offset: int) -> Column:
    return F.add_months(month, offset)


def to_period(month: Column) -> Column:
    return F.date_format(month, "yyyyMM")


def period_start(period: Column) -> Column:
    return F.try_to_timestamp(F.concat(period, F.lit("01")), F.lit("yyyyMMdd")).cast("date")


def valid_period(period: Column, earliest: date = FIRST_MONTH) -> Column:
    """True for a real YYYYMM month that is not before ``earliest``."""
    start = period_start(period)
    ok = period.rlike(r"^[0-9]{6}\z") & (to_period(start) == period) & (start >= F.lit(earliest))
    return F.coalesce(ok, F.lit(False))


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy.MM")


def year_label(month: Column) -> Column:
    return F.date_format(month, "yyyy")


def month_array(start: Column, end: Column) -> Column:
    return F.sequence(start, end, F.expr("interval 1 month"))


def month_frame(spark: SparkSession, start: date, end: date, name: str = "month") -> DataFrame:
    """One row per month, both ends included."""
    if start > end:
        raise ValueError("start month is after end month")
    one_row = spark.range(1, numPartitions=1)
    return one_row.select(F.explode(month_array(F.lit(start), F.lit(end))).alias(name))


def period_list(start: str, end: str) -> list[str]:
    """The YYYYMM months of a request; the range must be ascending and not too early."""
    first, last = _parse_period(start), _parse_period(end)
    if first < FIRST_MONTH or first > last:
        raise ValueError("months before 201601 or in the wrong order")
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    steps = (first.month - 1 + step for step in range(count))
    return [f"{first.year + step // 12}{step % 12 + 1:02d}" for step in steps]


def _parse_period(period: str) -> date:
    if len(period) != 6 or not period.isascii() or not period.isdigit():
        raise ValueError("not a six-digit year and month")
    return date(int(period[:4]), int(period[4:]), 1)


def check_export_range(start: date, end_exclusive: date) -> None:
    if start.day != 1 or end_exclusive.day != 1 or start >= end_exclusive:
        raise ValueError("bounds are not first days of months in order")
    months = (end_exclusive.year - start.year) * 12 + end_exclusive.month - start.month
    if months > MAX_RANGE_MONTHS:
        raise ValueError(f"more than {MAX_RANGE_MONTHS} months")


def add_spine(scopes: DataFrame, start: date, end: date, name: str = "month") -> DataFrame:
    """Give every scope row each month of the range (a generator, not a join)."""
    return scopes.withColumn(name, F.explode(month_array(F.lit(start), F.lit(end))))


def month_dimension(months: DataFrame, name: str = "month_start_date") -> DataFrame:
    month = F.col(name)
    return months.select(
        month.alias("month_start_date"),
        to_period(month).alias("period"),
        F.year(month).alias("year_number"),
        F.month(month).alias("month_number"),
        F.last_day(month).alias("month_end_date"),
    )


def with_calendar_lookups(
    frame: DataFrame,
    series: Sequence[str],
    month: str,
    lookups: Mapping[str, tuple[str, int]],
) -> DataFrame:
    """Add ``{new: (column, offset)}``: the column's value exactly ``offset`` months away.

    A RANGE frame of width one over the month number finds the calendar month itself,
    so a missing month gives NULL where ``lag`` would give an older row. All lookups
    share one shuffle on the series key instead of one self-join each. The grain
    (series, month) is unique, so a group never exceeds the months of the calendar.
    """
    base = Window.partitionBy(*series).orderBy(month_index(F.col(month)))
    return frame.withColumns(
        {
            new: F.max(F.col(column)).over(base.rangeBetween(offset, offset))
            for new, (column, offset) in lookups.items()
        }
    )
