"""Ranking, paging and gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthloom.functions.calendar import month_index
from monthloom.operators.joins import null_safe_join
from monthloom.params import PAGE_SIZE


def partner_totals(scope: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Value per partner over the range; name and map code of its first month.

    Names group along with the code first, so the rows are summed by hashing; which
    name comes first is settled on the few rows that are left.
    """
    shown = F.coalesce(F.nullif(F.col("source_name"), F.lit("")), F.col("partner_code"))
    named = (
        scope.withColumn("name", shown)
        .groupBy(*by, "partner_code", "name", "map_iso3")
        .agg(F.sum("import_value").cast("decimal(38,9)").alias("v"), F.min("month").alias("first"))
    )
    earliest = F.struct("first", "name", "map_iso3")
    return named.groupBy(*by, "partner_code").agg(
        F.min_by("name", earliest).alias("name"),
        F.min_by("map_iso3", earliest).alias("map_iso3"),
        F.sum("v").cast("decimal(38,9)").alias("value"),
    )


def top_n(
    frame: DataFrame,
    n: int,
    by: Sequence[str] = (),
    value: str = "value",
    code: str = "partner_code",
) -> DataFrame:
    """The ``n`` largest per group with their 1-based rank; ties go to the lower code.

    With groups, the rank limit is applied before the shuffle as well. Without,
    Spark keeps only ``n`` rows per task before the final ranking.
    """
    order = [F.col(value).desc_nulls_last(), F.col(code).asc()]
    if by:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return frame.withColumn("rank", place).where(F.col("rank") <= n)
    leaders = frame.orderBy(*order).limit(n)
    return leaders.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


#: Order of detail rows: column and whether it descends.
DETAIL_ORDER = (("month", True), ("partner_code", False), ("cmd_code", False))


def _ordered(name: str, descends: bool) -> Column:
    return F.col(name).desc() if descends else F.col(name).asc()


def page(
    frame: DataFrame, order: Sequence[tuple[str, bool]], number: int, size: int = PAGE_SIZE
) -> DataFrame:
    """Page ``number`` (0-based), clamped to the last page that exists.

    The page is found by counting. Rows per value of the first two columns are counted by
    hashing; counts of the first (few values, as months) place the page in one or two of them,
    counts of the second inside these place it in at most ``size`` groups, and only rows of
    those groups are ordered. No row that is not near the page is sorted, none passes through
    one task, and nothing runs before the result is asked for.
    """
    first, second, *rest = order
    outer, inner = first[0], second[0]
    per_group = frame.groupBy(outer, inner).agg(F.count("*").alias("n"))
    per_outer = per_group.groupBy(outer).agg(F.sum("n").alias("n"))
    total = per_outer.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    last = F.greatest(F.ceil(total / size), F.lit(1)) - 1
    begin = F.least(F.lit(max(number, 0)), last) * size
    end = begin + size

    def placed(counts: DataFrame, by: Sequence[str], key: tuple[str, bool], base: Column) -> DataFrame:
        before = Window.partitionBy(*by).orderBy(_ordered(*key)).rowsBetween(Window.unboundedPreceding, -1)
        start = base + F.coalesce(F.sum("n").over(before), F.lit(0))
        held = counts.withColumn("start", start)
        return held.where((F.col("start") < end) & (F.col("start") + F.col("n") > begin))

    outers = placed(per_outer, [], first, F.lit(0)).select(outer, F.col("start").alias("base"))
    inside = null_safe_join(per_group, outers, [outer], "inner")
    groups = placed(inside, [outer], second, F.col("base")).select(outer, inner, "start")
    near = null_safe_join(frame, groups, [outer, inner], "inner")
    tail = Window.partitionBy(outer, inner).orderBy(*[_ordered(*key) for key in rest or order])
    place = F.col("start") + F.row_number().over(tail) - 1
    chosen = near.withColumn("start", place).where((F.col("start") >= begin) & (F.col("start") < end))
    return chosen.orderBy("start").limit(size).select(*frame.columns)


def gap_segments(
    series: DataFrame, by: Sequence[str] = (), month: str = "month", value: str = "value"
) -> DataFrame:
    """Number the unbroken runs of known values; a skipped month or NULL ends a run.

    ``series`` has one row per month and group, so a group is no longer than the
    calendar.
    """
    known = series.where(F.col(value).isNotNull())
    order = Window.partitionBy(*by, F.lit(0)).orderBy(month)
    place = month_index(F.col(month))
    starts = F.coalesce(place - F.lag(place).over(order) != 1, F.lit(True)).cast("int")
    flagged = known.withColumn("starts", starts)
    return flagged.withColumn("segment", F.sum("starts").over(order)).drop("starts")


def partner_options(partners: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct partners under their latest name, sorted by it.

    Rows are hashed down to one per name, code and product first; which name is the
    latest is settled on what is left.
    """
    names = partners.groupBy(*by, "partner_code", "source_name", "map_iso3", "cmd_code").agg(
        F.max("month").alias("month")
    )
    latest = F.struct("month", "cmd_code")
    options = names.groupBy(*by, "partner_code").agg(
        F.max_by("source_name", latest).alias("source_name"),
        F.max_by("map_iso3", latest).alias("map_iso3"),
    )
    shown = F.coalesce(F.nullif(F.col("source_name"), F.lit("")), F.col("partner_code"))
    return options.orderBy(*by, shown, "partner_code")
