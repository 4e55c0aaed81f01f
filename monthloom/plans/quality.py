"""Data-quality checks: re-derive, compare NULL-safely, report counts of violations."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions import ratios, status
from monthloom.functions.calendar import add_spine, month_dimension, month_frame, to_period
from monthloom.functions.calendar import with_calendar_lookups
from monthloom.operators.aggregate import duplicates
from monthloom.operators.joins import null_safe_join
from monthloom.operators.select import differs
from monthloom.operators.sets import symmetric_difference, union_tagged
from monthloom.params import IMPORT_FLOW, SPECIAL_CODES, Params
from monthloom.schemas import RAW_COLUMNS

MONEY = "decimal(38,9)"
HHI_TOLERANCE = Decimal("0.0001")


def _or_false(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _any(tests: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, [_or_false(test) for test in tests])


def not_positive(value: Column) -> Column:
    return value.isNull() | (value <= 0)


def compound_unique(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    return duplicates(frame, key)


def not_null(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.where(_any([F.col(name).isNull() for name in columns]))


def accepted_values(frame: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return frame.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationships(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose non-NULL key is not in the parent."""
    keys = parent.select(*[F.col(there).alias(here) for here, there in on.items()])
    present = child.dropna(subset=list(on))
    return present.join(keys, list(on), "left_anti")


def metric_contract(mart: DataFrame) -> DataFrame:
    """A ratio without a positive base, or an HHI that disagrees with its status."""
    guarded = (
        ("world_value", "market_share"),
        ("previous_month_value", "mom"),
        ("previous_year_value", "yoy"),
        ("net_weight", "unit_value_usd_per_kg"),
    )
    tests = [not_positive(F.col(base)) & F.col(ratio).isNotNull() for base, ratio in guarded]
    tests.append((F.col("hhi_status") == "ok") != F.col("hhi").isNotNull())
    return mart.where(_any(tests))


def month_dimension_contract(months: DataFrame, start, end) -> DataFrame:
    """Rows that differ from the derived dimension, or months that occur twice."""
    spark = months.sparkSession
    derived = month_dimension(month_frame(spark, start, end, "month_start_date"))
    columns = derived.columns
    wrong = symmetric_difference(months, derived, columns).select("month_start_date")
    twice = duplicates(months, ["month_start_date"]).select("month_start_date")
    return wrong.unionByName(twice)


def unaudited_partners(detail: DataFrame, countries: DataFrame, issues: DataFrame) -> DataFrame:
    """Unmapped detail rows without their audit record; run and file compare NULL-safely."""
    unmapped = detail.join(countries.select("partner_code"), "partner_code", "left_anti")
    logged = issues.where(F.col("issue_type") == "missing_reference")
    key = ("partner_code", "period_start_date", "hs_version", "cmd_code", "run_id", "source_file")
    return null_safe_join(unmapped, logged, key, "left_anti")


def staging_contract(
    detail: DataFrame,
    world: DataFrame,
    reporter: str | None = None,
    product: str | None = None,
    edition: str | None = None,
) -> DataFrame:
    """Rows of either raw table that break grain, scope, calendar or value rules."""
    combined = union_tagged({"partner_detail": detail, "world_total": world}, "source_type")
    grain = ("source_type", "period_start_date", "reporter_code", "partner_code", "cmd_code")
    required = [name for name in RAW_COLUMNS if name not in ("net_weight", "quantity")]
    month, value = F.col("period_start_date"), F.col("primary_value")
    is_world = F.col("source_type") == "world_total"
    world_partner = F.col("partner_code") == "0"
    tests = [
        *[F.col(name).isNull() for name in required],
        F.col("flow_code") != IMPORT_FLOW,
        F.col("revision") <= 0,
        F.col("period") != to_period(month),
        month != F.trunc(month, "MM"),
        ~is_world & (world_partner | (value < 0)),
        is_world & (~world_partner | (value <= 0)),
    ]
    fixed = {"reporter_code": reporter, "cmd_code": product, "hs_version": edition}
    tests += [F.col(name) != wanted for name, wanted in fixed.items() if wanted is not None]
    # Row rules move nothing; only rows of repeated grains are looked up again.
    broken = combined.where(_any(tests))
    key = (*grain, "hs_version")
    repeated = duplicates(combined, key).select(*key)
    sound = combined.where(~_any(tests))
    return broken.unionByName(null_safe_join(sound, repeated, key, "left_semi").select(*combined.columns))


def layer_digests(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """One row per value of ``group``: rows and amounts of both layers, and hash differences.

    Two 64-bit hashes of each row are added on one side and taken away on the other, so equal
    multisets of rows leave zero. Everything is combined before the shuffle; what is shuffled
    is a row per group and task.
    """
    columns = [F.col(name) for name in RAW_COLUMNS]
    lanes = [F.xxhash64(F.lit(lane), *columns).alias(f"lane{lane}") for lane in (1, 2)]
    tagged = union_tagged(
        {"before": before.select(*RAW_COLUMNS), "after": after.select(*RAW_COLUMNS)}, "layer"
    ).select(group, "layer", "primary_value", *lanes)
    here = F.col("layer") == "before"

    def signed(name: str) -> Column:
        lane = F.col(name).cast("decimal(20,0)")
        return F.sum(F.when(here, lane).otherwise(-lane)).alias(name)

    value = F.col("primary_value")
    return tagged.groupBy(group).agg(
        F.count_if(here).alias("before_count"),
        F.count_if(~here).alias("after_count"),
        F.sum(F.when(here, value)).cast(MONEY).alias("before_amount"),
        F.sum(F.when(~here, value)).cast(MONEY).alias("after_amount"),
        signed("lane1"),
        signed("lane2"),
    )


def preserves(before: DataFrame, after: DataFrame, group: str = "period_start_date") -> DataFrame:
    """Raw columns that one layer has and the other lacks, or totals that moved.

    Months are compared by digests first. Rows are only compared in months that differ: with
    sound layers that is none, and adaptive execution drops the comparison.
    """
    digests = layer_digests(before, after, group)
    moved = (F.col("lane1") != 0) | (F.col("lane2") != 0)
    opened = digests.where(moved | (F.col("before_count") != F.col("after_count"))).select(group)
    changed = symmetric_difference(
        null_safe_join(before.select(*RAW_COLUMNS), opened, [group], "left_semi"),
        null_safe_join(after.select(*RAW_COLUMNS), opened, [group], "left_semi"),
        RAW_COLUMNS,
    ).select("side")
    sums = [F.sum(f"{side}_{of}").alias(f"{side}_{of}") for side in ("before", "after") for of in ("count", "amount")]
    totals = digests.agg(*sums).where(
        differs(F.col("before_count"), F.col("after_count"))
        | differs(F.col("before_amount"), F.col("after_amount"))
    )
    return changed.unionByName(totals.select(F.lit("totals").alias("side")))


def multi_market_detail(fact: DataFrame, products: Sequence[str]) -> DataFrame:
    value = F.col("primary_value")
    tests = [
        not_amount(value),
        F.col("partner_code").isin(list(SPECIAL_CODES)),
        ~F.col("cmd_code").isin(list(products)),
        F.col("flow_code") != IMPORT_FLOW,
        ~F.col("hs_mapping_found").eqNullSafe(F.lit(True)),
    ]
    return fact.where(_any(tests))


def not_amount(value: Column) -> Column:
    return value.isNull() | (value < 0)


def monthly_contract_multi(
    monthly: DataFrame, partners: DataFrame, tolerance: Decimal = Decimal("0.005")
) -> DataFrame:
    """Month rows that partner rows and last year's month do not reproduce."""
    key = ["reporter_code", "cmd_code", "month"]
    points = F.pow(F.col("market_share").cast("double") * 100, F.lit(2.0))
    derived = partners.groupBy(*key).agg(
        F.sum("import_value").cast(MONEY).alias("d_value"),
        F.count("*").alias("d_count"),
        F.sum(points).alias("d_hhi"),
    )
    lookup = {"d_previous": ("world_value", -12)}
    joined = with_calendar_lookups(monthly, key[:2], "month", lookup).join(derived, key, "left")
    joined = ratios.with_ratios(
        joined,
        {
            "d_yoy": ("growth", "world_value", "previous_year_world_value"),
            "d_coverage": ("positive", "country_value", "world_value"),
        },
    )
    world, coverage = F.col("world_value"), F.col("country_coverage")
    count = F.coalesce("d_count", F.lit(0))
    hhi = F.col("hhi")
    tests = [
        F.col("country_count") != count,
        differs(F.col("country_value"), F.col("d_value")),
        F.col("has_world") != world.isNotNull(),
        F.col("has_countries") != (count > 0),
        world < 0,
        F.col("country_value") < 0,
        differs(F.col("previous_year_world_value"), F.col("d_previous")),
        differs(F.col("world_yoy"), F.col("d_yoy")),
        differs(coverage, F.col("d_coverage")),
        (F.col("hhi_status") == "ok") != hhi.isNotNull(),
        hhi.isNotNull() & (coverage.isNull() | (F.abs(1 - coverage) > F.lit(tolerance))),
        hhi.isNotNull() & (F.abs(hhi.cast("double") - F.col("d_hhi")) > float(HHI_TOLERANCE)),
    ]
    return joined.where(_any(tests)).select(*monthly.columns)


def partner_contract_multi(partners: DataFrame, monthly: DataFrame) -> DataFrame:
    """Partner rows whose bases, share, status or growth cannot be derived again."""
    key = ["reporter_code", "cmd_code", "month"]
    lookups = {"d_month": ("import_value", -1), "d_year": ("import_value", -12)}
    series = ("reporter_code", "cmd_code", "partner_code")
    world = monthly.select(*key, F.col("world_value").alias("d_world"))
    joined = with_calendar_lookups(partners, series, "month", lookups).join(world, key)
    joined = ratios.with_ratios(
        joined,
        {
            "d_share": ("positive", "import_value", "d_world"),
            "d_mom": ("growth", "import_value", "previous_month_value"),
            "d_yoy": ("growth", "import_value", "previous_year_value"),
        },
    )
    value, base = F.col("import_value"), F.col("d_world")
    tests = [
        value < 0,
        differs(F.col("previous_month_value"), F.col("d_month")),
        differs(F.col("previous_year_value"), F.col("d_year")),
        differs(F.col("market_share"), F.col("d_share")),
        F.col("market_share_status") != status.share_status(base),
        differs(F.col("mom"), F.col("d_mom")),
        differs(F.col("yoy"), F.col("d_yoy")),
    ]
    return joined.where(_any(tests)).select(*partners.columns)


SINGLE_KEY = ["month", "reporter_code", "cmd_code", "hs_version"]


def monthly_contract_single(monthly: DataFrame, partners: DataFrame) -> DataFrame:
    derived = partners.groupBy(*SINGLE_KEY).agg(
        F.sum("import_value").cast(MONEY).alias("d_value"), F.count("*").alias("d_count")
    )
    yoy = F.col("world_yoy")
    tests = [
        (F.col("hhi_status") == "ok") != F.col("hhi").isNotNull(),
        not_positive(F.col("previous_year_world_value")) & yoy.isNotNull(),
        F.col("world_value").isNull() & yoy.isNotNull(),
        F.col("country_count") != F.coalesce("d_count", F.lit(0)),
        differs(F.col("country_value"), F.col("d_value")),
        F.col("has_countries") != (F.col("country_count") > 0),
        F.col("has_world") != F.col("world_value").isNotNull(),
    ]
    joined = monthly.join(derived, SINGLE_KEY, "left")
    return joined.where(_any(tests)).select(*monthly.columns)


def partner_contract_single(partners: DataFrame, monthly: DataFrame) -> DataFrame:
    world = monthly.select(*SINGLE_KEY, F.col("world_value").alias("d_world"))
    base, share = F.col("d_world"), F.col("market_share")
    value = F.col("import_value")
    tests = [
        value < 0,
        not_positive(base) & share.isNotNull(),
        (base > 0) & differs(share, F.col("d_share")),
        not_positive(F.col("previous_year_value")) & F.col("yoy").isNotNull(),
        not_positive(F.col("previous_month_value")) & F.col("mom").isNotNull(),
    ]
    joined = partners.join(world, SINGLE_KEY)
    joined = ratios.with_ratios(joined, {"d_share": ("safe", "import_value", "d_world")})
    return joined.where(_any(tests)).select(*partners.columns)


def spine_gaps(
    monthly: DataFrame, params: Params, scopes: Sequence[str] = ("reporter_code", "cmd_code")
) -> DataFrame:
    """Scope months that are missing from the complete spine or outside of it."""
    keys = monthly.select(*scopes).distinct()
    expected = add_spine(keys, params.start, params.end)
    return symmetric_difference(expected, monthly, [*scopes, "month"])


def orphans(partners: DataFrame, monthly: DataFrame) -> DataFrame:
    key = ["reporter_code", "cmd_code", "month"]
    return partners.join(monthly.select(*key), key, "left_anti")


def check_report(checks: dict[str, DataFrame]) -> DataFrame:
    """Check name and number of violating rows; a check may report several parts."""
    parts = [
        rows.agg(F.count("*").alias("violations")).select(
            F.lit(name.split("#")[0]).alias("failed_check"), "violations"
        )
        for name, rows in checks.items()
    ]
    return reduce(lambda left, right: left.unionByName(right), parts)


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(F.col("violations") > 0)


def require_clean(report: DataFrame) -> None:
    """Stop the build when any check found a violating row."""
    failed = [f"{r.failed_check}: {r.violations}" for r in failed_checks(report).collect()]
    if failed:
        raise ValueError("data checks failed: " + ", ".join(sorted(failed)))


def quality_gate(results: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: may this build be published?

    ``results`` has name, kind (model or check), status and build_id. Every node must
    have succeeded in the same build, and every required node must be there.
    """
    good = F.when(F.col("kind") == "model", "success").otherwise("pass")
    seen = F.count_if(F.col("name").isin(list(required)) & (F.col("status") == good))
    return results.agg(
        F.count_if(~F.col("status").isin("success", "pass")).alias("failed_nodes"),
        seen.alias("required_passed"),
        F.count_distinct("build_id").alias("builds"),
    ).withColumn(
        "publishable",
        (F.col("failed_nodes") == 0)
        & (F.col("required_passed") == len(required))
        & (F.col("builds") == 1),
    )
