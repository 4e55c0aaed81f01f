from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import countries, hs_codes, number, raw

from monthloom.params import Params
from monthloom.plans import quality
from monthloom.plans.single_market import (
    SingleMarket,
    dashboard_partners,
    dim_months,
    mapping_issues,
    market_concentration,
    partner_market_share,
)

PARAMS = Params(start=date(2023, 1, 1), end=date(2024, 12, 1))


def market(spark, detail, world, dims, codes=(("H6", "8542"),), params=PARAMS):
    return SingleMarket(raw(spark, detail), raw(spark, world), countries(spark, dims), hs_codes(spark, codes), params)


def test_growth_and_unit_value(spark):
    detail = [
        {"month": "2023-01-01", "partner": "1", "value": 50, "weight": 10},
        {"month": "2023-02-01", "partner": "1", "value": 100, "weight": 0},
        {"month": "2024-01-01", "partner": "1", "value": 75},
    ]
    world = [{"month": m, "value": v} for m, v in (("2023-01-01", 100), ("2023-02-01", 200), ("2024-01-01", 100))]
    rows = market(spark, detail, world, [("1", "country", "verified")]).share.orderBy("period_start_date").collect()
    found = [
        tuple(number(x) for x in (r.market_share, r.mom, r.yoy, r.unit_value_usd_per_kg)) + (r.market_share_status,)
        for r in rows
    ]
    assert found == [
        (0.5, None, None, 5.0, "ok"),
        (0.5, 1.0, None, None, "ok"),
        (0.75, None, 0.5, None, "ok"),
    ]


def test_concentration(spark):
    share = spark.createDataFrame(
        [
            (date(2023, 1, 1), "842", "8542", "H6", "country", "verified", Decimal(60), Decimal("0.6")),
            (date(2023, 1, 1), "842", "8542", "H6", "country", "verified", Decimal(40), Decimal("0.4")),
        ],
        "period_start_date date, reporter_code string, cmd_code string, hs_version string, partner_type string, "
        "classification_status string, primary_value decimal(38,9), market_share decimal(38,9)",
    )
    row = market_concentration(share, raw(spark, [{"month": "2023-01-01", "value": 100}])).first()
    assert (number(row.country_coverage), row.hhi_status) == (1.0, "ok")
    assert row.hhi_raw == pytest.approx(5200) and row.hhi == pytest.approx(5200)


@pytest.mark.parametrize(
    ("detail", "world", "expected"),
    [
        ([("1", 100)], None, "missing_world"),
        ([("1", 100)], 0, "invalid_world"),
        ([("490", 100)], 100, "no_countries"),
        ([("1", None)], 100, "missing_country_value"),
        ([("1", -5)], 100, "negative_country_value"),
        ([("2", 100)], 100, "unreviewed_country"),
        ([("1", 50)], 100, "insufficient_coverage"),
        ([("1", "99.5")], 100, "ok"),
        ([("1", "100.6")], 100, "insufficient_coverage"),
        ([], 100, "no_countries"),
    ],
)
def test_status_ladder(spark, detail, world, expected):
    dims = [("1", "country", "verified"), ("2", "country", "needs_review"), ("490", "special", "verified")]
    rows = [{"month": "2023-01-01", "partner": p, "value": v} for p, v in detail]
    totals = [] if world is None else [{"month": "2023-01-01", "value": world}]
    row = market(spark, rows, totals, dims).concentration.first()
    assert row.hhi_status == expected
    assert (row.hhi is not None) == (expected == "ok")


def test_month_spine_keeps_gaps(spark):
    world = [{"month": "2023-01-01", "value": 100}, {"month": "2024-01-01", "value": 150}]
    params = Params(start=date(2023, 1, 1), end=date(2024, 1, 1))
    found = {
        r.month.isoformat(): (number(r.world_yoy), r.hhi_status, r.has_world)
        for r in market(spark, [], world, [], params=params).monthly.collect()
    }
    assert len(found) == 13
    assert found["2023-01-01"] == (None, "no_countries", True)
    assert found["2023-02-01"] == (None, "missing_world", False)
    assert found["2024-01-01"] == (0.5, "no_countries", True)


def test_month_dimension_end_follows_the_data(spark):
    late = raw(spark, [{"month": "2025-03-01", "value": 1}])
    none = raw(spark, [])
    assert dim_months(late, none, PARAMS).agg(F.max("month_start_date")).first()[0] == date(2025, 3, 1)
    last = dim_months(none, none, PARAMS).orderBy(F.desc("month_start_date")).first()
    assert tuple(last) == (date(2024, 12, 1), "202412", 2024, 12, date(2024, 12, 31))


def test_verified_partners_only(spark):
    detail = [{"month": "2023-01-01", "partner": p, "value": 50} for p in ("156", "490", "999")]
    dims = [("156", "country", "verified"), ("490", "special", "verified"), ("999", "country", "needs_review")]
    built = market(spark, detail, [{"month": "2023-01-01", "value": 100}], dims)
    assert [r.partner_code for r in dashboard_partners(built.share).collect()] == ["156"]


def test_issues_repeat_a_row_once_per_issue(spark):
    detail = raw(spark, [{"month": "2023-01-01", "partner": "77", "value": 5}])
    found = mapping_issues(detail, countries(spark, []), "2024-01-01T00:00:00Z")
    kinds = {r.issue_type: (r.row_count, number(r.primary_value_sum)) for r in found.collect()}
    assert kinds == {
        "missing_reference": (1, 5.0),
        "classification_needs_review": (1, 5.0),
        "reconciliation_unresolved": (1, 5.0),
        "map_unavailable": (1, 5.0),
    }


def test_unaudited_partner_is_found(spark):
    detail = raw(spark, [{"month": "2023-01-01", "partner": "77", "value": 5}])
    none = countries(spark, [])
    issues = mapping_issues(detail, none, "2024-01-01T00:00:00Z")
    assert quality.unaudited_partners(detail, none, issues).count() == 0
    assert quality.unaudited_partners(detail, none, issues.where("false")).count() == 1


def test_growth_stays_inside_one_edition(spark):
    detail = raw(
        spark,
        [
            {"month": "2023-01-01", "partner": "1", "value": 50, "hs": "H5"},
            {"month": "2023-02-01", "partner": "1", "value": 100, "hs": "H6"},
        ],
    )
    rows = partner_market_share(detail, raw(spark, [])).collect()
    assert [r.previous_month_value for r in rows] == [None, None]
