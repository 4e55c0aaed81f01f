from datetime import date

from pyspark.sql import functions as F
from rows import countries, hs_codes, number, raw

from monthloom.params import PRODUCTS, Params
from monthloom.plans import quality
from monthloom.plans.multi_market import MultiMarket

PARAMS = Params(start=date(2016, 1, 1), end=date(2017, 12, 1))
CODES = [(hs, cmd) for hs in ("H4", "H5") for cmd in PRODUCTS]
DIMS = [
    ("156", "country", "verified", "CHN"),
    ("392", "country", "verified", "JPN"),
    ("490", "special", "verified"),
]


def market(spark, detail, world):
    return MultiMarket(
        raw(spark, [{"cmd": "854231", **r} for r in detail]),
        raw(spark, [{"cmd": "854231", **r} for r in world]),
        countries(spark, DIMS),
        hs_codes(spark, CODES),
        PARAMS,
    )


def accepted_rows():
    old = {"hs": "H4", "revision": 1, "ingested": "2016-02-01T00:00:00", "month": "2016-01-01"}
    new = {"hs": "H5", "revision": 2, "ingested": "2016-02-02T00:00:00", "month": "2016-01-01", "file": "new"}
    return [
        {**old, "file": "old", "partner": "156", "value": 10},
        {**old, "file": "old", "partner": "392", "value": 20},
        {**new, "partner": "156", "value": 15},
        {**new, "partner": "490", "value": 5},
        {**old, "file": "other_market", "reporter": "156", "partner": "392", "value": 30},
    ]


def test_newest_extract_replaces_the_whole_older_one(spark):
    rows = market(spark, accepted_rows(), []).fact.collect()
    found = {(r.reporter_code, r.partner_code, r.hs_version, number(r.primary_value), r.revision) for r in rows}
    assert found == {("842", "156", "H5", 15.0, 2), ("156", "392", "H4", 30.0, 1)}
    assert all(r.hs_mapping_found for r in rows)


def test_ties_fall_to_time_then_edition_then_file(spark):
    base = {"month": "2016-01-01", "partner": "156", "revision": 1}
    rows = [
        {**base, "value": 1, "ingested": "2016-02-01T00:00:00", "hs": "H5", "file": "z"},
        {**base, "value": 2, "ingested": "2016-02-02T00:00:00", "hs": "H4", "file": "a"},
        {**base, "value": 3, "ingested": "2016-02-02T00:00:00", "hs": "H4", "file": "b"},
    ]
    assert [number(r.primary_value) for r in market(spark, rows, []).fact.collect()] == [3.0]


def test_monthly_statuses_and_growth(spark):
    detail = [
        {"month": "2016-01-01", "partner": "156", "value": 60, "hs": "H4"},
        {"month": "2016-01-01", "partner": "392", "value": 40, "hs": "H4"},
        {"month": "2016-02-01", "partner": "156", "value": 10, "hs": "H4"},
        {"month": "2016-03-01", "partner": "156", "value": 10, "hs": "H4"},
        {"month": "2017-01-01", "partner": "156", "value": 10, "hs": "H5"},
    ]
    world = [
        {"month": "2016-01-01", "value": 100, "hs": "H4"},
        {"month": "2016-03-01", "value": 0, "hs": "H4"},
        {"month": "2016-04-01", "value": 5, "hs": "H4"},
        {"month": "2017-01-01", "value": 150, "hs": "H5"},
    ]
    built = market(spark, detail, world)
    rows = {r.month.isoformat()[:7]: r for r in built.monthly.collect()}
    assert len(rows) == 24
    assert [rows[m].hhi_status for m in ("2016-01", "2016-02", "2016-03", "2016-04", "2017-01", "2016-05")] == [
        "ok", "missing_world", "invalid_world", "no_countries", "insufficient_coverage", "missing_world",
    ]
    assert number(rows["2016-01"].hhi) == 5200.0
    assert number(rows["2017-01"].world_yoy) == 0.5
    assert rows["2016-05"].world_value is None and rows["2016-05"].country_value is None
    assert number(rows["2016-03"].world_value) == 0.0 and rows["2016-03"].country_coverage is None
    growth = {r.month.isoformat()[:7]: r for r in built.partners.where("partner_code = '156'").collect()}
    assert number(growth["2017-01"].yoy) == -0.833333333
    assert growth["2016-03"].market_share_status == "invalid_world"
    assert quality.monthly_contract_multi(built.monthly, built.partners).count() == 0
    assert quality.partner_contract_multi(built.partners, built.monthly).count() == 0


def test_contracts_catch_changed_values(spark):
    detail = [{"month": m, "partner": "156", "value": 10, "hs": "H4"} for m in ("2016-01-01", "2016-02-01")]
    built = market(spark, detail, [{"month": "2016-01-01", "value": 10, "hs": "H4"}])
    off = built.monthly.withColumn("country_value", F.col("country_value") + 1)
    assert quality.monthly_contract_multi(off, built.partners).count() >= 2
    wrong = built.partners.withColumn("mom", F.lit(0.5).cast("decimal(38,9)"))
    assert quality.partner_contract_multi(wrong, built.monthly).count() == 2
    gone = built.monthly.where("month <> date'2016-05-01'")
    assert [r.side for r in quality.spine_gaps(gone, PARAMS).collect()] == ["left"]
    report = quality.check_report({"monthly_contract": quality.monthly_contract_multi(off, built.partners)})
    try:
        quality.require_clean(report)
    except ValueError as error:
        assert "monthly_contract" in str(error)
    else:
        raise AssertionError("a failing check must stop the build")


def test_world_outside_the_spine_is_missing(spark):
    detail = [{"month": "2018-01-01", "partner": "156", "value": 10, "hs": "H4"}]
    built = market(spark, detail, [{"month": "2018-01-01", "value": 10, "hs": "H4"}])
    assert built.partners.first().market_share_status == "missing_world"
