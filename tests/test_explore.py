from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import number

from monthloom.operators import rank
from monthloom.operators.aggregate import annual_slots
from monthloom.operators.dimensions import reference_refresh, with_label
from monthloom.operators.sets import common_months
from monthloom.plans import explore
from monthloom.schemas import MONTHLY_SCHEMA, PARTNER_SCHEMA

A, B = "854231", "854232"


def d(value):
    return None if value is None else Decimal(str(value))


def monthly(spark, rows):
    """(month, product, world, world a year before)"""
    full = [
        (date.fromisoformat(m), cmd, "H6", d(w), d(p), None, None, 1, None, None, "ok", w is not None, True, "842")
        for m, cmd, w, p in rows
    ]
    return spark.createDataFrame(full, MONTHLY_SCHEMA)


def partners(spark, rows):
    """(month, product, partner, value) with an optional map code"""
    full = [
        (date.fromisoformat(m), cmd, "H6", p, f"name {p}", rest[0] if rest else "USA", d(v))
        + (None, "ok", None, None, None, None, "842")
        for m, cmd, p, v, *rest in rows
    ]
    return spark.createDataFrame(full, PARTNER_SCHEMA)


def test_scope_needs_every_product(spark):
    months = monthly(spark, [("2024-01-01", A, 100, None), ("2024-01-01", B, 100, None)])
    rows = partners(spark, [("2024-01-01", A, "156", 25), ("2024-01-01", B, "156", 25)])
    both = explore.scope_partners(months, rows, (A, B)).first()
    assert (number(both.import_value), number(both.market_share), both.yoy) == (50.0, 0.25, None)
    assert both.cmd_code == f"{A}+{B}" and both.hs_version == "H6"
    assert number(explore.scope_monthly(months, (A, B)).first().world_value) == 200.0
    three = explore.scope_monthly(months, (A, B, "854233")).first()
    assert three.world_value is None and three.has_world is False
    with pytest.raises(ValueError):
        explore.scope_monthly(months, ())


def test_scope_growth_compares_equal_product_sets(spark):
    months = monthly(spark, [("2024-01-01", A, 100, None), ("2024-01-01", B, 100, None)])
    rows = [("2024-01-01", A, "156", 60), ("2024-01-01", B, "156", 60), ("2023-01-01", A, "156", 50)]
    lacking = explore.scope_partners(months, partners(spark, rows), (A, B))
    assert lacking.where("month = date'2024-01-01'").first().yoy is None
    full = partners(spark, [*rows, ("2023-01-01", B, "156", 50), ("2023-12-01", A, "156", 1)])
    row = explore.scope_partners(months, full, (A, B)).where("month = date'2024-01-01'").first()
    assert (number(row.yoy), row.mom, number(row.previous_year_value)) == (0.2, None, 100.0)


def analysis(spark, countries=(), n=10, start="2024-01-01", end="2024-03-01", by=()):
    months = monthly(
        spark, [("2024-01-01", A, 100, None), ("2024-02-01", A, None, None), ("2024-03-01", A, 50, None)]
    )
    rows = partners(
        spark,
        [
            ("2024-01-01", A, "156", 10),
            ("2024-01-01", A, "004", 40, None),
            ("2024-03-01", A, "156", 30),
            ("2024-03-01", A, "392", 5, "JPN"),
        ],
    ).withColumn("yoy", F.when(F.col("partner_code") == "156", F.lit("0.5").cast("decimal(38,9)")))
    months = months.withColumn("world_yoy", F.lit("0.1").cast("decimal(38,9)"))
    return explore.Analysis(
        months, rows, date.fromisoformat(start), date.fromisoformat(end), countries, n, by
    )


@pytest.mark.parametrize("by", [(), ("reporter_code",)])
def test_analysis(spark, by):
    found = analysis(spark, by=by)
    totals = found.totals.first()
    assert [number(totals[n]) for n in ("world", "selected")] == [150.0, 85.0]
    assert (number(totals.selected_share), totals.world_months, totals.months) == (0.566666666, 2, 3)
    ranked = [(r.partner_code, number(r.value), r["rank"]) for r in found.top.orderBy("rank").collect()]
    assert ranked == [("004", 40.0, 1), ("156", 40.0, 2), ("392", 5.0, 3)]
    trend = [number(r.value) for r in found.trend.orderBy("month").collect()]
    assert trend == [50.0, None, 35.0]
    assert [r.segment for r in found.trend_segments.orderBy("month").collect()] == [1, 2]
    assert number(found.unmapped.first().unmapped) == 40.0
    assert found.month_counts.first().last_month == date(2024, 3, 1)
    table = found.ranking_table.orderBy("rank").collect()
    assert number(table[0].world_share) == 0.266666666
    assert {r.label for r in found.yoy.collect()} == {"World YoY"}


def test_selection_and_rank_cut(spark):
    one = analysis(spark, ("156",), n=1)
    assert number(one.totals.first().world) == 150.0 and number(one.totals.first().selected) == 40.0
    yoy = one.yoy.orderBy("month").collect()
    assert [number(r.value) for r in yoy] == [0.5, None, 0.5] and yoy[0].label == "name 156 YoY"
    cut = analysis(spark, n=1)
    assert cut.top.count() == 1 and cut.rankings.count() == 3
    assert cut.comparison.count() == 2 and cut.scatter.count() == 1
    with pytest.raises(ValueError):
        analysis(spark, start="2024-04-01").months.count()


def test_map_and_geometry(spark):
    geometry = spark.createDataFrame([("USA",), ("FRA",), ("ATA",)], "iso3 string")
    found = analysis(spark)
    bands = {r.map_iso3: (number(r.value), r.band) for r in found.map_distribution(geometry).collect()}
    assert bands == {"USA": (40.0, "band_0"), "FRA": (None, "no_data")}
    assert number(found.unmapped_by_geometry(geometry).first().unmapped) == 45.0


def test_common_months_are_exact(spark):
    rows = [("842", A, m) for m in (1, 3)] + [("156", A, m) for m in (1, 2, 3)]
    available = spark.createDataFrame(
        [(r, c, date(2024, m, 1)) for r, c, m in rows], "reporter_code string, cmd_code string, month date"
    )
    shared = common_months(available, ["842", "156"], [A]).orderBy("month").collect()
    assert [r.month.month for r in shared] == [1, 3]
    assert common_months(available, ["842", "156"], [A, B]).count() == 0


def test_annual_slots(spark):
    rows = spark.createDataFrame(
        [(date(2023, 1, 1), 100), (date(2023, 3, 1), 120), (date(2024, 1, 1), 200)], "month date, value int"
    )
    found = annual_slots(rows, "value").orderBy("year", "slot").collect()
    assert len(found) == 24
    assert [r.value for r in found[:3]] == [100, None, 120]


def test_segments_follow_the_calendar(spark):
    months = [date(2024, m, 1) for m in (1, 2, 4, 5, 6)]
    values = [1, 2, 3, None, 4]
    rows = spark.createDataFrame(list(zip(months, values)), "month date, value int")
    found = rank.gap_segments(rows).orderBy("month").collect()
    assert [(r.month.month, r.segment) for r in found] == [(1, 1), (2, 1), (4, 2), (6, 3)]


def test_pages_are_clamped(spark):
    rows = partners(spark, [("2024-01-01", A, f"{i:03d}", i) for i in range(120)])
    last = explore.detail_page(rows, 9)
    assert [r.partner_code for r in last.collect()] == [f"{i:03d}" for i in range(100, 120)]
    assert explore.detail_page(rows, 0).count() == 50
    assert explore.detail_page(rows.where("false"), 3).count() == 0


def test_search_and_csv(spark):
    rows = partners(spark, [("2024-01-01", A, "004", 1.5), ("2024-01-01", A, "156", 2)])
    found = explore.detail_rows(rows, date(2024, 1, 1), date(2024, 1, 1), query="NAME 004")
    line = explore.csv_lines(found).first().line
    assert line == f'"2024-01-01","842","{A}","H6","004","name 004","1.5","","",""'


def test_reference_refresh_wants_agreement(spark):
    existing = spark.createDataFrame([("156", "China", "CHN")], "partner_code string, source_name string, map_iso3 string")
    names = "id long, name string, note string, iso3 string, is_group boolean"
    listed = [
        (156, "Changed", None, "CHN", False),
        (4, "Afghanistan", None, "AFG", False),
        (8, "Albania", None, "XXX", False),
        (97, "EU", None, "EUX", True),
        (12, "Algeria", None, "DZA", None),
        (16, "Elsewhere", None, "ELS", False),
    ]
    official = [("004", "Afghanistan", "AFG"), ("008", "Albania", "ALB"), ("097", "EU", "EUX"), ("012", "Algeria", "DZA")]
    found = reference_refresh(
        existing,
        spark.createDataFrame(listed, names),
        spark.createDataFrame(official, "code string, name string, iso3 string"),
        "now",
    )
    assert {(r.partner_code, r.source_name) for r in found.collect()} == {("156", "China"), ("4", "Afghanistan")}


def test_labels(spark):
    rows = spark.createDataFrame(
        [("1", "One", "AAA"), ("2", "Two", None), ("3", None, None), ("4", "Odd", "AAA")],
        "partner_code string, source_name string, map_iso3 string",
    )
    labels = spark.createDataFrame([("AAA", "Erster")], "iso3 string, label string")
    found = {r.partner_code: r.label for r in with_label(rows, labels, {"Odd": "Other"}).collect()}
    assert found == {"1": "Erster", "2": "Two", "3": "3", "4": "Other"}
