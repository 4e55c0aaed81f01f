"""Seeds, CSV delivery, and plans that must hold when one key owns most rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import raw

from monthloom.operators import aggregate, revision
from monthloom.operators.dimensions import dim_countries, dim_hs_codes
from monthloom.operators.select import cast_columns, months_closed, months_listed, source_columns
from monthloom.plans import explore
from monthloom.plans.quality import check_report
from monthloom.plans.single_market import staging
from monthloom.sources.raw import scan_raw, write_table
from monthloom.sources.seeds import scan_countries, scan_hs_codes
from monthloom.sources.snapshot import write_csv


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_seeds_keep_codes_and_empty_map_codes_become_null(spark, tmp_path):
    names = (
        "partner_code,source_name,source_note,source_iso_alpha3,source_is_group,partner_type,"
        "classification_status,map_iso3,reconciliation_role,source_url,retrieved_at,"
        "classification_source_url,classification_note,mapping_source_url,mapping_note"
    )
    lines = [names, '004,"Afghanistan, Rep.",,AFG,false,country,verified,AFG,detail,u,d,u,n,u,n']
    lines.append('490,"Other ""Asia""",,,false,special,verified,,unresolved,u,d,u,n,u,n')
    (tmp_path / "c.csv").write_text("\n".join(lines) + "\n")
    rows = dim_countries(scan_countries(spark, str(tmp_path / "c.csv"))).orderBy("partner_code").collect()
    assert [(r.partner_code, r.source_name, r.map_iso3) for r in rows] == [
        ("004", "Afghanistan, Rep.", "AFG"),
        ("490", 'Other "Asia"', None),
    ]
    (tmp_path / "h.csv").write_text(
        "hs_version,cmd_code,hs_description,code_level,parent_code,source_url,retrieved_at\nH6,8542,ICs,4,85,u,d\n"
    )
    row = dim_hs_codes(scan_hs_codes(spark, str(tmp_path / "h.csv"))).first()
    assert (row.cmd_code, row.code_level) == ("8542", 4)


def test_csv_quotes_every_cell(spark, tmp_path):
    rows = [('a "b"', None, None), ("=x", "1", Decimal("-1.500000000"))]
    rows = spark.createDataFrame(rows, "x string, y string, z decimal(38,9)").coalesce(1)
    write_csv(rows, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text.splitlines() == ['"x","y","z"', '"a ""b""","",""', '"\'=x","1","-1.5"']


def test_raw_scan_prunes_months_and_columns(spark, tmp_path):
    path = str(tmp_path / "raw")
    months = [f"2016-{m:02d}-01" for m in range(1, 7)]
    write_table(raw(spark, [{"month": m, "partner": "004", "value": 1} for m in months]), path)
    scan = scan_raw(spark, path, date(2016, 2, 1), date(2016, 4, 1)).select("partner_code", "period_start_date")
    assert {r.period_start_date.month for r in scan.collect()} == {2, 3}
    text = plan(scan)
    assert "PartitionFilters: [isnotnull(period_start_date" in text
    assert "ReadSchema: struct<partner_code:string>" in text


def test_staging_scope_is_half_open(spark):
    rows = raw(
        spark,
        [{"month": m, "partner": "1", "value": 1, "reporter": r} for m in ("2023-01-01", "2023-02-01") for r in ("842", "156")],
    )
    found = staging(rows, date(2023, 1, 1), date(2023, 2, 1), "842", "8542", "H6")
    assert found.count() == 1 and found.columns == source_columns(rows.alias("s"), "s").columns


def test_month_filters(spark):
    rows = spark.createDataFrame([(date(2024, m, 1),) for m in (1, 2, 3)], "month date")
    assert months_closed(rows, date(2024, 1, 1), date(2024, 2, 1)).count() == 2
    assert months_listed(rows, [date(2024, 3, 1)], "month").count() == 1
    assert months_listed(rows, [], "month").count() == 0
    typed = rows.select(F.struct(F.lit("7").alias("a")).alias("r")).select(*cast_columns("r", {"a": "bigint"}))
    assert typed.dtypes == [("a", "bigint")]


@pytest.fixture(scope="module")
def skewed(spark):
    """One market and product owns nearly all rows, in three versions."""
    base = spark.range(60_000).select(
        F.lit(date(2016, 1, 1)).alias("period_start_date"),
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("r"), F.col("id") % 7)).otherwise("842").alias("reporter_code"),
        F.lit("854231").alias("cmd_code"),
        F.lit("M").alias("flow_code"),
        F.col("id").cast("string").alias("partner_code"),
        (F.col("id") % 3 + 1).alias("revision"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
        F.lit("H6").alias("hs_version"),
        F.lit("f").alias("source_file"),
    )
    return base.persist()


def test_accepted_extract_needs_no_window_over_a_scope(spark, skewed):
    accepted = revision.accept_latest_extract(skewed)
    assert "Window" not in plan(accepted)
    best = skewed.groupBy("reporter_code").agg(F.max("revision").alias("best"))
    expected = skewed.join(best, "reporter_code").where("revision = best").count()
    assert accepted.count() == expected


def test_hot_scope_is_split_when_winners_are_not_broadcast(spark, skewed):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        accepted = revision.accept_latest_extract(skewed.repartition(4))
        count = accepted.count()
        frame = accepted.select("partner_code")
        rows = frame.collect()
        assert "skewed" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    assert count == len(rows) == accepted.count()


def test_copies_are_counted_exactly(spark, skewed):
    copies = skewed.withColumn("partner_code", F.lit("1"))
    key = ["reporter_code", "partner_code"]
    counted = aggregate.grain_count(copies, key)
    assert "Window" not in plan(counted)
    assert counted.where("reporter_code = '842'").first().grain_count == copies.where(
        "reporter_code = '842'"
    ).count()
    assert counted.count() == copies.count()


def test_content_digest_ignores_order_but_not_copies(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",)], "line string")
    digest = aggregate.row_multiset_digest(F.col("line"))

    def of(frame):
        return frame.agg(digest.alias("d")).first().d

    assert of(rows) == of(rows.orderBy(F.desc("line")).repartition(3))
    assert of(rows) != of(rows.distinct())


def test_analysis_has_no_cross_join(spark):
    schema = "reporter_code string, month date, world_value decimal(38,9), world_yoy decimal(38,9), has_world boolean, has_countries boolean"
    monthly = spark.createDataFrame([], schema)
    partners = spark.createDataFrame(
        [], "reporter_code string, month date, partner_code string, source_name string, map_iso3 string, "
        "import_value decimal(38,9), yoy decimal(38,9)"
    )
    found = explore.Analysis(monthly, partners, date(2024, 1, 1), date(2024, 2, 1), by=())
    for frame in (found.totals, found.ranking_table, found.trend, found.annual, found.yoy):
        text = plan(frame)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_check_report_counts_every_check_in_one_job(spark):
    rows = spark.range(3)
    report = check_report({"a": rows, "b": rows.where("id > 1"), "c": rows.where("false")})
    assert {r.failed_check: r.violations for r in report.collect()} == {"a": 3, "b": 1, "c": 0}


def test_a_page_is_found_by_counting(spark):
    from monthloom.operators import rank

    rows = [(m, p, c, k) for m in (3, 1, 2, None) for p in ("b", "a", None) for k, c in enumerate("zyx") if not (m == 2 and p == "a")]
    frame = spark.createDataFrame(rows * 2, "month int, partner_code string, cmd_code string, k int").withColumn("u", F.lit(1))
    ordered = sorted(rows * 2, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or "", r[2]))
    for size in (5, 200):
        last = -(-len(ordered) // size) - 1
        for number in {0, last // 2, last + 9}:
            at = min(max(number, 0), last) * size
            page = rank.page(frame, rank.DETAIL_ORDER, number, size)
            assert [tuple(r)[:4] for r in page.collect()] == ordered[at : at + size]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("page", "page")
    page = rank.page(frame, rank.DETAIL_ORDER, 2, 5)
    assert not jobs.getJobIdsForGroup("page")
    plan = page._jdf.queryExecution().executedPlan().toString()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "TakeOrderedAndProject" in plan and "Offset" not in plan and "offset=" not in plan


def test_sound_layers_are_not_compared_row_by_row(spark):
    from rows import raw

    from monthloom.plans import quality

    rows = raw(spark, [{"month": m, "partner": str(p), "value": p} for m in ("2016-01-01", "2016-02-01", "2016-03-01") for p in range(40)])
    same = rows.repartition(3)
    found = quality.preserves(rows, same)
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    # The digests of one layer pair, and nothing that groups by whole rows.
    assert final.count("checksum#") and "on_left" not in final
    moved = F.when((F.col("partner_code") == "7") & (F.month("period_start_date") == 2), 9).otherwise(F.col("primary_value"))
    changed = rows.withColumn("primary_value", moved.cast("decimal(38,9)"))
    sides = sorted(r.side for r in quality.preserves(rows, changed).collect())
    assert sides == ["left", "right", "totals"]
    swapped = rows.withColumn("run_id", F.when(F.col("partner_code") == "3", "other").otherwise(F.col("run_id")))
    assert sorted(r.side for r in quality.preserves(rows, swapped).collect()) == ["left"] * 3 + ["right"] * 3
    # A repeated row is no difference of sets, but moves the totals.
    assert [r.side for r in quality.preserves(rows, rows.unionByName(rows.limit(1))).collect()] == ["totals"]
