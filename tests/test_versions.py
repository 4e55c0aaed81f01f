"""Versions that a load keeps beside the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_pipeline import checked, land, record, run_load

from monthloom.operators import revision
from monthloom.plans import landing, load
from monthloom.sources.raw import scan_table


def accepted(spark, tables):
    raw = scan_table(spark, f"{tables}/partner_detail")
    return revision.accept_latest_extract(raw, versions=load.scan_versions(spark, f"{tables}/versions"))


def land_unit(root, value, number=1, period="201601"):
    land(root, [record(156, value, period=period), record(410, 2 * value, period=period)], number)
    land(root, [record(0, 3 * value, period=period)], number, "world_total")


def test_versions_follow_the_loads(spark, tmp_path):
    root, tables = tmp_path / "landing", tmp_path / "tables"
    land_unit(root, 100)
    assert load.scan_versions(spark, f"{tables}/versions") is None
    run_load(spark, root, tables)
    land_unit(root, 50, period="201602")
    run_load(spark, root, tables)
    raw = scan_table(spark, f"{tables}/partner_detail")
    assert sorted(accepted(spark, tables).collect()) == sorted(revision.accept_latest_extract(raw).collect())
    assert accepted(spark, tables).count() == 4
    kept = load.scan_versions(spark, f"{tables}/versions").count()
    run_load(spark, root, tables)  # a replay adds no version
    assert load.scan_versions(spark, f"{tables}/versions").count() == kept == 2
    assert load.scan_versions(spark, f"{tables}/versions", "world_total").count() == 2


def test_a_newer_revision_wins_although_older_versions_stay_listed(spark, tmp_path):
    root, tables = tmp_path / "landing", tmp_path / "tables"
    land_unit(root, 100)
    run_load(spark, root, tables)
    newer = tmp_path / "newer"
    land_unit(newer, 70, 2)
    run_load(spark, newer, tables)
    assert load.scan_versions(spark, f"{tables}/versions").count() == 2
    assert {int(r.primary_value) for r in accepted(spark, tables).collect()} == {70, 140}


def test_lost_versions_are_completed_by_a_rerun(spark, tmp_path):
    """A job that died between the raw tables and the versions; tables without any are read once."""
    root, tables, elsewhere = tmp_path / "landing", tmp_path / "tables", tmp_path / "elsewhere"
    land_unit(root, 100)
    run_load(spark, root, tables)
    land_unit(root, 50, period="201602")
    found, rows = checked(spark, root)
    extracts = landing.accepted(found)
    load.load_extracts(spark, str(elsewhere), extracts, rows)
    only = load.scan_versions(spark, f"{tables}/versions")
    assert only.count() == 1
    load.complete_versions(spark, extracts, str(tables))
    assert load.scan_versions(spark, f"{tables}/versions").count() == 2
    old = load.scan_versions(spark, f"{elsewhere}/versions").select(*revision.SCOPE, *revision.NEWEST)
    assert old.exceptAll(load.scan_versions(spark, f"{tables}/versions")).count() == 0


def test_rows_are_read_once(spark, tmp_path):
    root, tables = tmp_path / "landing", tmp_path / "tables"
    land_unit(root, 100)
    run_load(spark, root, tables)
    shown = accepted(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    raw_reads = [line for line in shown.splitlines() if "Relation [" in line and "primary_value" in line]
    assert len(raw_reads) == 1, shown
    without = revision.accept_latest_extract(scan_table(spark, f"{tables}/partner_detail"))
    twice = without._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line for line in twice.splitlines()) == 2
    assert accepted(spark, tables).where(F.col("revision").isNull()).count() == 0
