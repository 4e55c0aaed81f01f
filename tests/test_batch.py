"""The batch path as one run, and every way it refuses."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import countries, hs_codes, number, raw
from test_pipeline import CMD, DIMS, land, record

from monthloom.params import Params
from monthloom.plans import landing, load, publish
from monthloom.plans.batch import Batch
from monthloom.sources import landing as source

PARAMS = Params(start=date(2016, 1, 1), end=date(2016, 3, 1), products=(CMD,), reporters=("842", "156"))
NAMES = {"products": {CMD: "chips"}, "markets": {"842": "A", "156": "B"}}


def batch(spark, root, run_id, **changes):
    given = {
        "landing": f"{root}/landing", "tables": f"{root}/tables", "output": f"{root}/out",
        "countries": countries(spark, DIMS), "hs_codes": hs_codes(spark, [("H4", CMD), ("H5", CMD)]), "params": PARAMS,
    }
    return Batch(spark=spark, run_id=run_id, **{**given, **NAMES, **changes})


def land_month(root, period="201601", value=100, revision=1, reporters=(842, 156), hs="H4"):
    for reporter in reporters:
        land(root / "landing", [record(156, value, reporter, period, hs), record(410, 2 * value, reporter, period, hs)], revision)
        land(root / "landing", [record(0, 3 * value, reporter, period, hs)], revision, "world_total")


def published(spark, root):
    folder = publish.snapshot_folder(f"{root}/out", publish.current_snapshot(spark, f"{root}/out"))
    rows = publish.read_snapshot(spark, folder)[1].collect()
    return {(r.month[:7], r.reporter_code, r.partner_code, number(r.import_value)) for r in rows}


@pytest.fixture
def done(spark, tmp_path):
    land_month(tmp_path)
    snapshot = batch(spark, tmp_path, "first").run()
    assert publish.current_snapshot(spark, f"{tmp_path}/out") == snapshot
    return tmp_path


def test_runs_follow_each_other(spark, done):
    assert len(published(spark, done)) == 4
    # A second run opens only what is new, refreshes the months of its load, and publishes.
    land_month(done, "201602", 50, reporters=(842,))
    land_month(done, "201601", 70, 2, reporters=(156,), hs="H5")
    second = batch(spark, done, "second")
    found = second.landed()
    assert found.count() == 8 and second.unread(found).count() == 4
    pattern = second.patterns(second.unread(found))
    opened = source.scan_manifests(spark, second.landing, pattern).inputFiles()
    assert len(opened) == 6  # reporter 842 in 201602, reporter 156 in 201601 with its older revision
    second.run()
    assert published(spark, done) == {
        ("2016-01", "842", "156", 100.0), ("2016-01", "842", "410", 200.0), ("2016-01", "156", "156", 70.0),
        ("2016-01", "156", "410", 140.0), ("2016-02", "842", "156", 50.0), ("2016-02", "842", "410", 100.0),
    }
    # Nothing new: nothing is loaded, and what is published stays the same.
    third = batch(spark, done, "third")
    third.scan()
    assert third.load()["status"] == "nothing_new"
    assert load.scan_audit(spark, f"{done}/tables/audit").count() == 8


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    land_month(tmp_path)
    run = batch(spark, tmp_path, "stopped")
    first = run.scan()
    run.load()
    land_month(tmp_path, "201602")
    assert run.scan() == first
    assert set(run.transform().values()) == {0}
    snapshot = run.publish()
    assert run.verify() == snapshot
    assert {row[0] for row in published(spark, tmp_path)} == {"2016-01"}


def test_stages_refuse_each_other(spark, tmp_path):
    land_month(tmp_path)
    run = batch(spark, tmp_path, "r1")
    with pytest.raises(ValueError, match="stage scan of this run has not succeeded"):
        run.load()
    run.scan()
    with pytest.raises(ValueError, match="settings differ"):
        batch(spark, tmp_path, "r1", full=True).load()
    with pytest.raises(ValueError, match="settings differ"):
        batch(spark, tmp_path, "r1", full=True).scan()
    run.load()
    with pytest.raises(ValueError, match="stage transform of this run has not succeeded"):
        run.publish()
    for wrong in ("", "a/b", "x" * 129):
        with pytest.raises(ValueError, match="invalid run id"):
            batch(spark, tmp_path, wrong)
    for reporters, message in (((), "must be there"), (("842", "842"), "must be there"), (("999",), "unsupported")):
        with pytest.raises(ValueError, match=message):
            batch(spark, tmp_path, "r", params=Params(start=PARAMS.start, end=PARAMS.end, products=(CMD,), reporters=reporters))


def test_unsafe_folders_stop_the_scan(spark, tmp_path):
    land_month(tmp_path)
    lone = land(tmp_path / "landing", [record(156, 1, period="201602")])
    kept = (lone / "manifest.json").read_bytes()
    (lone / "manifest.json").rename(lone / "kept.bak")
    with pytest.raises(ValueError, match="uncommitted source: 1 rows"):
        batch(spark, tmp_path, "a").scan()
    # Outside of the range it is not even listed.
    batch(spark, tmp_path, "b", params=Params(start=PARAMS.start, end=PARAMS.start, products=(CMD,), reporters=("842", "156"))).scan()
    (lone / "manifest.json").write_bytes(kept)
    (lone / "part-00000-x.txt").write_bytes(b"{}\n")
    with pytest.raises(ValueError, match="ambiguous source: 1 rows"):
        batch(spark, tmp_path, "c").scan()
    (lone / "part-00000-x.txt").rename(lone / "x.bak")
    (lone / "data.ndjson").rename(lone / "y.bak")
    with pytest.raises(ValueError, match="manifest without data: 1 rows"):
        batch(spark, tmp_path, "d").scan()


def test_unsound_and_ambiguous_extracts_stop_the_scan(spark, tmp_path):
    land_month(tmp_path)
    land(tmp_path / "landing", [record(156, 1, period="201602", flowCode="X")])
    with pytest.raises(ValueError, match="unsound extract: 1 rows"):
        batch(spark, tmp_path, "a").scan()
    other = tmp_path / "other"
    land(other / "landing", [record(156, 1)])
    land(other / "landing", [record(156, 1, hs="H5")])
    with pytest.raises(ValueError, match="ambiguous source revision: 2 rows"):
        batch(spark, other, "a").scan()


def test_a_refresh_must_find_what_was_accepted(spark, done):
    folder = done / "landing/v3/reporter_code=156/hs_version=H4/cmd_code=854231/period=201601/query_type=world_total/revision=1"
    folder.rename(done / "away")
    batch(spark, done, "plain").scan()
    with pytest.raises(ValueError, match="1 accepted extracts are missing"):
        batch(spark, done, "again", refresh=True).scan()
    folder.parent.mkdir(parents=True, exist_ok=True)
    (done / "away").rename(folder)
    run = batch(spark, done, "whole", refresh=True)
    run.scan()
    assert run.load()["status"] == "already_loaded"


def other_load(spark, root, period, name):
    """What another run does meanwhile."""
    land_month(root, period, 10, reporters=(156,))
    run = batch(spark, root, name)
    run.scan()
    run.load()


def test_loads_in_between_are_refused(spark, done, monkeypatch):
    land_month(done, "201602")
    run = batch(spark, done, "moved")
    run.scan()
    run.load()
    real = load.refresh_fact

    def disturbed(*arguments):
        made = real(*arguments)
        other_load(spark, done, "201603", "other")
        return made

    before = publish.current_snapshot(spark, f"{done}/out")
    monkeypatch.setattr(load, "refresh_fact", disturbed)
    with pytest.raises(ValueError, match="changed during the transform"):
        run.transform()
    monkeypatch.setattr(load, "refresh_fact", real)
    # The failed attempt bars publication, also of an earlier success.
    with pytest.raises(ValueError, match="has not succeeded"):
        run.publish()
    assert publish.current_snapshot(spark, f"{done}/out") == before


def test_a_load_after_the_transform_or_during_publication_is_refused(spark, done, monkeypatch):
    run = batch(spark, done, "late")
    run.scan()
    run.load()
    run.transform()
    before = publish.current_snapshot(spark, f"{done}/out")
    real = publish.check_snapshot

    def disturbed(*arguments):
        other_load(spark, done, "201602", "meanwhile")
        return real(*arguments)

    monkeypatch.setattr(publish, "check_snapshot", disturbed)
    with pytest.raises(ValueError, match="changed during the publication"):
        run.publish()
    monkeypatch.undo()
    with pytest.raises(ValueError, match="changed after the transform"):
        run.publish()
    assert publish.current_snapshot(spark, f"{done}/out") == before
    run.record("publish", snapshot_id="an older one")
    with pytest.raises(ValueError, match="another run has published"):
        run.verify()


def test_a_failed_transform_bars_an_earlier_success(spark, done):
    run = batch(spark, done, "twice")
    run.scan()
    run.load()
    run.transform()
    run.record("attempt", attempt="failed later")
    with pytest.raises(ValueError, match="did not succeed"):
        run.publish()


def test_a_full_refresh_that_fails_leaves_the_version_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    dims, codes = countries(spark, DIMS), hs_codes(spark, [("H4", CMD)])
    rows = raw(spark, [{"cmd": CMD, "hs": "H4", "partner": "156", "month": "2016-01-01", "value": 1}])
    load.refresh_fact(spark, path, rows, dims, codes, PARAMS)
    first = load.fact_folder(spark, path)
    broken = rows.withColumn("primary_value", F.when(F.col("primary_value") > 0, F.raise_error(F.lit("lost"))).cast("decimal(38,9)"))
    with pytest.raises(Exception, match="lost"):
        load.refresh_fact(spark, path, broken, dims, codes, PARAMS, full=True)
    assert load.fact_folder(spark, path) == first
    assert number(load.scan_fact(spark, path).first().primary_value) == 1.0
    # Half a version without a pointer is not read either.
    spark.range(3).write.parquet(f"{path}/versions/half")
    assert load.scan_fact(spark, path).count() == 1
    more = rows.unionByName(rows.withColumn("partner_code", F.lit("410")))
    load.refresh_fact(spark, path, more, dims, codes, PARAMS, full=True)
    assert load.fact_folder(spark, path) != first and load.scan_fact(spark, path).count() == 2


def test_months_come_from_the_audit_log_alone(spark, done):
    audit = load.scan_audit(spark, f"{done}/tables/audit")
    assert [m.isoformat() for m in load.months_of(load.months_since(audit, None))] == ["2016-01-01"]
    last = audit.agg(F.max("event_at")).first()[0]
    feed = load.months_since(audit, last)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert all("/audit/event_date=" in name for name in feed.inputFiles())
    assert "PartitionFilters: [isnotnull(event_date" in plan
    later = last.replace(year=last.year + 1)
    assert load.months_of(load.months_since(audit, later)) == []


def test_files_of_any_size_are_hashed(spark, tmp_path):
    land_month(tmp_path)
    odd = {"201602": b'{"a":1}\n\n{"b":"\xc3\xa9"}\r\n', "201603": b"no end of line", "201604": b"\n" * 300 + b"x\n", "201605": b"z" * 9000 + b"\n"}
    for period, text in odd.items():
        folder = land(tmp_path / "landing", [record(156, 1, period=period)])
        (folder / "data.ndjson").write_bytes(text)
    root = f"{tmp_path}/landing"
    whole = {tuple(r) for r in source.scan_checksums(spark, root).collect()}
    assert len(whole) == 8
    assert {tuple(r) for r in source.scan_checksums(spark, root, whole_bytes=0).collect()} == whole
    assert {tuple(r) for r in source.scan_checksums(spark, root, whole_bytes=200).collect()} == whole
    try:  # each file in several splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        assert {tuple(r) for r in source.scan_checksums(spark, root, whole_bytes=0).collect()} == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_landed_extracts_are_read_back_as_they_were(spark, tmp_path):
    rows = raw(
        spark,
        [{"month": m, "partner": p, "value": v, "cmd": CMD, "hs": "H4", "revision": 2} for m in ("2016-01-01", "2016-02-01") for p, v in (("156", "1.5"), ("36", "2"))],
    ).withColumn("query_type", F.lit("partner_detail"))
    landing.land_extracts(rows, str(tmp_path / "landing"))
    manifests = source.scan_manifests(spark, str(tmp_path / "landing"))
    lines = landing.parse_records(source.scan_lines(spark, str(tmp_path / "landing")))
    found = landing.reconcile(manifests, lines, source.scan_checksums(spark, str(tmp_path / "landing")))
    assert [r.reasons for r in found.collect()] == [[], []]
    assert {(r.period, r.row_count, number(r.primary_value_sum)) for r in landing.accepted(found).collect()} == {("201601", 2, 3.5), ("201602", 2, 3.5)}
    columns = ("period", "partner_code", "primary_value")
    assert sorted(map(tuple, lines.select(*columns).collect())) == sorted(map(tuple, rows.select(*columns).collect()))
