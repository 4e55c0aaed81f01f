"""Landing, loading, refreshing, streaming and publishing on files."""

from __future__ import annotations

import hashlib
import json
from datetime import date
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F
from rows import countries, hs_codes, number, raw

from monthloom.params import PRODUCTS, Params
from monthloom.plans import landing, load, publish
from monthloom.plans.multi_market import MultiMarket
from monthloom.sources import landing as source
from monthloom.sources.raw import overwrite_partitions, scan_table, write_table
from monthloom.streaming.extracts import load_batch, stream_extracts

CMD = "854231"
DIMS = [("156", "country", "verified", "CHN"), ("410", "country", "verified", "KOR")]
PARAMS = Params(start=date(2016, 1, 1), end=date(2016, 3, 1))


def record(partner, value, reporter=842, period="201601", hs="H4", **changes):
    row = {
        "period": period,
        "reporterCode": reporter,
        "partnerCode": partner,
        "flowCode": "M",
        "freqCode": "M",
        "cmdCode": CMD,
        "partner2Code": 0,
        "customsCode": "C00",
        "motCode": 0,
        "classificationCode": hs,
        "isOriginalClassification": True,
        "primaryValue": str(value),
        "netWgt": None,
        "qty": "1.5",
    }
    return {**row, **changes}


def land(root, records, revision=1, kind="partner_detail", manifest=None, data=None):
    """Write one extract the way the source stores it."""
    first = records[0]
    folder = root / (
        f"v3/reporter_code={first['reporterCode']}/hs_version={first['classificationCode']}/cmd_code={CMD}/"
        f"period={first['period']}/query_type={kind}/revision={revision}"
    )
    folder.mkdir(parents=True)
    text = "".join(json.dumps(r, sort_keys=True, separators=(",", ":")) + "\n" for r in records)
    body = (text if data is None else data).encode()
    (folder / "data.ndjson").write_bytes(body)
    request = {
        "reporterCode": first["reporterCode"],
        "period": first["period"],
        "cmdCode": CMD,
        "flowCode": "M",
        "partner2Code": 0,
        "customsCode": "C00",
        "motCode": 0,
    }
    if kind == "world_total":
        request["partnerCode"] = 0
    with localcontext() as context:
        context.prec = 80
        amounts = [r["primaryValue"] for r in records]
        total = sum((Decimal(v) for v in amounts if isinstance(v, str)), Decimal(0))
    content = {
        "request_parameters": request,
        "checksum": "sha256:" + hashlib.sha256(text.encode()).hexdigest(),
        "schema_version": "2.0.0",
        "hs_version": first["classificationCode"],
        "period": first["period"],
        "query_type": kind,
        "cmd_code": CMD,
        "revision": revision,
        "row_count": len(records),
        "primary_value_sum": str(total),
        "ingested_at": f"2016-02-0{revision}T00:00:00+00:00",
        "source": "test",
        **(manifest or {}),
    }
    (folder / "manifest.json").write_text(json.dumps(content, indent=2))
    return folder


def checked(spark, root):
    rows = landing.parse_records(source.scan_lines(spark, str(root)))
    found = landing.reconcile(
        source.scan_manifests(spark, str(root)), rows, source.scan_checksums(spark, str(root))
    )
    return found, rows


def run_load(spark, root, tables):
    found, rows = checked(spark, root)
    return load.load_extracts(spark, str(tables), landing.accepted(found), rows)


def stored(spark, tables, kind="partner_detail"):
    rows = scan_table(spark, f"{tables}/{kind}").collect()
    return {(r.reporter_code, r.partner_code, number(r.primary_value), r.revision) for r in rows}


def first_batch(root):
    land(root, [record(156, 100), record(410, 200)])
    land(root, [record(156, 100, 156), record(410, 200, 156)])
    land(root, [record(0, 300)], kind="world_total")
    land(root, [record(0, 300, 156)], kind="world_total")


def test_load_replay_replace_and_stale(spark, tmp_path):
    tables = tmp_path / "tables"
    first_batch(tmp_path / "a")
    assert run_load(spark, tmp_path / "a", tables)["status"] == "success"
    assert len(stored(spark, tables)) == 4 and len(stored(spark, tables, "world_total")) == 2
    assert load.scan_audit(spark, f"{tables}/audit").count() == 4
    assert run_load(spark, tmp_path / "a", tables)["status"] == "already_loaded"
    assert load.scan_audit(spark, f"{tables}/audit").count() == 4
    token = load.change_token(load.scan_audit(spark, f"{tables}/audit"))
    assert token[0] == 4
    load.require_unmoved(token, load.scan_audit(spark, f"{tables}/audit"))
    land(tmp_path / "b", [record(156, 150, hs="H5")], revision=2)
    land(tmp_path / "b", [record(0, 150, hs="H5")], revision=2, kind="world_total")
    assert run_load(spark, tmp_path / "b", tables)["status"] == "success"
    after = {("842", "156", 150.0, 2), ("156", "156", 100.0, 1), ("156", "410", 200.0, 1)}
    assert stored(spark, tables) == after
    with pytest.raises(ValueError, match="while the stage ran"):
        load.require_unmoved(token, load.scan_audit(spark, f"{tables}/audit"))
    with pytest.raises(ValueError, match="stale_revision"):
        run_load(spark, tmp_path / "a", tables)
    land(tmp_path / "c", [record(156, 151, hs="H5")], revision=2)
    with pytest.raises(ValueError, match="conflict"):
        run_load(spark, tmp_path / "c", tables)
    assert stored(spark, tables) == after


def test_lost_audit_events_are_completed_by_a_rerun(spark, tmp_path):
    first_batch(tmp_path / "a")
    tables = tmp_path / "tables"
    found, rows = checked(spark, tmp_path / "a")
    extracts = landing.accepted(found)
    load.load_extracts(spark, str(tables), extracts.where("kind = 'partner_detail'"), rows)
    write_table(scan_table(spark, f"{tables}/partner_detail"), str(tmp_path / "copy/partner_detail"))
    assert load.load_extracts(
        spark, str(tmp_path / "copy"), extracts.where("kind = 'partner_detail'"), rows
    )["status"] == "already_loaded"
    assert load.scan_audit(spark, str(tmp_path / "copy/audit")).count() == 2


def test_rows_of_another_flow_stay(spark, tmp_path):
    tables = tmp_path / "tables"
    land(tmp_path / "a", [record(156, 100), record(410, 200)])
    run_load(spark, tmp_path / "a", tables)
    path = f"{tables}/partner_detail"
    exports = scan_table(spark, path).withColumn("flow_code", F.lit("X")).withColumn("revision", F.lit(7))
    exports = spark.createDataFrame(exports.collect(), exports.schema)
    overwrite_partitions(scan_table(spark, path).unionByName(exports).checkpoint(), path)
    land(tmp_path / "b", [record(156, 150)], revision=2)
    assert run_load(spark, tmp_path / "b", tables)["status"] == "success"
    rows = {(r.flow_code, r.partner_code, r.revision) for r in scan_table(spark, path).collect()}
    assert rows == {("M", "156", 2), ("X", "156", 7), ("X", "410", 7)}


def test_a_refresh_must_bring_what_was_accepted(spark):
    from monthloom.operators.revision import assign_revision, require_refreshed

    key = {"reporter_code": "842", "cmd_code": CMD, "query_type": "world_total"}
    wanted = [{**key, "period": p} for p in ("201601", "201602")]
    requested = spark.createDataFrame(wanted)
    accepted = spark.createDataFrame([{**wanted[0], "revision": 1, "checksum": "a"}])
    fetched = spark.createDataFrame([{**wanted[1], "checksum": "b"}])
    decided = assign_revision(requested, fetched, accepted)
    with pytest.raises(ValueError, match="1 accepted extracts are missing"):
        require_refreshed(decided)
    require_refreshed(decided.where("action <> 'missing_refresh'"))


REJECTIONS = [
    ({"primaryValue": 1.5}, None, "rows"),
    ({"primaryValue": "1e3"}, {"primary_value_sum": "1000"}, "rows"),
    ({"primaryValue": "-1"}, None, "rows"),
    ({"flowCode": "X"}, None, "rows"),
    ({"isOriginalClassification": False}, None, "rows"),
    ({"isOriginalClassification": None}, None, "rows"),
    ({"partner2Code": 7}, None, "rows"),
    ({"netWgt": "1,5"}, None, "rows"),
    ({"partnerCode": 0}, None, "rows"),
    ({"partnerCode": 410}, None, "duplicate_grain"),
    ({}, {"row_count": 3}, "row_count"),
    ({}, {"primary_value_sum": "300.000000001"}, "amount_sum"),
    ({}, {"checksum": "sha256:0"}, "checksum"),
    ({}, {"schema_version": "1.0.0"}, "schema_version"),
    ({}, {"revision": 7}, "path_identity"),
    ({}, {"ingested_at": "2016-02-01T00:00:00"}, "ingested_at"),
    ({}, {"cmd_code": "854299"}, "product"),
    ({}, {"request_parameters": {"reporterCode": 842}}, "request_identity"),
]


def test_rejections(spark, tmp_path):
    """One extract per case, told apart by its reporter; the last one is sound."""
    for place, (change, manifest, _) in enumerate(REJECTIONS, start=100):
        land(tmp_path, [record(410, 200, place), record(156, 100, place, **change)], manifest=manifest)
    land(tmp_path, [record(410, 200), record(156, 100)])
    found, _ = checked(spark, tmp_path)
    found = found.select("path_reporter_code", "reasons").collect()
    reasons = {r.path_reporter_code: r.reasons for r in found}
    assert len(reasons) == len(REJECTIONS) + 1
    for place, (*_, reason) in enumerate(REJECTIONS, start=100):
        assert reason in reasons[str(place)], (place, reason, reasons[str(place)])
    assert reasons["842"] == []


def test_whole_and_exact_extract_is_accepted(spark, tmp_path):
    big = "123456789012345678901.123456789"
    land(tmp_path, [record(156, big), record(410, big)])
    row = landing.accepted(checked(spark, tmp_path)[0]).first()
    assert row.primary_value_sum == Decimal("246913578024691357802.246913578")
    assert row.source_file.endswith("revision=1/data.ndjson")


def test_world_extract_has_one_row_and_data_needs_a_manifest(spark, tmp_path):
    land(tmp_path, [record(0, 1), record(0, 2)], kind="world_total")
    assert "world_rows" in checked(spark, tmp_path)[0].first().reasons
    lone = land(tmp_path, [record(156, 1, period="201602")])
    (lone / "manifest.json").rename(lone / "kept.txt")
    sums = source.scan_checksums(spark, str(tmp_path))
    left = source.uncommitted(sums, source.scan_manifests(spark, str(tmp_path)))
    assert [r.extract.split("period=")[1][:6] for r in left.collect()] == ["201602"]


def test_canonical_text_matches_hashlib(spark):
    rows = raw(
        spark,
        [{"month": "2016-01-01", "partner": p, "value": 1, "cmd": CMD} for p in ("410", "36", "156")],
    )
    columns = ("period", "partner_code", "net_weight")
    made = landing.serialize_extracts(rows, ("period", "reporter_code"), columns).first()
    lines = [
        json.dumps({"period": "201601", "partner_code": p, "net_weight": None}, sort_keys=True, separators=(",", ":"))
        for p in ("36", "156", "410")
    ]
    text = "\n".join(lines) + "\n"
    assert made.data == text
    assert made.checksum == "sha256:" + hashlib.sha256(text.encode()).hexdigest()
    key = ("period", "reporter_code")
    shuffled = landing.digest_extracts(rows.orderBy("partner_code"), key, columns).first()
    assert (shuffled.row_count, number(shuffled.primary_value_sum)) == (3, 3.0)
    assert shuffled.content_digest == landing.digest_extracts(rows, key, columns).first().content_digest
    fewer = landing.digest_extracts(rows.where("partner_code <> '36'"), key, columns).first()
    assert fewer.content_digest != shuffled.content_digest


def test_decisions(spark):
    from monthloom.operators.revision import load_decision

    columns = "k string, revision long, checksum string, row_count long, revisions long, checksums long"
    known = spark.createDataFrame([("k", 2, "a", 5, 1, 1)], columns)
    incoming = spark.createDataFrame(
        [("new", 1, "a"), ("k", 1, "a"), ("k", 2, "a"), ("k", 2, "b"), ("k", 3, "b")],
        "k string, revision long, checksum string",
    )
    found = [r.decision for r in load_decision(incoming, known, ["k"]).orderBy("k", "revision", "checksum").collect()]
    assert found == ["stale_revision", "already_loaded", "conflict", "load", "load"]


def test_newest_revision_is_chosen_and_ambiguous_ones_are_named(spark, tmp_path):
    land(tmp_path, [record(156, 1)], revision=1)
    land(tmp_path, [record(156, 2, hs="H5")], revision=2)
    land(tmp_path, [record(156, 3, 156)], revision=1)
    land(tmp_path, [record(156, 4, 156, hs="H5")], revision=1)
    found, rows = checked(spark, tmp_path)
    chosen, ambiguous = landing.newest_extracts(landing.accepted(found))
    assert [(r.reporter_code, r.revision) for r in chosen.collect()] == [("842", 2)]
    assert {r.hs_version for r in ambiguous.collect()} == {"H4", "H5"}
    load.load_extracts(spark, str(tmp_path / "tables"), chosen, rows)
    assert stored(spark, tmp_path / "tables") == {("842", "156", 2.0, 2)}
    with pytest.raises(ValueError, match="several extracts for one unit"):
        load.load_extracts(spark, str(tmp_path / "tables"), landing.accepted(found), rows)


def test_ambiguous_revisions_are_counted(spark):
    from monthloom.operators.revision import latest_manifests

    rows = spark.createDataFrame(
        [("842", "c", "201601", "d", 1, "x"), ("842", "c", "201601", "d", 1, "y"), ("1", "c", "201601", "d", 2, "x")],
        "reporter_code string, cmd_code string, period string, query_type string, revision long, checksum string",
    )
    assert {r.reporter_code: r.copies for r in latest_manifests(rows).collect()} == {"842": 2, "1": 1}


def test_mixed_versions_stop_a_load(spark, tmp_path):
    first_batch(tmp_path / "a")
    rows = raw(
        spark,
        [
            {"month": "2016-01-01", "partner": "156", "value": 1, "cmd": CMD, "revision": 1},
            {"month": "2016-01-01", "partner": "410", "value": 1, "cmd": CMD, "revision": 2},
        ],
    )
    write_table(rows, str(tmp_path / "tables/partner_detail"))
    with pytest.raises(ValueError, match="stored in several versions"):
        run_load(spark, tmp_path / "a", tmp_path / "tables")


def fact_months(spark, path):
    return {
        (r.period_start_date.isoformat()[:7], r.partner_code, number(r.primary_value))
        for r in load.scan_fact(spark, path).collect()
    }


def test_fact_refresh_replaces_and_empties_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    dims, codes = countries(spark, DIMS), hs_codes(spark, [("H4", CMD)])
    base = {"cmd": CMD, "hs": "H4", "partner": "156"}
    months = ("2016-01-01", "2016-02-01", "2016-03-01")
    old = raw(spark, [{**base, "month": m, "value": 1} for m in months])
    load.refresh_fact(spark, path, old, dims, codes, PARAMS)
    new = raw(
        spark,
        [
            {**base, "month": months[0], "value": 9},
            {**base, "month": months[1], "value": 9, "ingested": "2024-02-01T00:00:00", "revision": 2},
            {**base, "month": months[2], "value": 9, "partner": "999", "ingested": "2024-02-01T00:00:00"},
        ],
    )
    assert load.refresh_fact(spark, path, new, dims, codes, PARAMS, []) == []
    assert len(fact_months(spark, path)) == 3
    touched = load.refresh_fact(spark, path, new, dims, codes, PARAMS, [date(2016, 2, 1), date(2016, 3, 1)])
    assert len(touched) == 2
    assert fact_months(spark, path) == {("2016-01", "156", 1.0), ("2016-02", "156", 9.0)}
    later = new.withColumn("ingested_at", F.to_timestamp(F.lit("2025-01-01T00:00:00Z")))
    assert len(load.refresh_fact(spark, path, later, dims, codes, PARAMS)) == 3
    load.refresh_fact(spark, path, old, dims, codes, PARAMS, full=True)
    assert len(fact_months(spark, path)) == 3


def test_partition_overwrite_keeps_other_months_and_code_zeros(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = raw(spark, [{"month": m, "partner": "004", "value": 1} for m in ("2016-01-01", "2016-02-01")])
    write_table(rows, path)
    overwrite_partitions(raw(spark, [{"month": "2016-02-01", "partner": "004", "value": 2}]), path)
    found = {(r.period, r.partner_code, number(r.primary_value)) for r in scan_table(spark, path).collect()}
    assert found == {("201601", "004", 1.0), ("201602", "004", 2.0)}


def test_stream_loads_arrivals_and_skips_outdated_ones(spark, tmp_path):
    root, tables = tmp_path / "landing", tmp_path / "tables"
    dims, codes = countries(spark, DIMS), hs_codes(spark, [("H4", CMD), ("H5", CMD)])

    def run():
        query = stream_extracts(
            spark, str(root), str(tables), str(tmp_path / "state"), dims, codes, PARAMS
        )
        query.awaitTermination(120)
        assert query.exception() is None

    first_batch(root)
    run()
    assert len(stored(spark, tables)) == 4
    land(root, [record(156, 150, hs="H5")], revision=3)
    land(root, [record(156, 1, flowCode="X", period="201602")])
    run()
    assert ("842", "156", 150.0, 3) in stored(spark, tables) and len(stored(spark, tables)) == 3
    land(root, [record(156, 120, hs="H5")], revision=2)
    run()
    assert len(stored(spark, tables)) == 3
    assert spark.read.json(str(tables / "rejected")).count() == 1
    assert fact_months(spark, str(tables / "fact")) == {
        ("2016-01", "156", 150.0),
        ("2016-01", "156", 100.0),
        ("2016-01", "410", 200.0),
    }


def test_a_conflict_is_set_aside_and_the_rest_of_its_batch_loads(spark, tmp_path):
    root, tables = tmp_path / "landing", tmp_path / "tables"
    dims, codes = countries(spark, DIMS), hs_codes(spark, [("H4", CMD), ("H5", CMD)])
    first_batch(root)
    run_load(spark, root, tables)
    land(root, [record(156, 999, hs="H5")])
    land(root, [record(156, 70, 156, hs="H5")], revision=2)
    files = [str(p) for p in root.rglob("manifest.json") if "hs_version=H5" in str(p)]
    batch = spark.createDataFrame([("file:" + f, open(f).read()) for f in files], "manifest_file string, value string")
    for _ in range(2):  # as after a failure behind the writes
        load_batch(batch, str(tables), dims, codes, PARAMS, number=4)
        assert stored(spark, tables) == {("842", "156", 100.0, 1), ("842", "410", 200.0, 1), ("156", "156", 70.0, 2)}
        refused = spark.read.json(str(tables / "rejected")).collect()
        assert [(r.reasons, r.batch) for r in refused] == [(["conflict"], 4)]


def marts(spark):
    detail = [
        {"month": m, "partner": p, "value": v, "cmd": CMD, "hs": "H4"}
        for m in ("2016-01-01", "2016-03-01")
        for p, v in (("156", "60.25"), ("410", 0))
    ]
    world = [{"month": "2016-01-01", "value": 100, "cmd": CMD, "hs": "H4"}]
    codes = hs_codes(spark, [("H4", c) for c in PRODUCTS])
    return MultiMarket(raw(spark, detail), raw(spark, world), countries(spark, DIMS), codes, PARAMS)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    built, out = marts(spark), str(tmp_path_factory.mktemp("published"))
    return built, out, publish.publish_snapshot(built.monthly, built.partners, out, PARAMS)


def test_snapshot_round_trip_and_damage(spark, tmp_path):
    built, out = marts(spark), str(tmp_path / "out")
    snapshot = publish.publish_snapshot(built.monthly, built.partners, out, PARAMS)
    assert publish.verify_snapshot(spark, out, PARAMS) == snapshot
    folder = publish.snapshot_folder(out, snapshot)
    monthly, partners = publish.read_snapshot(spark, folder)
    assert partners.where("partner_code = '156'").first().import_value == "60.25"
    assert monthly.where("month = '2016-02-01'").first().world_value is None
    delivered = publish.typed_rows(partners, publish.PARTNER_SCHEMA)
    assert publish.delivery_differences(built.partners, delivered).count() == 0
    manifest = spark.read.json(f"{folder}/manifest").first()
    assert (manifest.valid_detail_count, manifest.positive_amount_count) == (4, 2)
    assert manifest.latest_data_month == "2016-03-01" and len(manifest.markets) == 10
    index = spark.read.json(f"{folder}/files/partners").agg(F.sum("rows")).first()[0]
    assert index == partners.count()
    held = next((tmp_path / f"out/snapshots/{snapshot}/manifest").glob("part-*.json"))
    (held.parent / f".{held.name}.crc").unlink()
    sound = held.read_text()
    for field in ("schema_version", "snapshot_id", "currency", "hhi_coverage_tolerance", "markets", "products"):
        content = json.loads(sound)
        content[field] = content[field][:-1]
        held.write_text(json.dumps(content) + "\n")
        with pytest.raises(ValueError, match="not the published one"):
            publish.verify_snapshot(spark, out, PARAMS)
        with pytest.raises(ValueError, match=f"differ: {field}"):
            publish.verify_identity(spark, folder, snapshot, PARAMS)
    held.write_text(sound)
    publish.verify_snapshot(spark, out, PARAMS)
    part = next((tmp_path / f"out/snapshots/{snapshot}/partners").rglob("*.json.gz"))
    # Hadoop's own sidecar would complain first.
    (part.parent / f".{part.name}.crc").unlink()
    part.write_bytes(part.read_bytes() + b"x")
    with pytest.raises(ValueError, match="checksum mismatch"):
        publish.verify_snapshot(spark, out, PARAMS)


@pytest.mark.parametrize(
    ("spoil", "message"),
    [
        (lambda m, p: (m, p.unionByName(p.limit(1))), "duplicate partner grain"),
        (lambda m, p: (m.where("month <> date'2016-02-01'"), p), "incomplete month spine"),
        (lambda m, p: (m, p.withColumn("partner_code", F.lit("490"))), "invalid partner row"),
        (lambda m, p: (m, p.withColumn("partner_code", F.lit("0490"))), "invalid partner row"),
        (lambda m, p: (m, p.withColumn("map_iso3", F.lit("usa"))), "invalid partner row"),
        (lambda m, p: (m.withColumn("hhi_status", F.lit("fine")), p), "invalid month row"),
        (lambda m, p: (m, p.withColumn("reporter_code", F.lit("156"))), "outside the monthly range"),
        (
            lambda m, p: (m.withColumns({"has_world": F.lit(False), "has_countries": F.lit(False)}), p),
            "no month has data",
        ),
    ],
)
def test_bad_rows_leave_the_published_version(spark, published, spoil, message):
    built, out, kept = published
    with pytest.raises(ValueError, match=message):
        publish.publish_snapshot(*spoil(built.monthly, built.partners), out, PARAMS)
    assert publish.current_snapshot(spark, out) == kept


def test_gate_blocks_publishing(spark, tmp_path):
    from monthloom.plans.quality import quality_gate

    results = [("monthly", "model", "success", "b"), ("contract", "check", "pass", "b")]
    schema = "name string, kind string, status string, build_id string"

    def publishable(rows, required=("monthly", "contract")):
        return quality_gate(spark.createDataFrame(rows, schema), required).first().publishable

    assert publishable(results)
    assert not publishable([results[0], ("contract", "check", "fail", "b")])
    assert not publishable([results[0], ("contract", "check", "pass", "other")])
    assert not publishable(results[:1])
    gate = quality_gate(spark.createDataFrame(results[:1], schema), ("monthly", "contract"))
    built = marts(spark)
    with pytest.raises(ValueError, match="did not pass"):
        publish.publish_snapshot(built.monthly, built.partners, str(tmp_path), PARAMS, gate)
