"""The panel by line: what lies together once is not shuffled again, and rows stay the same."""

import re

import duckdb
import pytest
from comparison import difference, rows_of_spark, rows_of_sql
from pyspark.sql import functions as F
from rows import raw

from monthloom.catalog import ORACLES, QUERIES
from monthloom.operators import revision
from monthloom.plans import load

STAR = {
    "region": "SELECT i::INT AS r_regionkey, r AS r_name FROM (VALUES (0, 'ASIA'), (1, 'EUROPE'), (2, 'AFRICA')) x(i, r)",
    "nation": "SELECT i::INT AS n_nationkey, 'N' || i AS n_name, (i % 3)::INT AS n_regionkey FROM range(6) x(i)",
    "customer": "SELECT i::BIGINT AS c_custkey, (i % 6)::INT AS c_nationkey FROM range(12) x(i)",
    "supplier": "SELECT i::BIGINT AS s_suppkey, (i % 6)::INT AS s_nationkey FROM range(1, 9) x(i)",
    "part": "SELECT i::BIGINT AS p_partkey, 'LARGE' AS p_type FROM range(1, 8) x(i)",
    "orders": """SELECT i::BIGINT AS o_orderkey, (i % 12)::BIGINT AS o_custkey,
        TIMESTAMP '1996-01-01' + i * INTERVAL 5 DAY AS o_orderdate FROM range(200) x(i)""",
    "lineitem": """SELECT (i % 200)::BIGINT AS l_orderkey, (i % 9)::BIGINT AS l_partkey,
        (i % 10)::BIGINT AS l_suppkey, (i % 7 + 1)::INT AS l_linenumber, (i % 50)::DOUBLE AS l_quantity,
        (i * 1.25)::DOUBLE AS l_extendedprice,
        TIMESTAMP '1996-11-01' + (i % 5) * INTERVAL 31 DAY AS l_shipdate FROM range(3000) x(i)""",
}


@pytest.fixture(scope="module")
def star(tmp_path_factory):
    """Lines of few months, parts and suppliers: extracts of many rows, scopes of three versions."""
    folder = tmp_path_factory.mktemp("star")
    con = duckdb.connect()
    for name, sql in STAR.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


def run(spark, star, name):
    """The plan of a query over the star, once its rows agree with the SQL."""
    folder, con = star
    frame = QUERIES[name](spark, folder)
    assert difference(rows_of_spark(frame), rows_of_sql(con, ORACLES[name])) is None
    return frame._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]


def shuffles(plan):
    """Shuffles by hash, but for those that join the star's tables."""
    keys = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    return sum(not key.endswith(("orderkey", "custkey", "partkey", "suppkey", "nationkey")) for key in keys)


def test_accepted_extract_by_line_moves_rows_once(spark, star):
    assert shuffles(run(spark, star, "line_accepted_latest_extract")) == 1


def test_clustered_acceptance_gives_the_same_rows(spark):
    rows = raw(
        spark,
        [
            {"month": "2020-01-01", "reporter": r, "partner": p, "revision": v, "file": f}
            for r in ("842", None)
            for p, v, f in (("1", 1, "a"), ("1", 2, "b"), ("2", 2, "b"), ("2", 2, "b"), ("3", 2, None), ("4", None, "z"))
        ],
    )
    plain = revision.accept_latest_extract(rows).collect()
    assert sorted(map(str, revision.accept_latest_extract(rows, clustered=True).collect())) == sorted(map(str, plain))
    assert len(plain) == 6


def test_full_replace_by_line_moves_each_table_once(spark, star):
    assert shuffles(run(spark, star, "line_full_source_replace")) <= 3


def test_replace_keeps_rows_without_a_key_and_of_other_flows(spark):
    stored = raw(
        spark,
        [
            {"month": "2020-01-01", "reporter": "842", "partner": "1"},
            {"month": "2020-01-01", "reporter": None, "partner": "2"},
            {"month": "2020-01-01", "reporter": "842", "partner": "3", "flow": "X"},
            {"month": "2020-01-01", "reporter": "842", "partner": "4", "flow": None},
            {"month": "2020-02-01", "reporter": "842", "partner": "5"},
        ],
    )
    incoming = stored.where("partner_code IN ('1', '2')").withColumn("revision", F.lit(2).cast("long"))
    found = load.replace_units(stored, incoming, incoming).select("partner_code", "revision")
    assert sorted(map(tuple, found.collect())) == [("1", 2), ("2", 1), ("2", 2), ("3", 1), ("4", 1), ("5", 1)]


def test_mixed_versions_by_line_moves_rows_once(spark, star):
    plan = run(spark, star, "line_mixed_versions")
    assert shuffles(plan) == 1 and "Expand" not in plan


def test_stored_versions_count_null_as_none(spark):
    rows = raw(
        spark,
        [
            {"month": "2020-01-01", "revision": v, "checksum": c}
            for v, c in ((1, "a"), (1, "a"), (2, "a"), (2, None), (None, "b"))
        ],
    )
    found = revision.stored_versions(rows).first()
    assert (found.revision, found.checksum, found.row_count, found.revisions, found.checksums) == (2, "b", 5, 2, 2)


def test_load_decision_by_line_moves_each_table_once(spark, star):
    assert shuffles(run(spark, star, "line_load_decision")) == 2


def test_raw_table_by_line_is_written_where_ranges_of_months_lie(spark, star, monkeypatch):
    from monthloom.catalog import loading

    written = []

    def watched(frame, path, **options):
        written.append(frame._jdf.queryExecution().executedPlan().toString())
        load.write_table(frame, path, **options)
        assert options["dealt"]

    monkeypatch.setattr(loading, "write_table", watched)
    run(spark, star, "line_partition_scan")
    assert written[0].count("Exchange rangepartitioning") == 1 and not shuffles(written[0])


def test_accepted_row_by_line_reads_the_panel_once(spark, star):
    plan = run(spark, star, "line_accepted_latest_row")
    assert shuffles(plan) == 1 and plan.count("lineitem.parquet") == 1


def test_clustered_rows_give_the_same_row(spark):
    rows = raw(
        spark,
        [
            {"month": "2020-01-01", "reporter": r, "partner": p, "revision": v, "value": x}
            for r in ("842", None)
            for p, v, x in (("1", 1, 5), ("2", 2, None), ("2", 2, 3), ("1", 2, 9), ("4", None, 7))
        ],
    )
    plain = sorted(map(str, revision.accept_latest_row(rows).collect()))
    found = revision.accept_latest_row(rows, clustered=True)
    assert sorted(map(str, found.collect())) == plain and len(plain) == 2
    assert found.columns == rows.columns


def test_reconciliation_by_line_shuffles_facts_only_for_their_join(spark, star):
    assert shuffles(run(spark, star, "line_reconcile_load")) <= 4


def test_reconciliation_by_line_joins_facts_where_their_unit_lies(spark, star):
    assert shuffles(run(spark, star, "line_reconcile_load")) == 2


def test_reconciliation_tells_editions_of_a_unit_apart(spark):
    rows = raw(
        spark,
        [
            {"month": "2020-01-01", "reporter": r, "partner": p, "hs": h, "value": x, "file": f}
            for r, h, f, found in (
                ("842", "H4", "fits", (("1", 5), ("2", 7))), ("842", "H5", "sum", (("1", 5), ("2", 8))),
                ("842", "H6", "partners", (("1", 5), ("1", 7))), ("156", "H4", "count", (("1", 12),)),
                ("842", None, "no edition", (("1", 5), ("2", 7))), (None, "H4", "no reporter", (("1", 5), ("2", 7))),
            )
            for p, x in found
        ],
    ).withColumn("kind", F.lit("partner_detail"))
    stated = rows.groupBy("kind", *load.UNIT, "hs_version", "source_file").agg(
        F.lit(2).cast("long").alias("row_count"), F.lit(12).cast("decimal(38,9)").alias("primary_value_sum")
    )
    absent = stated.where("source_file = 'fits'").withColumns({"hs_version": F.lit("H9"), "source_file": F.lit("absent")})
    wrong = load.reconcile_load(stated.union(absent), rows)
    assert {r.source_file: (r.got_rows, r.got_partners) for r in wrong.collect()} == {
        "sum": (2, 2), "partners": (2, 1), "count": (1, 1), "no edition": (None, None), "no reporter": (None, None), "absent": (None, None),
    }
    assert wrong.columns == ["kind", *load.UNIT, "hs_version", "source_file", "row_count", "primary_value_sum", "got_rows", "got_sum", "got_partners"]


def test_paths_by_line_are_dealt_to_parts_that_grow_with_the_table(spark, star, monkeypatch):
    from monthloom.sources import star as source

    monkeypatch.setattr(source, "LINES_A_TASK", 100)
    plan = run(spark, star, "line_path_identity")
    assert plan.count(", 31), REPARTITION_BY_NUM") == shuffles(plan) == 3
