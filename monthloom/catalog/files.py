"""Writers and readers of files, and checks of what a folder or a batch holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthloom.catalog.loading import FACT_OUT, UNIT_OUT, extracts
from monthloom.catalog.oracle import money
from monthloom.catalog.registry import STAR, Tables, query
from monthloom.catalog.scalars import _digits
from monthloom.operators import aggregate, revision
from monthloom.plans import load
from monthloom.sources import landing
from monthloom.sources.snapshot import write_csv

DETAIL = ("period", "reporter_code", "cmd_code", "partner_code", "revision", "primary_value")


@query(
    "csv_file",
    f"""SELECT period, rep AS reporter_code, cmd AS cmd_code, par AS partner_code,
  CAST(rev AS VARCHAR) AS revision, CAST(v // 100 AS VARCHAR) || ({_digits("v")}) AS primary_value
FROM t_detail""",
)
def csv_file(t: Tables):
    """Detail rows written as CSV and read back as text."""
    path = f"{t.scratch()}/detail.csv"
    write_csv(t.panel.detail.select(*DETAIL), path)
    schema = ", ".join(f"{name} string" for name in DETAIL)
    return t.spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query(
    "audit_log",
    f"""SELECT period, cmd AS cmd_code, rev AS revision, src AS source_file, n AS actual_row_count,
  {money("total", "actual_primary_value_sum")}, 'success' AS status, CAST(1 AS BIGINT) AS times
FROM t_extracts""",
)
def audit_log(t: Tables):
    """Success events in the log; completing it a second time adds none."""
    path = f"{t.scratch()}/audit"
    loaded = extracts(t.panel.detail).withColumn("kind", F.lit("partner_detail"))
    load.complete_audit(t.spark, loaded, path)
    load.complete_audit(t.spark, loaded, path)
    logged = load.scan_audit(t.spark, path)
    return logged.groupBy(
        "period", "cmd_code", "revision", "source_file", "actual_row_count",
        "actual_primary_value_sum", "status",
    ).agg(F.count("*").alias("times"))


@query(
    "full_refresh",
    f"""SELECT {UNIT_OUT}, par AS partner_code, hs AS hs_version, rev AS revision,
  {money("v", "primary_value")} FROM t_fact""",
)
def full_refresh(t: Tables):
    """The fact written whole and read back."""
    path, p = f"{t.scratch()}/fact", t.panel
    load.refresh_fact(t.spark, path, p.detail, p.countries, p.hs_codes, STAR, full=True)
    return load.scan_fact(t.spark, path).select(*FACT_OUT)


@query(
    "lineage_stamp",
    """SELECT period, rep AS reporter_code, cmd AS cmd_code, par AS partner_code, rev AS revision,
  src AS source_file, chk AS checksum, 'multi-' || period || '-' || rep || '-' || cmd || '-r' || rev AS run_id
FROM t_detail""",
)
def lineage_stamp(t: Tables):
    """Rows that get run, version and file from their extract."""
    key = ("period_start_date", "reporter_code", "cmd_code", "hs_version")
    rows = t.panel.detail.select(*key, "period", "partner_code")
    stamped = revision.stamp_lineage(rows, extracts(t.panel.detail), key)
    return stamped.select(*DETAIL[:5], "source_file", "checksum", "run_id")


@query(
    "duplicate_in_batch",
    f"""SELECT {UNIT_OUT}, count(*) AS row_count FROM t_extracts GROUP BY m, rep, cmd HAVING count(*) > 1""",
)
def duplicate_in_batch(t: Tables):
    """Units for which a batch brings several extracts."""
    return aggregate.duplicates(extracts(t.panel.detail), load.UNIT)


@query("uncommitted_folders", "SELECT src AS extract, n AS length FROM t_extracts WHERE rev = 3")
def uncommitted_folders(t: Tables):
    """Data without a manifest: the newest revisions lack theirs."""
    found = extracts(t.panel.detail).select(
        F.col("source_file").alias("extract"), F.col("row_count").alias("length"), "revision"
    )
    manifests = found.where(F.col("revision") < 3).select("extract")
    return landing.uncommitted(found.drop("revision"), manifests)
