"""Scans, dimensions, accepted versions and the marts of both generations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from monthloom.catalog.oracle import iso, money, nano, stamp
from monthloom.catalog.registry import Tables, query
from monthloom.operators import aggregate
from monthloom.operators.revision import accept_latest_extract, accept_latest_row
from monthloom.operators.select import source_columns
from monthloom.plans.single_market import staging

RAW_SQL = ", ".join(
    [
        "period",
        iso("m", "period_start_date"),
        "rep AS reporter_code",
        "par AS partner_code",
        "'M' AS flow_code",
        "cmd AS cmd_code",
        "hs AS hs_version",
        money("v", "primary_value"),
        "CAST(w AS DOUBLE) AS net_weight",
        "CAST(q AS DOUBLE) AS quantity",
        stamp("ing", "ingested_at"),
        "src AS source_file",
        "chk AS checksum",
        "run AS run_id",
        "rev AS revision",
    ]
)
WORLD_SQL = (
    RAW_SQL.replace("par AS partner_code", "'0' AS partner_code")
    .replace("CAST(w AS DOUBLE) AS net_weight", "CAST(NULL AS DOUBLE) AS net_weight")
    .replace("CAST(q AS DOUBLE) AS quantity", "CAST(NULL AS DOUBLE) AS quantity")
)


@query("raw_detail", f"SELECT {RAW_SQL} FROM t_detail")
def raw_detail(t: Tables):
    return source_columns(t.panel.detail)


@query("raw_world", f"SELECT {WORLD_SQL} FROM t_world")
def raw_world(t: Tables):
    return source_columns(t.panel.world)


@query(
    "staging_scope_range",
    f"SELECT {RAW_SQL} FROM t_detail WHERE m >= DATE '1996-01-01' AND m < DATE '2001-01-01'"
    " AND rep = 'ASIA' AND cmd = 'STANDARD' AND hs = 'H6'",
)
def staging_scope_range(t: Tables):
    """One market, product and edition in a half-open month range."""
    start, end = date(1996, 1, 1), date(2001, 1, 1)
    return staging(t.panel.detail, start, end, "ASIA", "STANDARD", "H6")


@query(
    "dim_countries",
    """SELECT par AS partner_code, name AS source_name, '' AS source_note,
  iso3 AS source_iso_alpha3, is_group AS source_is_group, kind AS partner_type,
  status AS classification_status, map3 AS map_iso3, role AS reconciliation_role,
  'star' AS source_url, '1998-08-02' AS retrieved_at, 'star' AS classification_source_url,
  note AS classification_note, 'star' AS mapping_source_url,
  CAST(NULL AS VARCHAR) AS mapping_note FROM t_country""",
)
def countries(t: Tables):
    return t.countries


@query(
    "dim_hs_codes",
    """SELECT hs AS hs_version, cmd AS cmd_code, descr AS hs_description,
  CAST(6 AS BIGINT) AS code_level, '8542' AS parent_code, 'star' AS source_url,
  '1998-08-02' AS retrieved_at FROM t_hs""",
)
def hs_codes(t: Tables):
    return t.panel.hs_codes


@query(
    "dim_months",
    """WITH top AS (SELECT greatest(DATE '2001-12-01', max(m)) AS hi
  FROM (SELECT m FROM t_detail UNION ALL SELECT m FROM t_world)),
months AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', CAST(hi AS TIMESTAMP),
  INTERVAL 1 MONTH)) AS u FROM top)
SELECT strftime(u, '%Y-%m-%d') AS month_start_date, strftime(u, '%Y%m') AS period,
  CAST(year(u) AS INTEGER) AS year_number, CAST(month(u) AS INTEGER) AS month_number,
  strftime(last_day(CAST(u AS DATE)), '%Y-%m-%d') AS month_end_date FROM months""",
)
def months(t: Tables):
    return t.single.months


@query("accepted_latest_extract", f"SELECT {RAW_SQL} FROM t_accepted")
def accepted_latest_extract(t: Tables):
    return accept_latest_extract(t.panel.detail, clustered=t.by_line)


@query("accepted_latest_row", f"SELECT {WORLD_SQL} FROM t_aworld")
def accepted_latest_row(t: Tables):
    return accept_latest_row(t.panel.world, clustered=t.by_line)


@query(
    "conformed_fact",
    f"""SELECT {RAW_SQL}, name AS source_name, kind AS partner_type,
  cstatus AS classification_status, map3 AS map_iso3, role AS reconciliation_role,
  descr AS hs_description, c_hit AS country_mapping_found, h_hit AS hs_mapping_found,
  true AS month_mapping_found FROM t_single""",
)
def conformed_fact(t: Tables):
    return t.single.fact


@query(
    "conformed_fact_inner",
    f"""SELECT {RAW_SQL}, name AS source_name, map3 AS map_iso3, descr AS hs_description,
  hs_hit AS hs_mapping_found FROM t_fact""",
)
def conformed_fact_inner(t: Tables):
    return t.multi.fact


@query(
    "country_totals",
    f"""SELECT {iso("m", "period_start_date")}, rep AS reporter_code, cmd AS cmd_code,
  hs AS hs_version, {money("v", "country_value")}, n AS country_count,
  round(sq / 1e6, 3) AS sum_squares FROM t_totals""",
)
def country_totals(t: Tables):
    totals = aggregate.country_totals(t.multi.fact)
    return totals.withColumn("sum_squares", F.round(F.col("sum_squares") / F.lit(1e6), 3))


SHARE_SQL = ", ".join(
    [
        RAW_SQL,
        "name AS source_name, kind AS partner_type, cstatus AS classification_status",
        "map3 AS map_iso3, role AS reconciliation_role, descr AS hs_description",
        "c_hit AS country_mapping_found, h_hit AS hs_mapping_found, true AS month_mapping_found",
        money("world", "world_value"),
        nano("share", "market_share"),
        "status AS market_share_status",
        money("pmv", "previous_month_value"),
        money("pyv", "previous_year_value"),
        nano("mom", "mom"),
        nano("yoy", "yoy"),
        nano("unit", "unit_value_usd_per_kg"),
    ]
)


@query("partner_market_share", f"SELECT {SHARE_SQL} FROM t_share")
def partner_market_share(t: Tables):
    return t.single.share


CONC_SQL = ", ".join(
    [
        money("cv", "country_value"),
        "n AS country_count",
        nano("cov", "country_coverage"),
        "round(raw, 4) AS hhi_raw",
        "CASE WHEN status = 'ok' THEN round(raw, 4) END AS hhi",
        "status AS hhi_status",
    ]
)


def _round_hhi(frame):
    names = [n for n in ("hhi_raw", "hhi") if n in frame.columns]
    return frame.withColumns({n: F.round(F.col(n).cast("double"), 4) for n in names})


@query(
    "market_concentration",
    f"""SELECT {iso("m", "period_start_date")}, rep AS reporter_code, cmd AS cmd_code,
  hs AS hs_version, {money("world", "world_value")}, CAST(0 AS BIGINT) AS missing_country_values,
  CAST(0 AS BIGINT) AS negative_country_values, unreviewed AS unreviewed_countries, {CONC_SQL}
FROM t_conc""",
)
def market_concentration(t: Tables):
    return _round_hhi(t.single.concentration)


@query(
    "supply_chain_mart",
    f"""SELECT s.* EXCLUDE (m, rep, cmd, hs), {CONC_SQL}
FROM (SELECT m, rep, cmd, hs, {SHARE_SQL} FROM t_share) s
LEFT JOIN t_conc c ON s.m = c.m AND s.rep = c.rep AND s.cmd = c.cmd AND s.hs = c.hs""",
)
def supply_chain_mart(t: Tables):
    return _round_hhi(t.single.mart)


ISSUES_SQL = """
SELECT d.run, d.m, d.cmd, d.hs, d.par, i.issue, d.src, i.reason, count(*) AS n,
  CAST(sum(d.v) AS BIGINT) AS v
FROM t_detail d LEFT JOIN t_country c USING (par), LATERAL (
  SELECT 'missing_reference' AS issue, 'No reference for source partner_code' AS reason
    WHERE c.par IS NULL
  UNION ALL SELECT 'classification_needs_review', coalesce(c.note, 'No reviewed classification')
    WHERE coalesce(c.status, 'needs_review') <> 'verified'
  UNION ALL SELECT 'reconciliation_unresolved', coalesce(c.note, 'No reviewed classification')
    WHERE coalesce(c.role, 'unresolved') = 'unresolved'
  UNION ALL SELECT 'map_unavailable', 'No verified map mapping' WHERE c.map3 IS NULL) i
GROUP BY ALL"""


@query(
    "mapping_issues",
    f"""WITH x AS ({ISSUES_SQL}) SELECT run AS run_id, {iso("m", "period_start_date")},
  cmd AS cmd_code, hs AS hs_version, par AS partner_code, issue AS issue_type,
  src AS source_file, reason, n AS row_count, {money("v", "primary_value_sum")},
  '1970-01-01 00:00:00' AS observed_at FROM x""",
)
def mapping_issues(t: Tables):
    return t.single.issues


@query(
    "issue_unpivot",
    f"""WITH x AS ({ISSUES_SQL}) SELECT issue AS issue_type, CAST(sum(n) AS BIGINT) AS row_count,
  count(DISTINCT par) AS partners FROM x GROUP BY issue""",
)
def issue_unpivot(t: Tables):
    """Rows and partners per issue type; a row counts once for each of its issues."""
    return t.single.issues.groupBy("issue_type").agg(
        F.sum("row_count").alias("row_count"),
        F.count_distinct("partner_code").alias("partners"),
    )


@query(
    "dashboard_monthly",
    f"""WITH spine AS (SELECT CAST(u AS DATE) AS m, rep, cmd, hs FROM
  (SELECT rep, cmd, hs FROM t_detail UNION SELECT rep, cmd, hs FROM t_world)
  JOIN (SELECT hs, cmd FROM t_hs) USING (hs, cmd),
  (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01',
    INTERVAL 1 MONTH)) AS u)),
x AS (SELECT s.*, w.v AS world, p.v AS pworld, {{growth}} AS yoy, c.cv, coalesce(c.n, 0) AS n,
  c.cov, c.raw, coalesce(c.status, 'missing_world') AS status
  FROM spine s LEFT JOIN t_world w USING (m, rep, cmd, hs)
  LEFT JOIN t_world p ON p.m = s.m - INTERVAL 1 YEAR AND p.rep = s.rep AND p.cmd = s.cmd
    AND p.hs = s.hs
  LEFT JOIN t_conc c ON c.m = s.m AND c.rep = s.rep AND c.cmd = s.cmd AND c.hs = s.hs)
SELECT {iso("m", "month")}, rep AS reporter_code, cmd AS cmd_code, hs AS hs_version,
  {money("world", "world_value")}, {money("pworld", "previous_year_world_value")},
  {nano("yoy", "world_yoy")}, {money("cv", "country_value")}, n AS country_count,
  {nano("cov", "country_coverage")},
  CASE WHEN status = 'ok' THEN round(raw, 4) END AS hhi, status AS hhi_status,
  world IS NOT NULL AS has_world, n > 0 AS has_countries FROM x""".replace(
        "{growth}",
        "CASE WHEN p.v > 0 THEN CAST((2 * CAST(w.v AS HUGEINT) * 1000000000 + p.v)"
        " // (2 * CAST(p.v AS HUGEINT)) AS BIGINT) END - 1000000000",
    ),
)
def dashboard_monthly(t: Tables):
    return _round_hhi(t.single.monthly)


PARTNER_SQL = ", ".join(
    [
        iso("m", "month"),
        "cmd AS cmd_code, hs AS hs_version, par AS partner_code",
        "name AS source_name, map3 AS map_iso3",
        money("v", "import_value"),
        nano("share", "market_share"),
        "status AS market_share_status",
        money("pmv", "previous_month_value"),
        money("pyv", "previous_year_value"),
        nano("mom", "mom"),
        nano("yoy", "yoy"),
        "rep AS reporter_code",
    ]
)


@query(
    "dashboard_partners",
    f"SELECT {PARTNER_SQL} FROM t_share WHERE kind = 'country' AND cstatus = 'verified'",
)
def dashboard_partners(t: Tables):
    return t.single.partners


MONTHLY_SQL = ", ".join(
    [
        iso("m", "month"),
        "cmd AS cmd_code, hs AS hs_version",
        money("world", "world_value"),
        money("pworld", "previous_year_world_value"),
        nano("yoy", "world_yoy"),
        money("cv", "country_value"),
        "n AS country_count",
        nano("cov", "country_coverage"),
        "CASE WHEN status = 'ok' THEN round(raw, 4) END AS hhi",
        "status AS hhi_status",
        "world IS NOT NULL AS has_world",
        "n > 0 AS has_countries",
        "rep AS reporter_code",
    ]
)


@query("multi_market_monthly", f"SELECT {MONTHLY_SQL} FROM t_monthly")
def multi_market_monthly(t: Tables):
    return _round_hhi(t.multi.monthly)


@query("multi_market_partners", f"SELECT {PARTNER_SQL} FROM t_partners")
def multi_market_partners(t: Tables):
    return t.multi.partners


@query(
    "availability",
    """SELECT rep AS reporter_code, cmd AS cmd_code,
  string_agg(strftime(m, '%Y-%m-%d'), ',' ORDER BY m) AS months,
  strftime(min(m), '%Y-%m-%d') AS start_month,
  strftime(max(m), '%Y-%m-%d') AS latest_data_month
FROM t_monthly WHERE world IS NOT NULL OR n > 0 GROUP BY rep, cmd""",
)
def availability(t: Tables):
    listed = aggregate.availability(t.multi.monthly)
    text = F.array_join(F.transform("months", lambda m: m.cast("string")), ",")
    return listed.withColumn("months", text)


@query(
    "snapshot_counters",
    """SELECT count(*) AS valid_detail_count, count(*) FILTER (v > 0) AS positive_amount_count,
  count(*) >= 100000 AS row_target_met FROM t_partners""",
)
def snapshot_counters(t: Tables):
    return aggregate.snapshot_counters(t.multi.partners)


@query(
    "status_counts",
    """SELECT status AS hhi_status, count(*) AS months FROM t_monthly GROUP BY status""",
)
def status_counts(t: Tables):
    return t.multi.monthly.groupBy("hhi_status").agg(F.count("*").alias("months"))


@query(
    "representatives",
    """SELECT par AS partner_code, min(name) AS source_name, min(map3) AS map_iso3
FROM t_fact GROUP BY par""",
)
def representatives(t: Tables):
    """Attributes that the partner code determines, taken from any of its rows."""
    return aggregate.representatives(t.multi.fact, ["partner_code"], ["source_name", "map_iso3"])
