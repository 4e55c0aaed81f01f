"""Single operators inside the marts, registered on their own."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from monthloom.catalog.explore import plain_cents_sql, plain_nano_sql
from monthloom.catalog.oracle import iso, money
from monthloom.catalog.registry import END, START, Tables, query
from monthloom.functions.calendar import with_calendar_lookups
from monthloom.operators import aggregate, select
from monthloom.plans import quality
from monthloom.schemas import MONTHLY_SCHEMA
from monthloom.sources.snapshot import to_wire

GRAIN = ("period_start_date", "reporter_code", "cmd_code", "partner_code")
GRAIN_SQL = (
    f"{iso('m', 'period_start_date')}, rep AS reporter_code, cmd AS cmd_code, par AS partner_code"
)


@query(
    "scope_spine",
    f"SELECT {iso('m', 'month')}, rep AS reporter_code, cmd AS cmd_code FROM t_spine",
)
def scope_spine(t: Tables):
    """Scopes seen in either input, each with every month of the range."""
    keys = ["reporter_code", "cmd_code"]
    scopes = t.multi.fact.select(*keys).unionByName(t.multi.world.select(*keys))
    return aggregate.scope_months(scopes, START, END)


@query(
    "calendar_lookups",
    f"""SELECT {GRAIN_SQL}, {money("v", "primary_value")}, {money("pmv", "month_before")},
  {money("pyv", "year_before")} FROM t_partners""",
)
def calendar_lookups(t: Tables):
    """Value of the calendar month and year before, not of the row before."""
    fact = t.multi.fact.select(*GRAIN, "primary_value")
    lookups = {"month_before": ("primary_value", -1), "year_before": ("primary_value", -12)}
    return with_calendar_lookups(fact, GRAIN[1:], GRAIN[0], lookups)


@query(
    "exact_sums",
    f"""SELECT rep AS reporter_code, {money("CAST(sum(v) AS BIGINT)", "amount")},
  CAST(sum(w) AS DOUBLE) AS weight, CAST(sum(q) AS DOUBLE) AS quantity,
  CAST(sum(CASE WHEN par = '3' THEN w END) FILTER (m < DATE '1995-02-01') AS DOUBLE) AS rare
FROM t_detail GROUP BY rep""",
)
def exact_sums(t: Tables):
    """Decimal sums; a sum without any known value is NULL."""
    rare = (F.col("partner_code") == "3") & (F.col("period_start_date") < F.lit(date(1995, 2, 1)))
    return t.panel.detail.groupBy("reporter_code").agg(
        aggregate.exact_sum(F.col("primary_value")).alias("amount"),
        aggregate.exact_sum(F.col("net_weight")).alias("weight"),
        aggregate.exact_sum(F.col("quantity")).alias("quantity"),
        aggregate.exact_sum(F.when(rare, F.col("net_weight"))).alias("rare"),
    )


@query(
    "complete_sums",
    """SELECT strftime(m, '%Y-%m-%d') AS month, cmd AS cmd_code, count(*) AS markets,
  CASE WHEN count(*) = 5 AND count(world) = 5 THEN CAST(sum(world) AS DOUBLE) / 100 END AS world
FROM t_monthly GROUP BY m, cmd""",
)
def complete_sums(t: Tables):
    """World value over all markets, only for months in which every market has one."""
    return t.multi.monthly.groupBy("month", "cmd_code").agg(
        F.count("*").alias("markets"),
        aggregate.complete_sum(F.col("world_value"), 5).alias("world"),
    )


@query(
    "joined_editions",
    """SELECT rep AS reporter_code, cmd AS cmd_code,
  string_agg(DISTINCT hs, '+' ORDER BY hs) AS editions FROM t_fact GROUP BY rep, cmd""",
)
def joined_editions(t: Tables):
    editions = aggregate.joined_editions(F.col("hs_version")).alias("editions")
    return t.multi.fact.groupBy("reporter_code", "cmd_code").agg(editions)


@query(
    "months_listed",
    f"""SELECT {GRAIN_SQL}, {money("v", "primary_value")} FROM t_fact
WHERE m IN (SELECT m FROM t_aworld WHERE v = 0)""",
)
def months_listed(t: Tables):
    """Fact rows of the months in which some accepted world total is zero."""
    zero = t.multi.world.where(F.col("primary_value") == 0).select("period_start_date")
    months = [row[0] for row in zero.distinct().collect()]  # calendar months
    fact = t.multi.fact.select(*GRAIN, "primary_value")
    return select.months_listed(fact, months, "period_start_date")


@query(
    "distinct_from",
    """SELECT rep AS reporter_code, count(*) FILTER (pmv IS DISTINCT FROM pyv) AS different,
  count(*) FILTER (pmv IS NOT DISTINCT FROM pyv) AS same FROM t_partners GROUP BY rep""",
)
def distinct_from(t: Tables):
    """NULL-safe comparison of the two growth bases."""
    unlike = select.differs(F.col("previous_month_value"), F.col("previous_year_value"))
    return t.multi.partners.groupBy("reporter_code").agg(
        F.count_if(unlike).alias("different"), F.count_if(~unlike).alias("same")
    )


@query(
    "generic_checks",
    """SELECT 'not_null' AS failed_check, count(*) FILTER (w IS NULL) AS violations FROM t_detail
UNION ALL SELECT 'accepted_values', count(*) FILTER (hs NOT IN ('H4', 'H5')) FROM t_detail
UNION ALL SELECT 'relationships', count(*) FILTER (NOT EXISTS (SELECT 1 FROM t_verified c
  WHERE c.par = d.par)) FROM t_detail d
UNION ALL SELECT 'compound_unique', count(*) FROM (SELECT 1 FROM t_detail GROUP BY m, rep, cmd, par
  HAVING count(*) > 1)""",
)
def generic_checks(t: Tables):
    """The reusable column checks over all stored versions."""
    detail = t.panel.detail
    verified = t.countries.where(select.verified_country())
    return quality.check_report(
        {
            "not_null": quality.not_null(detail, ["net_weight"]),
            "accepted_values": quality.accepted_values(detail, "hs_version", ["H4", "H5"]),
            "relationships": quality.relationships(
                detail, verified, {"partner_code": "partner_code"}
            ),
            "compound_unique": quality.compound_unique(detail, GRAIN),
        }
    )


@query(
    "snapshot_wire_rows",
    f"""SELECT {iso("m", "month")}, cmd AS cmd_code, hs AS hs_version, rep AS reporter_code,
  nullif({plain_cents_sql("world")}, '') AS world_value,
  nullif({plain_cents_sql("pworld")}, '') AS previous_year_world_value,
  nullif({plain_nano_sql("yoy")}, '') AS world_yoy, nullif({plain_cents_sql("cv")}, '') AS country_value,
  n AS country_count, nullif({plain_nano_sql("cov")}, '') AS country_coverage,
  CASE WHEN status = 'ok' THEN round(raw, 4) END AS hhi,
  status AS hhi_status, world IS NOT NULL AS has_world, n > 0 AS has_countries
FROM t_monthly""",
)
def snapshot_wire_rows(t: Tables):
    """Month rows as published: exact decimals as text, NULL where unknown; the index at four digits."""
    wire = to_wire(t.multi.monthly, MONTHLY_SCHEMA)
    return wire.withColumn("hhi", F.round(F.col("hhi").cast("double"), 4))
