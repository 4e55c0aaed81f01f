"""Checks: the violating rows of single rules, and the report over whole contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthloom.catalog.oracle import SPINE, money
from monthloom.catalog.marts import MONTHLY_SQL, PARTNER_SQL, RAW_SQL
from monthloom.catalog.registry import END, START, STAR, TYPES, Tables, query
from monthloom.operators import aggregate, revision, sets
from monthloom.params import HHI_STATUSES
from monthloom.plans import publish, quality
from monthloom.plans.load import cut_lineage
from monthloom.schemas import MONTHLY_SCHEMA


@query(
    "duplicate_grain",
    """SELECT rep AS reporter_code, cmd AS cmd_code, par AS partner_code,
  strftime(m, '%Y-%m-%d') AS period_start_date, count(*) AS row_count
FROM t_detail GROUP BY m, rep, cmd, par HAVING count(*) > 1""",
)
def duplicate_grain(t: Tables):
    """Raw rows that share a grain because several revisions are stored."""
    key = ["reporter_code", "cmd_code", "partner_code", "period_start_date"]
    return aggregate.duplicates(t.panel.detail, key)


@query(
    "grain_count",
    f"""SELECT {RAW_SQL}, count(*) OVER (PARTITION BY m, rep, cmd, par) AS grain_count
FROM t_detail""",
)
def grain_count(t: Tables):
    key = ["period_start_date", "reporter_code", "cmd_code", "partner_code"]
    return aggregate.grain_count(t.panel.detail, key)


@query(
    "mixed_versions",
    """SELECT strftime(m, '%Y-%m-%d') AS period_start_date, rep AS reporter_code,
  cmd AS cmd_code, max(rev) AS revision, max(chk) AS checksum, CAST(sum(n) AS BIGINT) AS row_count,
  count(DISTINCT rev) AS revisions, count(DISTINCT chk) AS checksums
FROM t_extracts GROUP BY m, rep, cmd
HAVING count(DISTINCT rev) <> 1 OR count(DISTINCT chk) <> 1""",
)
def mixed_versions(t: Tables):
    return revision.mixed_versions(revision.stored_versions(t.panel.detail))


@query(
    "layer_symmetric_difference",
    """SELECT side, count(*) AS rows FROM (
  SELECT 'left' AS side, * FROM (SELECT m, rep, cmd, par, v FROM t_accepted
    EXCEPT SELECT m, rep, cmd, par, v FROM t_fact)
  UNION ALL SELECT 'right' AS side, * FROM (SELECT m, rep, cmd, par, v FROM t_fact
    EXCEPT SELECT m, rep, cmd, par, v FROM t_accepted)) GROUP BY side""",
)
def layer_symmetric_difference(t: Tables):
    """What the dimension and validity filters of the fact took away."""
    accepted = revision.accept_latest_extract(t.panel.detail)
    columns = ["period_start_date", "reporter_code", "cmd_code", "partner_code", "primary_value"]
    difference = sets.symmetric_difference(accepted, t.multi.fact, columns)
    return difference.groupBy("side").agg(F.count("*").alias("rows"))


@query(
    "layer_totals",
    f"""SELECT a.n AS staging_count, {money("a.v", "staging_amount")}, b.n AS fact_count,
  {money("b.v", "fact_amount")}
FROM (SELECT count(*) AS n, CAST(sum(v) AS BIGINT) AS v FROM t_accepted) a,
  (SELECT count(*) AS n, CAST(sum(v) AS BIGINT) AS v FROM t_fact) b""",
)
def layer_totals(t: Tables):
    accepted = revision.accept_latest_extract(t.panel.detail)
    return aggregate.layer_totals({"staging": accepted, "fact": t.multi.fact})


@query(
    "orphans",
    """SELECT strftime(p.m, '%Y-%m-%d') AS month, p.rep AS reporter_code, p.cmd AS cmd_code,
  p.par AS partner_code FROM t_fact p
WHERE NOT EXISTS (SELECT 1 FROM t_aworld w WHERE w.m = p.m AND w.rep = p.rep AND w.cmd = p.cmd)""",
)
def orphans(t: Tables):
    """Partner rows of months for which no world total was accepted."""
    partners = t.multi.fact.withColumnRenamed("period_start_date", "month")
    world = t.multi.world.withColumnRenamed("period_start_date", "month")
    lost = quality.orphans(partners, world)
    return lost.select("month", "reporter_code", "cmd_code", "partner_code")


@query(
    "spine_gaps",
    f"""WITH s AS (SELECT CAST(u AS DATE) AS m, rep, cmd FROM
  (SELECT DISTINCT rep, cmd FROM t_aworld), (SELECT unnest({SPINE}) AS u))
SELECT rep AS reporter_code, cmd AS cmd_code, strftime(m, '%Y-%m-%d') AS month, 'left' AS side
FROM (SELECT rep, cmd, m FROM s EXCEPT SELECT rep, cmd, m FROM t_aworld)""",
)
def spine_gaps(t: Tables):
    """Months for which a market and product have no accepted world total."""
    world = t.multi.world.withColumnRenamed("period_start_date", "month")
    return quality.spine_gaps(world, STAR)


@query(
    "staging_contract",
    """SELECT source_type, count(*) AS violations FROM (
  SELECT 'partner_detail' AS source_type FROM t_detail WHERE par = '0' OR v < 0
  UNION ALL SELECT 'world_total' FROM t_world WHERE v <= 0) GROUP BY source_type""",
)
def staging_contract(t: Tables):
    bad = quality.staging_contract(t.panel.detail, t.panel.world)
    return bad.groupBy("source_type").agg(F.count("*").alias("violations"))


@query(
    "tagged_union",
    f"""SELECT kind, count(*) AS rows, {money("CAST(sum(v) AS BIGINT)", "amount")},
  strftime(min(m), '%Y-%m-%d') AS first_month FROM (
  SELECT 'partner_detail' AS kind, m, v FROM t_detail
  UNION ALL SELECT 'world_total', m, v FROM t_world) GROUP BY kind""",
)
def tagged_union(t: Tables):
    both = sets.union_tagged(
        {"partner_detail": t.panel.detail, "world_total": t.panel.world}, "kind"
    )
    return both.groupBy("kind").agg(
        F.count("*").alias("rows"),
        F.sum("primary_value").alias("amount"),
        F.min("period_start_date").alias("first_month"),
    )


@query(
    "tagged_union_export",
    f"""SELECT 'monthly' AS kind, {MONTHLY_SQL} FROM t_monthly
UNION ALL BY NAME SELECT 'partners' AS kind, {PARTNER_SQL} FROM t_partners""",
)
def tagged_union_export(t: Tables):
    """Both marts in one result, each as a struct that is NULL in the other's rows; all fields of both."""
    pair = publish.export_pair(t.multi.monthly, t.multi.partners, START, STAR_END_EXCLUSIVE)
    held = {"monthly": publish.MONTHLY_SCHEMA.fieldNames(), "partners": publish.PARTNER_SCHEMA.fieldNames()}
    names = dict.fromkeys(name for fields in held.values() for name in fields)
    return pair.select(
        "kind",
        *[F.coalesce(*[F.col(f"{kind}.{name}") for kind in held if name in held[kind]]).alias(name) for name in names],
    ).withColumn("hhi", F.round("hhi", 4))  # the SQL sums squares of doubles


STAR_END_EXCLUSIVE = END.replace(year=END.year + 1, month=1)


@query(
    "multi_market_detail",
    """SELECT count(*) AS violations, count(DISTINCT cmd) AS products FROM t_fact
WHERE v < 0 OR par IN ('0', '490') OR NOT hs_hit""",
)
def multi_market_detail(t: Tables):
    """Fact rows without a product mapping in their edition, or otherwise invalid."""
    bad = quality.multi_market_detail(t.multi.fact, TYPES)
    return bad.agg(
        F.count("*").alias("violations"), F.count_distinct("cmd_code").alias("products")
    )


@query(
    "contract_failures",
    """SELECT * FROM (VALUES ('fact_preserves_staging', CAST(0 AS BIGINT)),
  ('mart_preserves_fact', CAST(0 AS BIGINT)), ('metric_contract', CAST(0 AS BIGINT)),
  ('missing_country_audited', CAST(0 AS BIGINT)), ('month_spine_complete', CAST(0 AS BIGINT)),
  ('monthly_contract', CAST(0 AS BIGINT)), ('partner_contract', CAST(0 AS BIGINT)),
  ('monthly_contract_single', (SELECT count(*) FROM (SELECT m, rep, cmd, hs,
      count(*) AS a, count(*) FILTER (cstatus = 'verified') AS b FROM t_share
      WHERE kind = 'country' AND (cmd, hs) IN (SELECT (cmd, hs) FROM t_hs) GROUP BY ALL)
    WHERE a <> b)),
  ('partner_contract_single', CAST(0 AS BIGINT)),
  ('hhi_status_accepted', CAST(0 AS BIGINT)), ('unique_partner_grain', CAST(0 AS BIGINT)),
  ('month_relationship', CAST(0 AS BIGINT)), ('not_null_keys', CAST(0 AS BIGINT)),
  ('spine_per_scope', CAST(0 AS BIGINT)), ('orphans', CAST(0 AS BIGINT))
) x(failed_check, violations)""",
)
def contract_failures(t: Tables):
    """Violations per check over the marts of both generations.

    The single-market month contract counts verified countries only, so each month
    with an unreviewed country is reported.
    """
    return quality.check_report(all_checks(t))


def all_checks(t: Tables):
    """Marts are stored first: each of many checks then plans over a stored table."""
    t.scratch()
    single, multi = t.single, t.multi
    monthly, partners = cut_lineage(multi.monthly), cut_lineage(multi.partners)
    fact, mart, issues = cut_lineage(single.fact), cut_lineage(single.mart), cut_lineage(single.issues)
    single_monthly, single_partners = cut_lineage(single.monthly), cut_lineage(single.partners)
    key = ["month", "reporter_code", "cmd_code", "partner_code"]
    month_key = {"month": "month_start_date"}
    return {
        "fact_preserves_staging": quality.preserves(t.panel.detail, fact),
        "mart_preserves_fact": quality.preserves(fact, mart),
        "metric_contract": quality.metric_contract(mart),
        "missing_country_audited": quality.unaudited_partners(
            t.panel.detail, t.countries, issues
        ),
        "month_spine_complete": quality.month_dimension_contract(single.months, START, END),
        "monthly_contract": quality.monthly_contract_multi(monthly, partners),
        "partner_contract": quality.partner_contract_multi(partners, monthly),
        "monthly_contract_single": quality.monthly_contract_single(
            single_monthly, single_partners
        ),
        "partner_contract_single": quality.partner_contract_single(
            single_partners, single_monthly
        ),
        "hhi_status_accepted": quality.accepted_values(
            monthly, "hhi_status", HHI_STATUSES
        ),
        "unique_partner_grain": quality.compound_unique(partners, key),
        "month_relationship": quality.relationships(partners, single.months, month_key),
        "not_null_keys": quality.not_null(partners, key),
        "spine_per_scope": quality.spine_gaps(monthly, STAR),
        "orphans": quality.orphans(partners, monthly),
    }


def count_sql(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS failed_check, CAST(({sql}) AS BIGINT) AS violations"


SPOILED_SQL = {
    "fact_preserves_staging": "SELECT 2 * count(*) + 1 FROM t_detail WHERE rep = 'ASIA'",
    "mart_preserves_fact": "SELECT count(*) + 1 FROM t_detail WHERE rep = 'EUROPE'",
    "metric_contract": "SELECT count(*) FROM t_share WHERE world IS NULL OR world <= 0",
    "missing_country_audited": "SELECT count(*) FROM t_detail WHERE CAST(par AS INTEGER) % 5 = 2",
    "month_spine_complete": f"SELECT count(*) FROM (SELECT unnest({SPINE}) AS u) WHERE month(u) IN (3, 6)",
    "monthly_contract": "SELECT count(*) FROM t_monthly WHERE rep = 'ASIA'",
    "partner_contract": "SELECT count(*) FROM t_partners WHERE rep = 'EUROPE'",
    "monthly_contract_single": f"""SELECT count(*) FROM (SELECT unnest({SPINE})), (SELECT DISTINCT cmd, hs FROM
      (SELECT rep, cmd, hs FROM t_detail UNION ALL SELECT rep, cmd, hs FROM t_world) JOIN t_hs USING (cmd, hs) WHERE rep = 'ASIA')""",
    "partner_contract_single": """SELECT count(*) FROM t_share WHERE kind = 'country' AND cstatus = 'verified'
      AND rep = 'AMERICA' AND coalesce(pyv, 0) <= 0 AND (cmd, hs) IN (SELECT (cmd, hs) FROM t_hs)""",
    "hhi_status_accepted": "SELECT count(*) FROM t_monthly WHERE rep = 'AFRICA'",
    "unique_partner_grain": "SELECT count(*) FROM t_partners WHERE rep = 'ASIA'",
    "month_relationship": "SELECT count(*) FROM t_partners WHERE month(m) = 6",
    "not_null_keys": "SELECT count(*) FROM t_partners WHERE rep = 'AMERICA'",
    "spine_per_scope": "SELECT count(*) FROM t_monthly WHERE month(m) = 2",
    "orphans": "SELECT count(*) FROM t_partners WHERE rep = 'AFRICA'",
}


@query("contract_violations", " UNION ALL ".join(count_sql(n, s) for n, s in SPOILED_SQL.items()))
def contract_violations(t: Tables):
    """Violations per check over marts that are spoiled by rule, one rule a check."""
    t.scratch()
    single, multi = t.single, t.multi
    monthly, partners = cut_lineage(multi.monthly), cut_lineage(multi.partners)
    fact, mart, issues = cut_lineage(single.fact), cut_lineage(single.mart), cut_lineage(single.issues)
    single_monthly, single_partners = cut_lineage(single.monthly), cut_lineage(single.partners)
    key = ["month", "reporter_code", "cmd_code", "partner_code"]

    def where(frame, name, column, value):
        """``frame`` with another value of a column in the rows of one market."""
        kind = frame.schema[column].dataType
        return frame.withColumn(column, F.when(F.col("reporter_code") == name, value.cast(kind)).otherwise(F.col(column)))

    dearer = where(fact, "ASIA", "primary_value", F.col("primary_value") + 1)
    shares = F.when(quality.not_positive(F.col("world_value")), F.lit(1)).otherwise(F.col("market_share"))
    number = F.col("partner_code").cast("int")
    month = F.month("month_start_date")
    months = single.months.where(month != 6)
    no_growth = quality.not_positive(F.col("previous_year_value"))
    grown = single_partners.withColumn(
        "yoy", F.when(no_growth & (F.col("reporter_code") == "AMERICA"), F.lit(1).cast("decimal(38,9)")).otherwise(F.col("yoy"))
    )
    checks = {
        "fact_preserves_staging": quality.preserves(t.panel.detail, dearer),
        "mart_preserves_fact": quality.preserves(fact, mart.where("reporter_code <> 'EUROPE'")),
        "metric_contract": quality.metric_contract(mart.withColumn("market_share", shares.cast("decimal(38,9)"))),
        "missing_country_audited": quality.unaudited_partners(t.panel.detail, t.countries.where(number % 5 != 2), issues),
        "month_spine_complete": quality.month_dimension_contract(months.unionByName(months.where(month == 3)), START, END),
        "monthly_contract": quality.monthly_contract_multi(where(monthly, "ASIA", "country_count", F.col("country_count") + 1), partners),
        "partner_contract": quality.partner_contract_multi(where(partners, "EUROPE", "market_share_status", F.lit("odd")), monthly),
        "monthly_contract_single": quality.monthly_contract_single(
            where(single_monthly, "ASIA", "has_countries", ~F.col("has_countries")).where("reporter_code = 'ASIA'"), single_partners
        ),
        "partner_contract_single": quality.partner_contract_single(grown, single_monthly),
        "hhi_status_accepted": quality.accepted_values(where(monthly, "AFRICA", "hhi_status", F.lit("odd")), "hhi_status", HHI_STATUSES),
        "unique_partner_grain": quality.compound_unique(partners.unionByName(partners.where("reporter_code = 'ASIA'")), key),
        "month_relationship": quality.relationships(partners, months, {"month": "month_start_date"}),
        "not_null_keys": quality.not_null(where(partners, "AMERICA", "partner_code", F.lit(None)), key),
        "spine_per_scope": quality.spine_gaps(monthly.where(F.month("month") != 2), STAR),
        "orphans": quality.orphans(partners, monthly.where("reporter_code <> 'AFRICA'")),
    }
    return quality.check_report(checks)


@query(
    "quality_gate",
    """SELECT count(*) FILTER (v > 0) AS failed_nodes, CAST(1 AS BIGINT) AS required_passed,
  CAST(1 AS BIGINT) AS builds, count(*) FILTER (v > 0) = 0 AS publishable
FROM (SELECT (SELECT count(*) FROM t_world WHERE v <= 0) AS v
  UNION ALL SELECT (SELECT count(*) FROM t_monthly WHERE status NOT IN ('ok', 'missing_world',
    'invalid_world', 'no_countries', 'insufficient_coverage')))""",
)
def quality_gate(t: Tables):
    """A build with one failing check must not be published."""
    checks = {
        "world_positive": t.panel.world.where(F.col("primary_value") <= 0),
        "hhi_status_accepted": quality.accepted_values(t.multi.monthly, "hhi_status", HHI_STATUSES),
    }
    passed = F.when(F.col("violations") == 0, "pass").otherwise("fail")
    results = quality.check_report(checks).select(
        F.col("failed_check").alias("name"),
        F.lit("check").alias("kind"),
        passed.alias("status"),
        F.lit("build-1").alias("build_id"),
    )
    return quality.quality_gate(results, ["hhi_status_accepted"])


@query(
    "snapshot_row_rules",
    """SELECT reason, count(*) AS rows FROM (SELECT 'cmd_code' AS reason FROM t_partners
  UNION ALL SELECT 'reporter_code' FROM t_partners) GROUP BY reason""",
)
def snapshot_row_rules(t: Tables):
    """Export rules on the star's rows: its codes are words, so both code rules fail."""
    wire = publish.to_wire(t.multi.partners, publish.PARTNER_SCHEMA)
    validated = publish.validate_partners(wire, ["854231"])
    return validated.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("rows")
    )


@query(
    "snapshot_metadata",
    """SELECT count(*) AS valid_detail_count, count(*) FILTER (v > 0) AS positive_amount_count,
  count(*) >= 100000 AS row_target_met, (SELECT count(*) FROM t_monthly) AS monthly_rows,
  count(*) AS partners_rows,
  (SELECT count(*) FROM (SELECT DISTINCT rep, cmd FROM t_monthly WHERE world IS NOT NULL OR n > 0))
    AS scopes,
  (SELECT string_agg(rep || '/' || cmd || ' ' || n || ' ' || lo || ' ' || hi, ', ' ORDER BY rep, cmd) FROM
    (SELECT rep, cmd, count(DISTINCT m) AS n, strftime(min(m), '%Y-%m-%d') AS lo, strftime(max(m), '%Y-%m-%d') AS hi
     FROM t_monthly WHERE world IS NOT NULL OR n > 0 GROUP BY rep, cmd)) AS availability,
  true AS monthly_digest_repeats, true AS partners_digest_repeats,
  (SELECT strftime(max(m), '%Y-%m-%d') FROM t_monthly WHERE world IS NOT NULL OR n > 0)
    AS latest_data_month, '1995-01-01' AS start_month, '2002-01-01' AS end_exclusive
FROM t_partners""",
)
def snapshot_metadata(t: Tables):
    """Metadata of both marts, the scopes as text; digests are those of the same rows dealt anew."""
    found = publish.scope_metadata(t.multi.monthly, t.multi.partners, START, STAR_END_EXCLUSIVE)
    scope = "concat(s.reporter_code, '/', s.cmd_code, ' ', size(s.months), ' ', s.start_month, ' ', s.latest_data_month)"
    repeated = [
        (
            publish.document_summary(frame.repartition("partner_code" if name == "partners" else "month"), schema, name)
            .select(f"{name}_digest").scalar().eqNullSafe(F.col(f"{name}_digest")).alias(f"{name}_digest_repeats")
        )
        for name, frame, schema in (("monthly", t.multi.monthly, MONTHLY_SCHEMA), ("partners", t.multi.partners, publish.PARTNER_SCHEMA))
    ]
    return found.select(
        *[c for c in found.columns if c not in ("availability", "monthly_digest", "partners_digest")],
        F.size("availability").cast("bigint").alias("scopes"),
        F.array_join(F.expr(f"transform(availability, s -> {scope})"), ", ").alias("availability"),
        *repeated,
    )
