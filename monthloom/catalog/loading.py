"""Worklists, load decisions, unit replacement, fact refresh and delivery."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.catalog.marts import PARTNER_SQL, RAW_SQL
from monthloom.catalog.oracle import SPINE, iso, money, stamp
from monthloom.catalog.registry import END, REGIONS, START, STAR, TYPES, Tables, query
from monthloom.operators import aggregate, revision
from monthloom.operators.dimensions import reference_refresh as refreshed_reference
from monthloom.params import KINDS
from monthloom.plans import landing, load, publish
from monthloom.plans.multi_market import multi_market_fact
from monthloom.schemas import PARTNER_COLUMNS, PARTNER_SCHEMA
from monthloom.sources.raw import FACT_CLUSTER, scan_raw, write_table
from monthloom.sources.snapshot import scan_documents, to_wire, write_documents

UNIT_SQL = "m, rep, cmd"
UNIT_OUT = f"{iso('m', 'period_start_date')}, rep AS reporter_code, cmd AS cmd_code"


def extracts(detail: DataFrame) -> DataFrame:
    """One row per stored extract with the columns a load needs."""
    return detail.groupBy(
        *load.UNIT, "revision", "checksum", "hs_version", "period", "source_file", "ingested_at"
    ).agg(
        F.count("*").alias("row_count"),
        F.sum("primary_value").cast("decimal(38,9)").alias("primary_value_sum"),
    )


def stored_before(t: Tables) -> DataFrame:
    """The raw table before the newest revisions arrive: accepted among the first two."""
    older = t.panel.detail.where(F.col("revision") < 3)
    return revision.accept_latest_extract(older, clustered=t.by_line)


BEFORE_SQL = """before AS (SELECT * FROM t_detail WHERE rev < 3 QUALIFY dense_rank() OVER
  (PARTITION BY m, rep, cmd ORDER BY rev DESC) = 1),
stored AS (SELECT m, rep, cmd, max(rev) AS rev, max(chk) AS chk, count(*) AS n FROM before
  GROUP BY m, rep, cmd)"""
CHANGED = "CASE WHEN i.rep = 'ASIA' THEN i.chk || 'x' ELSE i.chk END"


@query(
    "load_decision",
    f"""WITH {BEFORE_SQL} SELECT strftime(i.m, '%Y-%m-%d') AS period_start_date,
  i.rep AS reporter_code, i.cmd AS cmd_code, i.rev AS revision,
  CASE WHEN s.rev IS NULL OR i.rev > s.rev THEN 'load' WHEN i.rev < s.rev THEN 'stale_revision'
    WHEN {CHANGED} = s.chk THEN 'already_loaded' ELSE 'conflict' END AS decision
FROM t_extracts i LEFT JOIN stored s ON i.m = s.m AND i.rep = s.rep AND i.cmd = s.cmd""",
)
def load_decision(t: Tables):
    """Every extract against the stored table; one market sends changed content."""
    changed = F.concat("checksum", F.lit("x"))
    incoming = extracts(t.panel.detail).withColumn(
        "checksum",
        F.when(F.col("reporter_code") == "ASIA", changed).otherwise(F.col("checksum")),
    )
    stored = revision.stored_versions(stored_before(t))
    decided = revision.load_decision(incoming, stored, load.UNIT)
    return decided.select(*load.UNIT, "revision", "decision")


@query(
    "replay_mismatch",
    f"""WITH {BEFORE_SQL} SELECT strftime(m, '%Y-%m-%d') AS period_start_date,
  rep AS reporter_code, cmd AS cmd_code, rev AS revision FROM stored WHERE rep = 'EUROPE'""",
)
def replay_mismatch(t: Tables):
    """Same revision and checksum, but one market's manifests count another row."""
    before = stored_before(t)
    one_more = F.when(F.col("reporter_code") == "EUROPE", 1).otherwise(0)
    incoming = extracts(before).withColumn("row_count", F.col("row_count") + one_more)
    decided = revision.load_decision(incoming, revision.stored_versions(before), load.UNIT)
    return revision.replay_count_mismatch(decided).select(*load.UNIT, "revision")


@query(
    "changed_during_load",
    f"""WITH {BEFORE_SQL} SELECT strftime(m, '%Y-%m-%d') AS period_start_date,
  rep AS reporter_code, cmd AS cmd_code FROM stored s WHERE rep = 'ASIA' AND EXISTS
  (SELECT 1 FROM before b WHERE b.m = s.m AND b.rep = s.rep AND b.cmd = s.cmd AND b.par = '3')""",
)
def changed_during_load(t: Tables):
    """Units whose stored rows moved between the decision and the write."""
    before = stored_before(t)
    stored = revision.stored_versions(before)
    decided = revision.load_decision(extracts(before), stored, load.UNIT)
    lost = (F.col("reporter_code") == "ASIA") & (F.col("partner_code") == "3")
    return load.unchanged_since(before.where(~lost), decided).select(*load.UNIT)


@query(
    "stored_versions",
    f"""WITH {BEFORE_SQL} SELECT strftime(m, '%Y-%m-%d') AS period_start_date,
  rep AS reporter_code, cmd AS cmd_code, rev AS revision, chk AS checksum, n AS row_count,
  CAST(1 AS BIGINT) AS revisions, CAST(1 AS BIGINT) AS checksums FROM stored""",
)
def stored_versions(t: Tables):
    return revision.stored_versions(stored_before(t))


@query(
    "assign_revision",
    """WITH asked AS (SELECT CAST(u AS DATE) AS m, r_name AS rep, p.cmd FROM
    (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01',
      INTERVAL 1 MONTH)) AS u), region, (SELECT DISTINCT p_type AS cmd FROM part) p),
got AS (SELECT m, rep, cmd, chk FROM t_extracts WHERE rev = 3 AND rep <> 'AFRICA'),
had AS (SELECT m, rep, cmd, rev, CASE WHEN rep = 'ASIA' THEN c3 ELSE chk END AS chk FROM (
  SELECT m, rep, cmd, max(rev) FILTER (rev < 3) AS rev, arg_max(chk, rev) FILTER (rev < 3) AS chk,
    max(chk) FILTER (rev = 3) AS c3 FROM t_extracts GROUP BY m, rep, cmd) WHERE rev IS NOT NULL)
SELECT strftime(a.m, '%Y%m') AS period, a.rep AS reporter_code, a.cmd AS cmd_code,
  CASE WHEN g.chk IS NULL AND h.rev IS NOT NULL THEN 'missing_refresh'
    WHEN g.chk IS NULL THEN 'unavailable' WHEN g.chk = h.chk THEN 'unchanged' ELSE 'save' END
    AS action,
  CASE WHEN g.chk IS NULL THEN NULL WHEN g.chk = h.chk THEN h.rev
    ELSE coalesce(h.rev, 0) + 1 END AS revision
FROM asked a LEFT JOIN got g USING (m, rep, cmd) LEFT JOIN had h USING (m, rep, cmd)""",
)
def assign_revision(t: Tables):
    """What a refresh of every identity does: one market returns nothing, one the same."""
    key = ("period", "reporter_code", "cmd_code")
    planned = landing.worklist(t.spark, START, END, TYPES, REGIONS, KINDS[:1])
    requested = planned.withColumn("period", F.date_format("period_start_date", "yyyyMM"))
    newest = t.panel.detail.where(F.col("revision") == 3).select(*key, "checksum").distinct()
    fetched = newest.where(F.col("reporter_code") != "AFRICA")
    before = stored_before(t).select(*key, "revision", "checksum").distinct()
    same = newest.withColumnRenamed("checksum", "same")
    accepted = before.join(same, list(key), "left").withColumn(
        "checksum",
        F.when(F.col("reporter_code") == "ASIA", F.col("same")).otherwise(F.col("checksum")),
    )
    decided = revision.assign_revision(requested, fetched, accepted, True, key)
    return decided.select(*key, "action", "revision")


WORKLIST_SQL = f"""SELECT CAST(u AS DATE) AS m, r_name AS rep, p.cmd, k.kind FROM
  (SELECT unnest({SPINE}) AS u), region, (SELECT DISTINCT p_type AS cmd FROM part) p,
  (VALUES ('partner_detail'), ('world_total')) k(kind)"""


def present(t: Tables) -> DataFrame:
    key = ["period_start_date", "cmd_code", "reporter_code"]
    detail = t.panel.detail.select(*key).withColumn("query_type", F.lit("partner_detail"))
    world = t.panel.world.select(*key).withColumn("query_type", F.lit("world_total"))
    return detail.unionByName(world).distinct()


@query(
    "extract_worklist_missing",
    f"""SELECT {UNIT_OUT}, kind AS query_type FROM ({WORKLIST_SQL}) w WHERE NOT EXISTS (
  SELECT 1 FROM t_detail d WHERE w.kind = 'partner_detail' AND d.m = w.m AND d.rep = w.rep
    AND d.cmd = w.cmd) AND NOT EXISTS (
  SELECT 1 FROM t_world d WHERE w.kind = 'world_total' AND d.m = w.m AND d.rep = w.rep
    AND d.cmd = w.cmd)""",
)
def extract_worklist_missing(t: Tables):
    """Identities of the whole range that have not been accepted yet."""
    planned = landing.worklist(t.spark, START, END, TYPES, REGIONS)
    return landing.missing_extracts(planned, present(t))


@query(
    "recent_window",
    f"""WITH a AS (SELECT max(l_shipdate) AS hi FROM lineitem)
SELECT {UNIT_OUT}, kind AS query_type FROM ({WORKLIST_SQL}) w, a
WHERE m >= date_trunc('month', hi) - INTERVAL 3 MONTH AND m < date_trunc('month', hi)""",
)
def recent_window(t: Tables):
    """The three complete months before the newest shipping month."""
    planned = landing.worklist(t.spark, START, END, TYPES, REGIONS)
    newest = t.panel.detail.agg(F.max("period_start_date").alias("newest")).scalar()
    return landing.recent_window(planned, newest)


@query(
    "reconcile_load",
    f"""SELECT {UNIT_OUT}, rev AS revision FROM t_extracts
WHERE (cmd = 'LARGE' AND rev = 1) OR (cmd = 'SMALL' AND rev = 2)""",
)
def reconcile_load(t: Tables):
    """Incoming rows against manifests that overstate a count or a sum."""
    large = (F.col("cmd_code") == "LARGE") & (F.col("revision") == 1)
    small = (F.col("cmd_code") == "SMALL") & (F.col("revision") == 2)
    stated = extracts(t.panel.detail).withColumns(
        {
            "kind": F.lit("partner_detail"),
            "row_count": F.col("row_count") + F.when(large, 1).otherwise(0),
            "primary_value_sum": F.col("primary_value_sum") + F.when(small, 1).otherwise(0),
        }
    )
    rows = t.panel.detail.withColumn("kind", F.lit("partner_detail"))
    return load.reconcile_load(stated, rows).select(*load.UNIT, "revision")


@query(
    "full_source_replace",
    f"""WITH {BEFORE_SQL}, units AS (SELECT DISTINCT m, rep, cmd FROM t_detail
  WHERE rev = 3 AND rep IN ('ASIA', 'EUROPE'))
SELECT {RAW_SQL} FROM before b WHERE NOT EXISTS (SELECT 1 FROM units u
  WHERE u.m = b.m AND u.rep = b.rep AND u.cmd = b.cmd)
UNION ALL SELECT {RAW_SQL} FROM t_detail WHERE rev = 3 AND rep IN ('ASIA', 'EUROPE')""",
)
def full_source_replace(t: Tables):
    """New revisions of two markets replace their whole units; the rest stays."""
    newer = F.col("reporter_code").isin("ASIA", "EUROPE") & (F.col("revision") == 3)
    incoming = t.panel.detail.where(newer)
    return load.replace_units(stored_before(t), incoming, incoming)


@query(
    "affected_months",
    """WITH old AS (SELECT max(ing) AS hi FROM t_fact WHERE m < DATE '2000-06-01')
SELECT DISTINCT strftime(m, '%Y-%m-%d') AS period_start_date FROM t_detail, old WHERE ing >= hi""",
)
def affected_months(t: Tables):
    """Months with rows ingested since the fact was last built."""
    old = t.multi.fact.where(F.col("period_start_date") < F.lit(date(2000, 6, 1)))
    return load.affected_months(t.panel.detail, old, STAR)


@query(
    "watermark",
    f"""SELECT count(*) AS events, {stamp("max(ing)", "last_event_at")} FROM t_extracts""",
)
def watermark(t: Tables):
    """Change token over the success events of all stored extracts."""
    events = extracts(t.panel.detail).select(
        F.lit("success").alias("status"), F.col("ingested_at").alias("event_at")
    )
    return aggregate.watermark(events)


@query(
    "audit_events",
    f"""SELECT 'multi-' || period || '-' || rep || '-' || cmd || '-r' || rev AS run_id, period,
  'partner_detail' AS query_type, cmd AS cmd_code, rev AS revision, src AS source_file,
  chk AS checksum, n AS expected_row_count, n AS actual_row_count,
  {money("total", "actual_primary_value_sum")}, 'success' AS status FROM t_extracts""",
)
def audit_events(t: Tables):
    """The success events of loading every extract, without their random ids."""
    loaded = extracts(t.panel.detail).withColumn("kind", F.lit("partner_detail"))
    return load.audit_events(loaded).select(
        "run_id",
        "period",
        "query_type",
        "cmd_code",
        "revision",
        "source_file",
        "checksum",
        "expected_row_count",
        "actual_row_count",
        "actual_primary_value_sum",
        "status",
    )


@query("partition_scan", f"SELECT {RAW_SQL} FROM t_detail WHERE m >= DATE '1997-01-01'")
def partition_scan(t: Tables):
    """The raw table written by month and read back with pruned partitions."""
    path = f"{t.scratch()}/raw"
    write_table(t.panel.detail_by_month, path, dealt=t.by_line)
    return scan_raw(t.spark, path, date(1997, 1, 1), date(2002, 1, 1))


FACT_OUT = (
    "period_start_date",
    "reporter_code",
    "cmd_code",
    "partner_code",
    "hs_version",
    "revision",
    "primary_value",
)


@query(
    "overwrite_result",
    f"""WITH a AS (SELECT * FROM t_detail WHERE rev < 3 QUALIFY dense_rank() OVER
  (PARTITION BY m, rep, cmd ORDER BY rev DESC) = 1),
old AS (SELECT a.* FROM a JOIN t_verified USING (par)),
r AS (SELECT * FROM old WHERE m NOT IN (SELECT m FROM t_detail WHERE month(m) IN (3, 9))
  UNION ALL SELECT {{cols}} FROM t_fact WHERE month(m) = 3)
SELECT {UNIT_OUT}, par AS partner_code, hs AS hs_version, rev AS revision,
  {money("v", "primary_value")} FROM r""".replace(
        "{cols}", "* EXCLUDE (name, map3, descr, hs_hit)"
    ),
)
def overwrite_result(t: Tables):
    """A stored fact after March and September were recomputed, September being empty.

    Only those months are written; the months that lost all rows are removed.
    """
    path = f"{t.scratch()}/fact"
    p = t.panel
    old = multi_market_fact(
        p.detail.where(F.col("revision") < 3), p.countries, p.hs_codes, STAR
    )
    write_table(old, path, cluster_by=FACT_CLUSTER)
    month = F.month("period_start_date")
    refreshed = p.detail.where(month != 9)
    months = load.months_of(p.detail.where(month.isin(3, 9)))
    load.refresh_fact(t.spark, path, refreshed, p.countries, p.hs_codes, STAR, months)
    return load.scan_fact(t.spark, path).select(*FACT_OUT)


@query(
    "append_new_columns",
    f"""SELECT {UNIT_OUT}, par AS partner_code, {money("v", "primary_value")},
  CASE WHEN m >= DATE '2000-01-01' THEN 'new' END AS note FROM t_fact""",
)
def append_new_columns(t: Tables):
    """Months written with an extra column beside months written without it."""
    path = f"{t.scratch()}/fact"
    late = F.col("period_start_date") >= F.lit(date(2000, 1, 1))
    fact = t.multi.fact
    write_table(fact.where(~late), path, cluster_by=FACT_CLUSTER)
    wider = fact.where(late).withColumn("note", F.lit("new"))
    write_table(wider, path, mode="append", cluster_by=FACT_CLUSTER)
    columns = ("period_start_date", "reporter_code", "cmd_code", "partner_code")
    return load.scan_fact(t.spark, path).select(*columns, "primary_value", "note")


@query("delivery_partition", f"SELECT {PARTNER_SQL} FROM t_partners")
def delivery_partition(t: Tables):
    """Partner rows delivered as one file set per market and read back."""
    path = f"{t.scratch()}/partners"
    write_documents(to_wire(t.multi.partners, PARTNER_SCHEMA), path, "reporter_code")
    read = scan_documents(t.spark, path, PARTNER_SCHEMA)
    return publish.typed_rows(read, PARTNER_SCHEMA).select(*PARTNER_COLUMNS)


@query(
    "reference_refresh",
    """SELECT par AS partner_code, name AS source_name, iso3 AS source_iso_alpha3,
  is_group AS source_is_group, kind AS partner_type, status AS classification_status, map3 AS map_iso3,
  note AS classification_note, '' AS source_note, role AS reconciliation_role, 'star' AS source_url,
  '1998-08-02' AS retrieved_at, 'star' AS classification_source_url, 'star' AS mapping_source_url,
  CAST(NULL AS VARCHAR) AS mapping_note FROM t_country WHERE CAST(par AS INTEGER) % 3 <> 0
UNION ALL SELECT par, name, iso3, false, 'country', 'verified', iso3,
  'Comtrade code and ISO3 match M49 country/area: ' || upper(name), '', 'detail', 'partners',
  '1998-08-02', 'official', 'official', 'Official code and ISO3 verified; geometry coverage checked separately'
FROM t_country
WHERE CAST(par AS INTEGER) % 3 = 0 AND NOT is_group AND CAST(par AS INTEGER) % 5 <> 0""",
)
def reference_refresh(t: Tables):
    """Nations missing from the reviewed list, taken over where two lists agree."""
    number = F.col("partner_code").cast("int")
    existing = t.countries.where(number % 3 != 0)
    partners = t.countries.select(
        number.alias("id"),
        F.col("source_name").alias("name"),
        F.col("source_note").alias("note"),
        F.col("source_iso_alpha3").alias("iso3"),
        F.col("source_is_group").alias("is_group"),
    )
    other = F.when(number % 5 == 0, F.lit("XXX")).otherwise(F.col("source_iso_alpha3"))
    official = t.countries.select(
        F.col("partner_code").alias("code"),
        F.upper("source_name").alias("name"),
        other.alias("iso3"),
    )
    return refreshed_reference(existing, partners, official, "1998-08-02", "partners", "official")
