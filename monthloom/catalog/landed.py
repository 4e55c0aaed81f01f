"""Queries over landed files: the panel is stored as extracts and goes the whole way.

Months are Januaries and hold their year, all products are one and nations are numbered from
one, so that an extract holds many lines and none of its partners has the world's code.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.catalog.loading import extracts
from monthloom.catalog.oracle import growth, iso, money, nano, ratio
from monthloom.catalog.registry import REGIONS, Tables, query
from monthloom.functions.calendar import to_period
from monthloom.params import MARKETS, PRODUCTS, WORLD_CODE, Params
from monthloom.plans import landing, load, publish
from monthloom.plans.batch import Batch
from monthloom.schemas import PARTNER_COLUMNS, PARTNER_SCHEMA, RAW_COLUMNS, RAW_SCHEMA
from monthloom.sources.raw import scan_table
from monthloom.sources.star import typed
from monthloom.streaming.extracts import stream_extracts

PRODUCT = next(iter(PRODUCTS))
CODES = dict(zip(REGIONS, MARKETS))
LANDED = Params(start=date(1995, 1, 1), end=date(2001, 12, 1), products=(PRODUCT,), reporters=tuple(CODES.values()))


def landed_rows(t: Tables) -> DataFrame:
    """Raw rows with ``query_type``: detail of each year, market and revision, and its total."""
    code = F.coalesce(*[F.when(F.col("reporter_code") == name, code) for name, code in CODES.items()])
    detail = t.panel.detail.select(
        F.trunc("period_start_date", "YEAR").alias("period_start_date"),
        code.alias("reporter_code"),
        (F.col("partner_code").cast("int") + 1).cast("string").alias("partner_code"),
        F.lit(PRODUCT).alias("cmd_code"),
        "flow_code", "hs_version", "revision", "primary_value", "net_weight", "quantity", "ingested_at",
    )
    amounts = ("primary_value", "net_weight", "quantity")
    keys = [c for c in detail.columns if c not in (*amounts, "ingested_at")]

    def summed(frame: DataFrame) -> DataFrame:
        sums = [F.sum(name).cast("decimal(38,9)").alias(name) for name in amounts]
        return frame.groupBy(*keys).agg(*sums, F.max("ingested_at").alias("ingested_at"))

    both = None
    for kind, frame in (("partner_detail", detail), ("world_total", detail.withColumn("partner_code", F.lit(WORLD_CODE)))):
        made = summed(frame).withColumns({"period": to_period(F.col("period_start_date")), "source_file": F.lit(""), "checksum": F.lit(""), "run_id": F.lit("")})
        shaped = typed(made.select(*RAW_COLUMNS), RAW_SCHEMA).withColumn("query_type", F.lit(kind))
        both = shaped if both is None else both.unionByName(shaped)
    return load.cut_lineage(both)


def dimensions(t: Tables) -> dict[str, DataFrame]:
    """Countries numbered from one, and the product in every edition."""
    one_more = (F.col("partner_code").cast("int") + 1).cast("string")
    editions = t.panel.hs_codes.dropDuplicates(["hs_version"])
    return {
        "countries": t.panel.countries.withColumn("partner_code", one_more),
        "hs_codes": editions.withColumn("cmd_code", F.lit(PRODUCT)),
    }


def batch_of(t: Tables, root: str, name: str, **changes: object) -> Batch:
    """A run over the folders below ``root``."""
    return Batch(
        spark=t.spark, landing=f"{root}/landing", tables=f"{root}/tables", output=f"{root}/out", run_id=name, params=LANDED,
        markets={code: name for name, code in CODES.items()}, products={PRODUCT: PRODUCTS[PRODUCT]}, **{**dimensions(t), **changes},
    )


CODE_SQL = "c(rep, code) AS (VALUES " + ", ".join(f"('{n}', '{c}')" for n, c in CODES.items()) + ")"
LANDED_SQL = f"""{CODE_SQL},
l AS MATERIALIZED (SELECT CAST(date_trunc('year', m) AS DATE) AS m, code AS rep, CAST(CAST(par AS INTEGER) + 1 AS VARCHAR) AS par, par AS key,
  rev, CAST(sum(v) AS BIGINT) AS v FROM t_detail JOIN c USING (rep) GROUP BY ALL)"""
DELIVERED_SQL = f"""a AS MATERIALIZED (SELECT * FROM l QUALIFY dense_rank() OVER (PARTITION BY m, rep ORDER BY rev DESC) = 1),
w AS (SELECT m, rep, CAST(sum(v) AS BIGINT) AS v FROM a GROUP BY m, rep),
f AS MATERIALIZED (SELECT a.*, name, map3 FROM a JOIN t_verified x ON x.par = a.key)"""


@query(
    "batch_path",
    f"""WITH {LANDED_SQL}, {DELIVERED_SQL}
SELECT {iso("f.m", "month")}, '{PRODUCT}' AS cmd_code, 'H' || (f.rev + 3) AS hs_version, f.par AS partner_code, f.name AS source_name,
  f.map3 AS map_iso3, {money("f.v", "import_value")}, {nano(ratio("f.v", "w.v"), "market_share")},
  CASE WHEN w.v > 0 THEN 'ok' WHEN w.v IS NULL THEN 'missing_world' ELSE 'invalid_world' END AS market_share_status,
  CAST(NULL AS DOUBLE) AS previous_month_value, {money("p.v", "previous_year_value")}, CAST(NULL AS DOUBLE) AS mom,
  {nano(growth("f.v", "p.v"), "yoy")}, f.rep AS reporter_code
FROM f LEFT JOIN w USING (m, rep) LEFT JOIN f AS p ON p.m = f.m - INTERVAL 1 YEAR AND p.rep = f.rep AND p.par = f.par""",
)
def batch_path(t: Tables):
    """Partner rows of the snapshot that two runs publish, the second over new revisions only."""
    root, rows = t.scratch(), landed_rows(t)
    landing.land_extracts(rows.where("revision < 3"), f"{root}/landing")
    batch_of(t, root, "first").run()
    landing.land_extracts(rows.where("revision = 3"), f"{root}/landing")
    second = batch_of(t, root, "second")
    snapshot = second.run()
    wire = publish.read_snapshot(t.spark, publish.snapshot_folder(second.output, snapshot))[1]
    return publish.typed_rows(wire, PARTNER_SCHEMA).select(*PARTNER_COLUMNS)


@query(
    "stream_accepted",
    f"""WITH {LANDED_SQL}, kept AS (SELECT * FROM l WHERE rev = CASE WHEN rep = '{CODES["MIDDLE EAST"]}' THEN 1 ELSE 3 END),
late AS (SELECT DISTINCT m, rep FROM l WHERE rep = '{CODES["MIDDLE EAST"]}' AND rev = 1)
SELECT 'stored' AS what, {iso("m", "month")}, rep AS reporter_code, par AS partner_code, rev AS revision, {money("v", "primary_value")} FROM kept
UNION ALL SELECT r.what, {iso("m", "month")}, rep, NULL, 1, NULL
FROM late, (VALUES ('conflict'), ('ambiguous_revision'), ('ambiguous_revision')) r(what)""",
)
def stream_accepted(t: Tables):
    """What arriving manifests leave in the raw table, and what was refused.

    First revisions arrive, then third ones and, for one market, a first revision of other
    content. A third run with a new checkpoint meets everything again.
    """
    root, rows = t.scratch(), landed_rows(t)
    late = F.col("reporter_code") == CODES["MIDDLE EAST"]
    other = rows.where(late & (F.col("revision") == 1) & (F.col("query_type") == "partner_detail"))
    other = other.withColumns({"hs_version": F.lit("H1"), "primary_value": (F.col("primary_value") * 2).cast("decimal(38,9)")})
    arrivals = (rows.where("revision = 1"), rows.where((F.col("revision") == 3) & ~late).unionByName(other), None)
    for number, arrived in enumerate(arrivals):
        if arrived is not None:
            landing.land_extracts(arrived, f"{root}/landing")
        state = f"{root}/state-{number // 2}"
        run = stream_extracts(t.spark, f"{root}/landing", f"{root}/tables", state, *dimensions(t).values(), LANDED)
        run.awaitTermination()
    stored = scan_table(t.spark, f"{root}/tables/partner_detail").select(
        F.lit("stored").alias("what"), F.col("period_start_date").alias("month"), "reporter_code", "partner_code", "revision", "primary_value"
    )
    refused = t.spark.read.schema("extract string, reasons array<string>").json(f"{root}/tables/rejected")
    part = lambda name: F.regexp_extract("extract", f"/{name}=([^/]+)", 1)
    named = refused.select(
        F.array_join("reasons", "+").alias("what"), F.to_date(part("period"), "yyyyMM").alias("month"), part("reporter_code").alias("reporter_code"),
        F.lit(None).cast("string").alias("partner_code"), part("revision").cast("long").alias("revision"),
        F.lit(None).cast("decimal(38,9)").alias("primary_value"),
    )
    return stored.unionByName(named)


@query(
    "affected_months_feed",
    """WITH old AS (SELECT max(ing) AS hi FROM t_fact WHERE m < DATE '2000-06-01')
SELECT DISTINCT strftime(m, '%Y-%m-%d') AS period_start_date FROM t_detail, old WHERE ing >= hi""",
)
def affected_months_feed(t: Tables):
    """Months loaded since the fact was last built, out of the audit log alone."""
    path = f"{t.scratch()}/audit"
    loaded = extracts(t.panel.detail).withColumn("kind", F.lit("partner_detail"))
    load.append_audit(load.audit_events(loaded).withColumn("event_at", F.col("source_ingested_at")), path)
    old = t.multi.fact.where(F.col("period_start_date") < F.lit(date(2000, 6, 1)))
    seen = old.agg(F.max("ingested_at")).first()[0]
    return load.months_since(load.scan_audit(t.spark, path), seen)
