"""Queries over stored tables: what a publication refuses, versions beside rows, seeds, typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.catalog.landed import CODES, DELIVERED_SQL, LANDED, LANDED_SQL, batch_of, landed_rows
from monthloom.catalog.marts import RAW_SQL
from monthloom.catalog.registry import Tables, query
from monthloom.operators import revision, select
from monthloom.params import KINDS
from monthloom.plans import landing, load, publish
from monthloom.schemas import MONTHLY_SCHEMA, PARTNER_SCHEMA
from monthloom.sources.landing import scan_lines
from monthloom.sources.raw import scan_table, write_table
from monthloom.sources.seeds import scan_countries
from monthloom.sources.snapshot import file_index, to_wire


class Damage:
    """A published version that is spoiled step by step, always before what was spoiled last is checked."""

    def __init__(self, t: Tables, output: str, snapshot: str) -> None:
        self.spark, self.output, self.snapshot = t.spark, output, snapshot
        self.folder = publish.snapshot_folder(output, snapshot)

    def point(self, version: str = publish.SCHEMA_VERSION) -> None:
        """A newer pointer to the manifest as it is now."""
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(version).alias("schema_version"), F.lit(self.snapshot).alias("snapshot_id"),
            F.lit(publish.manifest_hash(self.spark, self.folder)).alias("manifest_sha256"),
            F.current_timestamp().alias("published_at"),
        )
        row.write.mode("append").json(f"{self.output}/pointers")

    def manifest(self, pattern: str, value: str) -> None:
        """Another value in the manifest, which is one line."""
        path = f"{self.folder}/manifest"
        changed = load.cut_lineage(self.spark.read.text(path).select(F.regexp_replace("value", pattern, value).alias("value")))
        changed.coalesce(1).write.mode("overwrite").text(path)

    def add(self, name: str, rows: DataFrame, *partition: str) -> None:
        """One more file of a document."""
        writer = rows.coalesce(1).write.mode("append").option("compression", "gzip").option("ignoreNullFields", False)
        (writer.partitionBy(*partition) if partition else writer).json(f"{self.folder}/{name}")

    def index(self, name: str) -> None:
        """File hashes of a document as it is now."""
        found = load.cut_lineage(file_index(self.spark, f"{self.folder}/{name}"))
        found.write.mode("overwrite").json(f"{self.folder}/files/{name}")


EUROPE = CODES["EUROPE"]


@query(
    "publication_outcomes",
    f"""WITH {LANDED_SQL}, {DELIVERED_SQL}, u AS (SELECT count(*) AS n FROM (SELECT DISTINCT m, rep FROM l)), p AS (SELECT count(*) AS n FROM f)
SELECT 'published' AS step, 'verified' AS outcome, n AS rows FROM p
UNION ALL SELECT 'replay', 'already_loaded', 2 * n FROM u
UNION ALL SELECT 'empty', 'no month has data', 1
UNION ALL SELECT 'other counters', 'manifest metadata differs from data', 1
UNION ALL SELECT 'market twice', 'duplicate partner grain', count(*) FROM f WHERE rep = '{EUROPE}'
UNION ALL SELECT 'file added', 'monthly checksum mismatch', 1
UNION ALL SELECT 'other id', 'manifest fields differ: snapshot_id', 1
UNION ALL SELECT 'manifest changed', 'manifest is not the published one', 1
UNION ALL SELECT 'other schema', 'pointer of another schema version', 1
UNION ALL SELECT 'published again', 'verified', n FROM p""",
)
def publication_outcomes(t: Tables):
    """What replay, publication, an empty mart and each kind of damage come to, with the rows concerned.

    The panel goes the whole way once; its load is repeated; then the published version is
    damaged, and at last published anew.
    """
    root, found = t.scratch(), []
    landing.land_extracts(landed_rows(t), f"{root}/landing")
    run = batch_of(t, root, "first")

    def outcome(step: str, action) -> None:
        try:
            found.append((step, "verified", action()))
        except ValueError as refused:
            for part in str(refused).split("; "):
                text, _, number = part.removesuffix(" rows").rpartition(": ")
                found.append((step, text, int(number)) if number.isdigit() else (step, part, 1))

    def verify() -> int:
        snapshot = publish.verify_snapshot(t.spark, run.output, run.params, run.markets, run.products)
        return publish.read_snapshot(t.spark, publish.snapshot_folder(run.output, snapshot))[1].count()

    damage = Damage(t, run.output, run.run())
    outcome("published", verify)

    scanned = run.last("scan")["attempt"]
    extracts = t.spark.read.parquet(f"{run.folder('extracts')}/{scanned}")
    rows = landing.parse_records(scan_lines(t.spark, run.landing, run.patterns(extracts)))
    again = load.load_extracts(t.spark, run.tables, extracts, rows)
    found.append(("replay", again["status"], load.scan_audit(t.spark, f"{run.tables}/audit").where("status = 'success'").count()))

    monthly, partners = run.marts(run.last("transform")["attempt"])
    keys = ("month", "reporter_code", "cmd_code")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in MONTHLY_SCHEMA if f.name not in keys}
    nothing |= {"country_count": F.lit(0).cast(MONTHLY_SCHEMA["country_count"].dataType), "hhi_status": F.lit("missing_world")}
    nothing |= {"has_world": F.lit(False), "has_countries": F.lit(False)}
    bare = monthly.withColumns(nothing)
    outcome(
        "empty",
        lambda: publish.publish_snapshot(bare, partners.limit(0), run.output, LANDED, markets=run.markets, products=run.products),
    )

    wire_monthly, wire_partners = to_wire(monthly, MONTHLY_SCHEMA), to_wire(partners, PARTNER_SCHEMA)
    market = F.col("reporter_code") == EUROPE
    damage.manifest('"valid_detail_count":[0-9]+', '"valid_detail_count":-1')
    damage.point()
    outcome("other counters", verify)
    damage.add("partners", wire_partners.where(market), "reporter_code")
    damage.index("partners")
    outcome("market twice", verify)
    damage.add("monthly", wire_monthly.where(market))
    outcome("file added", verify)
    damage.manifest('"snapshot_id":"[^"]*"', '"snapshot_id":"other"')
    damage.point()
    outcome("other id", verify)
    damage.manifest('"currency":"USD"', '"currency":"EUR"')
    outcome("manifest changed", verify)
    damage.point("other")
    outcome("other schema", verify)

    publish.publish_snapshot(monthly, partners, run.output, run.params, markets=run.markets, products=run.products)
    outcome("published again", verify)
    return t.spark.createDataFrame(found, "step string, outcome string, rows long")


@query("accepted_stored_extract", f"SELECT {RAW_SQL} FROM t_accepted")
def accepted_stored_extract(t: Tables):
    """Accepted rows of a stored table whose versions are kept beside it: its rows are read once."""
    root, detail = t.scratch(), t.panel.detail
    for part in (detail.where("revision < 3"), detail.where("revision = 3")):
        write_table(part, f"{root}/raw", mode="append")
        load.append_versions(part, KINDS[0], f"{root}/versions")
    stored = scan_table(t.spark, f"{root}/raw").select(*detail.columns)
    return revision.accept_latest_extract(stored, versions=load.scan_versions(t.spark, f"{root}/versions"))


@query(
    "seed_countries",
    """SELECT par AS partner_code, name || ', "' || iso3 || '"' AS source_name, 'a, "b"' AS source_note, iso3 AS source_iso_alpha3, is_group AS source_is_group, kind AS partner_type, status AS classification_status,
  map3 AS map_iso3, role AS reconciliation_role, 'star' AS source_url, '1998-08-02' AS retrieved_at,
  'star' AS classification_source_url, note AS classification_note, 'star' AS mapping_source_url, CAST(NULL AS VARCHAR) AS mapping_note
FROM t_country""",
)
def seed_countries(t: Tables):
    """The country list written as a quoted CSV seed and read back by its declared schema."""
    path = f"{t.scratch()}/countries.csv"
    odd = F.concat("source_name", F.lit(', "'), "source_iso_alpha3", F.lit('"'))
    seeds = t.countries.withColumns({"source_name": odd, "source_note": F.lit('a, "b"')})
    seeds.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return scan_countries(t.spark, path)


@query(
    "typed_columns",
    """SELECT par AS partner_code, CAST(par AS BIGINT) AS code, CAST(rev AS INTEGER) AS revision, m >= DATE '1998-01-01' AS late,
  strftime(m, '%Y-%m-%d') AS month, CAST(v AS DOUBLE) / 100 AS amount FROM t_detail""",
)
def typed_columns(t: Tables):
    """Text fields of a record cast by a map of names and types."""
    texts = t.panel.detail.select(
        "partner_code",
        F.struct(
            F.col("partner_code").alias("code"), F.col("revision").cast("string").alias("revision"),
            (F.col("period_start_date") >= "1998-01-01").cast("string").alias("late"),
            F.col("period_start_date").cast("string").alias("month"), F.col("primary_value").cast("string").alias("amount"),
        ).alias("record"),
    )
    types = {"code": "bigint", "revision": "int", "late": "boolean", "month": "date", "amount": "decimal(38,9)"}
    return texts.select("partner_code", *select.cast_columns("record", types))
