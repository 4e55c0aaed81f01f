"""Snapshot export: validate, write a new version, switch the pointer, verify."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthloom.functions.calendar import check_export_range
from monthloom.functions.text import (
    is_plain_decimal,
    valid_code,
    valid_edition,
    valid_iso3,
)
from monthloom.operators.aggregate import (
    availability,
    duplicates,
    row_multiset_digest,
    snapshot_counters,
    with_data,
)
from monthloom.operators.sets import symmetric_difference, union_struct_tagged
from monthloom.params import (
    HHI_STATUSES,
    MARKETS,
    PARTS_PRODUCT,
    PRODUCTS,
    SCHEMA_VERSION,
    SHARE_STATUSES,
    SPECIAL_CODES,
    Params,
)
from monthloom.plans.landing import reasons
from monthloom.plans.load import cut_lineage, require_none
from monthloom.plans.quality import orphans, spine_gaps
from monthloom.schemas import MONTHLY_COLUMNS, MONTHLY_SCHEMA, PARTNER_COLUMNS, PARTNER_SCHEMA
from monthloom.sources.raw import in_range, path_exists
from monthloom.sources.snapshot import (
    file_index,
    scan_documents,
    to_wire,
    write_documents,
)

METADATA_FIELDS = (
    "start_month",
    "end_exclusive",
    "latest_data_month",
    "valid_detail_count",
    "positive_amount_count",
    "row_target_met",
    "availability",
    "monthly_rows",
    "monthly_digest",
    "partners_rows",
    "partners_digest",
)


def export_pair(
    monthly: DataFrame, partners: DataFrame, start: date, end_exclusive: date
) -> DataFrame:
    """Both marts out of one plan, tagged, in export order."""
    pair = union_struct_tagged(
        {
            "monthly": in_range(monthly, "month", start, end_exclusive),
            "partners": in_range(partners, "month", start, end_exclusive),
        }
    )
    either = [
        F.coalesce(F.col(f"monthly.{name}"), F.col(f"partners.{name}"))
        for name in ("month", "reporter_code", "cmd_code")
    ]
    return pair.orderBy(either[0], "kind", *either[1:], "partners.partner_code")


def _optional(test: Column, column: Column) -> Column:
    return column.isNull() | test


def _row_rules(products: Sequence[str], money: Sequence[str]) -> list[tuple[Column, str]]:
    month = F.col("month").try_cast("date")
    amounts = [(_optional(is_plain_decimal(F.col(n)), F.col(n)), n) for n in money]
    return [
        (month == F.trunc(month, "MM"), "month"),
        (F.col("cmd_code").isin(*products), "cmd_code"),
        (valid_code(F.col("reporter_code")), "reporter_code"),
        *amounts,
    ]


def _money(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.DecimalType)]


def validate_monthly(
    rows: DataFrame, products: Sequence[str], reporters: Sequence[str]
) -> DataFrame:
    """Wire rows of the month document with the list of broken rules."""
    edition = F.col("hs_version")
    found = reasons(
        *_row_rules(products, _money(MONTHLY_SCHEMA)),
        (F.col("reporter_code").isin(*reporters), "market"),
        (_optional(valid_edition(edition), edition), "hs_version"),
        (F.col("country_count").isNotNull(), "country_count"),
        (F.col("hhi_status").isin(*HHI_STATUSES), "hhi_status"),
        (F.col("has_world").isNotNull() & F.col("has_countries").isNotNull(), "flags"),
    )
    return rows.withColumn("reasons", found)


def validate_partners(rows: DataFrame, products: Sequence[str]) -> DataFrame:
    """Wire rows of the partner document with the list of broken rules."""
    iso3, code = F.col("map_iso3"), F.col("partner_code")
    plain_code = F.regexp_replace(code, r"^0+(?=[0-9])", "")
    found = reasons(
        *_row_rules(products, _money(PARTNER_SCHEMA)),
        (F.col("import_value").isNotNull(), "import_value"),
        (valid_edition(F.col("hs_version")), "hs_version"),
        (valid_code(code) & ~plain_code.isin(*SPECIAL_CODES), "partner_code"),
        (_optional(valid_iso3(iso3), iso3), "map_iso3"),
        (F.col("market_share_status").isin(*SHARE_STATUSES), "market_share_status"),
    )
    return rows.withColumn("reasons", found)


def invalid(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reasons") > 0)


def typed_rows(wire: DataFrame, schema: T.StructType) -> DataFrame:
    return wire.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def check_snapshot(
    monthly: DataFrame,
    partners: DataFrame,
    params: Params,
) -> None:
    """Row rules, complete spine per scope, some data, unique partner keys, no orphans."""
    wire_monthly = to_wire(monthly, MONTHLY_SCHEMA)
    wire_partners = to_wire(partners, PARTNER_SCHEMA)
    require_none(document_checks(wire_monthly, wire_partners, monthly, partners, params))


def document_checks(
    wire_monthly: DataFrame,
    wire_partners: DataFrame,
    monthly: DataFrame,
    partners: DataFrame,
    params: Params,
) -> dict[str, DataFrame]:
    """Violating rows per rule of the two documents."""
    key = ["reporter_code", "cmd_code", "month"]
    filled = monthly.agg(F.count_if(with_data()).alias("n"))
    return {
        "invalid month row": invalid(
            validate_monthly(wire_monthly, params.products, params.reporters)
        ),
        "invalid partner row": invalid(validate_partners(wire_partners, params.products)),
        "incomplete month spine": spine_gaps(monthly, params),
        "duplicate month row": duplicates(monthly, key),
        "no month has data": filled.where(F.col("n") == 0),
        "duplicate partner grain": duplicates(partners, [*key, "partner_code"]),
        "partner outside the monthly range": orphans(partners, monthly),
    }


def document_summary(frame: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    wire = to_wire(frame, schema)
    line = F.to_json(F.struct(*sorted(wire.columns)), {"ignoreNullFields": "false"})
    return wire.select(line.alias("line")).agg(
        F.count("*").alias(f"{name}_rows"), row_multiset_digest(F.col("line")).alias(f"{name}_digest")
    )


def scope_metadata(
    monthly: DataFrame, partners: DataFrame, start: date, end_exclusive: date
) -> DataFrame:
    """One row: counters, availability per scope, latest month and content digests.

    The scopes are at most markets x products, so the availability list is small.
    """
    listed = availability(monthly).select(F.struct("*").alias("scope"))
    scopes = listed.agg(F.array_sort(F.collect_list("scope")).alias("availability"))
    latest = monthly.agg(F.max(F.when(with_data(), F.col("month"))).alias("latest"))
    counters = snapshot_counters(partners)
    months = document_summary(monthly, MONTHLY_SCHEMA, "monthly")
    rows = document_summary(partners, PARTNER_SCHEMA, "partners")
    return counters.select(
        "*",
        scopes.scalar().alias("availability"),
        latest.scalar().cast("string").alias("latest_data_month"),
        months.select("monthly_rows").scalar().alias("monthly_rows"),
        months.select("monthly_digest").scalar().alias("monthly_digest"),
        rows.select("partners_rows").scalar().alias("partners_rows"),
        rows.select("partners_digest").scalar().alias("partners_digest"),
        F.lit(start.isoformat()).alias("start_month"),
        F.lit(end_exclusive.isoformat()).alias("end_exclusive"),
    )


def snapshot_manifest(
    metadata: DataFrame,
    snapshot_id: str,
    params: Params,
    markets: dict[str, str] = MARKETS,
    products: dict[str, str] = PRODUCTS,
) -> DataFrame:
    market_list = F.array(
        *[
            F.struct(F.lit(code).alias("reporter_code"), F.lit(name).alias("name"))
            for code, name in markets.items()
        ]
    )
    product_list = F.array(
        *[
            F.struct(
                F.lit(code).alias("cmd_code"),
                F.lit(name).alias("name"),
                F.lit(code == PARTS_PRODUCT).alias("is_parts"),
            )
            for code, name in products.items()
        ]
    )
    return metadata.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(snapshot_id).alias("snapshot_id"),
        F.current_timestamp().alias("generated_at"),
        F.lit("USD").alias("currency"),
        F.lit("string").alias("decimal_encoding"),
        F.lit(str(params.tolerance)).alias("hhi_coverage_tolerance"),
        *METADATA_FIELDS,
        market_list.alias("markets"),
        product_list.alias("products"),
    )


def _next_month(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def publish_snapshot(
    monthly: DataFrame,
    partners: DataFrame,
    output: str,
    params: Params,
    gate: DataFrame | None = None,
    markets: dict[str, str] = MARKETS,
    products: dict[str, str] = PRODUCTS,
    unmoved: Callable[[], None] | None = None,
) -> str:
    """Write and check a new version, then add a pointer to it; returns its id.

    Both marts are pinned first, so the checks and the files see the same rows. ``unmoved``
    is called right before the pointer and may refuse. A failure leaves the last pointer, and
    with it the published version, as it was.
    """
    end_exclusive = _next_month(params.end)
    check_export_range(params.start, end_exclusive)
    if gate is not None and not gate.select("publishable").first()[0]:
        raise ValueError("the build did not pass every model and check")
    spark = monthly.sparkSession
    months = cut_lineage(
        in_range(monthly, "month", params.start, end_exclusive).select(*MONTHLY_COLUMNS)
    )
    rows = cut_lineage(
        in_range(partners, "month", params.start, end_exclusive).select(*PARTNER_COLUMNS)
    )
    check_snapshot(months, rows, params)
    snapshot_id = uuid.uuid4().hex
    folder = snapshot_folder(output, snapshot_id)
    write_documents(to_wire(months, MONTHLY_SCHEMA), f"{folder}/monthly")
    write_documents(to_wire(rows, PARTNER_SCHEMA), f"{folder}/partners", "reporter_code")
    for name in ("monthly", "partners"):
        file_index(spark, f"{folder}/{name}").write.json(f"{folder}/files/{name}")
    metadata = scope_metadata(months, rows, params.start, end_exclusive)
    manifest = snapshot_manifest(metadata, snapshot_id, params, markets, products)
    manifest.write.json(f"{folder}/manifest")
    verify_version(spark, folder, params, contents_only=True)
    verify_identity(spark, folder, snapshot_id, params, markets, products)
    pointer = spark.range(1, numPartitions=1).select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(snapshot_id).alias("snapshot_id"),
        F.lit(manifest_hash(spark, folder)).alias("manifest_sha256"),
        F.current_timestamp().alias("published_at"),
    )
    if unmoved is not None:
        unmoved()
    pointer.write.mode("append").json(f"{output}/pointers")
    return snapshot_id


def snapshot_folder(output: str, snapshot_id: str) -> str:
    return f"{output}/snapshots/{snapshot_id}"


def current_pointer(spark: SparkSession, output: str) -> Row | None:
    """The pointer written last: schema version, id and manifest hash."""
    path = f"{output}/pointers"
    if not path_exists(spark, path):
        return None
    schema = "schema_version string, snapshot_id string, manifest_sha256 string, published_at timestamp"
    pointers = spark.read.schema(schema).json(path)
    last = pointers.agg(F.max(F.struct("published_at", *pointers.columns[:3])).alias("last"))
    return last.first()["last"]


def current_snapshot(spark: SparkSession, output: str) -> str | None:
    """Id of the version published last."""
    pointer = current_pointer(spark, output)
    return pointer and pointer["snapshot_id"]


def manifest_hash(spark: SparkSession, folder: str) -> str:
    """SHA-256 over the manifest, which is one line."""
    lines = spark.read.text(f"{folder}/manifest").select(F.sha2("value", 256)).collect()
    if len(lines) != 1:
        raise ValueError(f"{len(lines)} lines in the manifest")
    return lines[0][0]


def verify_identity(
    spark: SparkSession,
    folder: str,
    snapshot_id: str,
    params: Params,
    markets: dict[str, str] = MARKETS,
    products: dict[str, str] = PRODUCTS,
) -> None:
    """The manifest names this version, this schema and the markets and products asked for."""
    found = spark.read.json(f"{folder}/manifest").first()
    expected = {
        "schema_version": SCHEMA_VERSION,
        "snapshot_id": snapshot_id,
        "currency": "USD",
        "decimal_encoding": "string",
        "hhi_coverage_tolerance": str(params.tolerance),
    }
    wrong = [name for name, value in expected.items() if found is None or found[name] != value]
    if found is not None:
        if [(m["reporter_code"], m["name"]) for m in found["markets"]] != list(markets.items()):
            wrong.append("markets")
        if [(p["cmd_code"], p["name"]) for p in found["products"]] != list(products.items()):
            wrong.append("products")
    if wrong:
        raise ValueError(f"manifest fields differ: {', '.join(wrong)}")


def read_snapshot(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    monthly = scan_documents(spark, f"{folder}/monthly", MONTHLY_SCHEMA)
    partners = scan_documents(spark, f"{folder}/partners", PARTNER_SCHEMA)
    return monthly.select(*MONTHLY_COLUMNS), partners.select(*PARTNER_COLUMNS)


def verify_version(
    spark: SparkSession, folder: str, params: Params, contents_only: bool = False
) -> None:
    """Recompute file hashes, row rules and metadata of one version and compare.

    The metadata hold a digest of all rows, so ``contents_only`` is enough right after
    the rows themselves were checked.
    """
    checks = {}
    for name in ("monthly", "partners"):
        schema = "file string, bytes bigint, rows bigint, sha256 string"
        wanted = spark.read.schema(schema).json(f"{folder}/files/{name}")
        found = file_index(spark, f"{folder}/{name}")
        changed = symmetric_difference(wanted, found, ["file", "bytes", "rows", "sha256"])
        checks[f"{name} checksum mismatch"] = changed
    require_none(checks)
    wire_monthly, wire_partners = read_snapshot(spark, folder)
    monthly = typed_rows(wire_monthly, MONTHLY_SCHEMA)
    partners = typed_rows(wire_partners, PARTNER_SCHEMA)
    if not contents_only:
        require_none(document_checks(wire_monthly, wire_partners, monthly, partners, params))
    derived = scope_metadata(monthly, partners, params.start, _next_month(params.end))
    as_json = F.to_json(F.struct(*METADATA_FIELDS), {"ignoreNullFields": "false"})
    schema = T.StructType([derived.schema[name] for name in METADATA_FIELDS])
    stored = spark.read.schema(schema).json(f"{folder}/manifest").select(as_json).first()
    if stored is None or stored[0] != derived.select(as_json).first()[0]:
        raise ValueError("manifest metadata differs from data")


def verify_snapshot(
    spark: SparkSession,
    output: str,
    params: Params,
    markets: dict[str, str] = MARKETS,
    products: dict[str, str] = PRODUCTS,
) -> str:
    pointer = current_pointer(spark, output)
    if pointer is None:
        raise ValueError("nothing is published")
    snapshot_id = pointer["snapshot_id"]
    folder = snapshot_folder(output, snapshot_id)
    if pointer["schema_version"] != SCHEMA_VERSION:
        raise ValueError("pointer of another schema version")
    if manifest_hash(spark, folder) != pointer["manifest_sha256"]:
        raise ValueError("manifest is not the published one")
    verify_identity(spark, folder, snapshot_id, params, markets, products)
    verify_version(spark, folder, params)
    return snapshot_id


def delivery_differences(source: DataFrame, delivered: DataFrame) -> DataFrame:
    """Rows lost or added by the split into one file set per market."""
    return symmetric_difference(source, delivered, PARTNER_COLUMNS)


