"""Contracts of landed rows and extracts.

Each check adds a reason instead of stopping at the first error; an extract is
accepted when neither it nor any of its rows has one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.functions.calendar import month_frame, period_start, valid_period
from monthloom.functions.text import canonical_json, namespaced_sha256, parse_decimal
from monthloom.functions.text import plain_decimal, valid_edition
from monthloom.operators.aggregate import exact_sum, row_multiset_digest
from monthloom.operators.revision import latest_manifests
from monthloom.params import (
    CUSTOMS_CODE,
    FIRST_MONTH,
    FREQUENCY,
    IMPORT_FLOW,
    KINDS,
    PRODUCTS,
    SCHEMA_VERSION,
)
from monthloom.sources.landing import (
    PATH_FIELDS,
    path_identity,
    scan_checksums,
    scope_paths,
    split_kind,
    write_lines,
    write_manifests,
)

MONEY = "decimal(38,9)"
EXTRACT_IDENTITY = ("kind", "reporter_code", "cmd_code", "period")


# Fields of the contract. A JSON number also reads as text, so the text fields are
# read a second time as numbers: whatever that finds was not written as text.
RECORD_SCHEMA = (
    "period string, freqCode string, flowCode string, cmdCode string, customsCode string, "
    "classificationCode string, primaryValue string, netWgt string, qty string, "
    "reporterCode bigint, partnerCode bigint, partner2Code bigint, motCode bigint, "
    "isOriginalClassification boolean, malformed string"
)
NUMBER_SCHEMA = (
    "period double, freqCode double, flowCode double, cmdCode double, customsCode double, "
    "classificationCode double, primaryValue double, netWgt double, qty double"
)


def _text(name: str) -> Column:
    """The field if it was written as JSON text."""
    return F.when(F.col(f"numeric.{name}").isNull(), F.col(f"record.{name}"))


def _absent(name: str) -> Column:
    return F.col(f"record.{name}").isNull() & F.col(f"numeric.{name}").isNull()


def reasons(*checks: tuple[Column, str]) -> Column:
    """Names of the failed checks; an unknown result counts as a failure."""
    found = [F.when(F.coalesce(ok, F.lit(False)), None).otherwise(name) for ok, name in checks]
    return F.array_compact(F.array(*found))


def parse_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """Fields of the contract out of JSON lines, with the reason list of each row."""
    both = F.struct(
        F.from_json(line, RECORD_SCHEMA, {"columnNameOfCorruptRecord": "malformed"}).alias("record"),
        F.from_json(line, NUMBER_SCHEMA, {"mode": "PERMISSIVE"}).alias("numeric"),
    )
    # Unfolding a one-element array keeps later filters from being pushed below the
    # parsing, where every field they mention would parse the line again.
    read = lines.select(*lines.columns, F.inline(F.array(both)))
    parsed = read.withColumns(
        {
            "amount": parse_decimal(_text("primaryValue")),
            "net_weight": parse_decimal(_text("netWgt")),
            "quantity": parse_decimal(_text("qty")),
        }
    )
    checks = [
        (F.col("record.malformed").isNull(), "malformed"),
        (_text("freqCode") == FREQUENCY, "frequency"),
        (_text("flowCode") == IMPORT_FLOW, "flow"),
        (F.col("record.partner2Code") == 0, "second_partner"),
        (_text("customsCode") == CUSTOMS_CODE, "customs"),
        (F.col("record.motCode") == 0, "transport"),
        (F.col("record.isOriginalClassification"), "original_classification"),
        (F.col("record.partnerCode") >= 0, "partner"),
        (F.col("amount") >= 0, "amount"),
        (_absent("netWgt") | F.col("net_weight").isNotNull(), "net_weight"),
        (_absent("qty") | F.col("quantity").isNotNull(), "quantity"),
    ]
    kept = [name for name in lines.columns if name != line]
    return parsed.select(
        *kept,
        _text("period").alias("period"),
        F.col("record.reporterCode").cast("string").alias("reporter_code"),
        F.col("record.partnerCode").cast("string").alias("partner_code"),
        _text("flowCode").alias("flow_code"),
        _text("cmdCode").alias("cmd_code"),
        _text("classificationCode").alias("hs_version"),
        F.col("amount").alias("primary_value"),
        "net_weight",
        "quantity",
        reasons(*checks).alias("row_reasons"),
    )


def check_identity(rows: DataFrame, manifests: DataFrame) -> DataFrame:
    """Rows against the request in their manifest; adds to ``row_reasons``."""
    wanted = manifests.select(
        "extract",
        F.col("period").alias("w_period"),
        F.col("reporter_code").alias("w_reporter"),
        F.col("cmd_code").alias("w_product"),
        F.col("hs_version").alias("w_edition"),
        F.col("query_type").alias("w_kind"),
    )
    joined = rows.join(wanted, "extract")
    more = reasons(
        (F.col("period") == F.col("w_period"), "period"),
        (F.col("reporter_code") == F.col("w_reporter"), "reporter"),
        (F.col("cmd_code") == F.col("w_product"), "product"),
        (F.col("hs_version") == F.col("w_edition"), "edition"),
        (split_kind(F.col("partner_code")) == F.col("w_kind"), "world_detail_split"),
    )
    both = F.concat("row_reasons", more)
    hidden = [name for name in wanted.columns if name != "extract"]
    return joined.withColumn("row_reasons", both).drop(*hidden)


def extract_facts(rows: DataFrame, key: Sequence[str] = ("extract",)) -> DataFrame:
    """Counts, exact sum and distinct partners of each extract.

    Rows are first combined per partner, so neither step gathers an extract whole.
    """
    bad = F.count_if(F.size("row_reasons") > 0)
    per_partner = rows.groupBy(*key, "partner_code", "hs_version").agg(
        F.count("*").alias("n"),
        exact_sum(F.col("primary_value")).alias("amount"),
        bad.alias("bad"),
    )
    return per_partner.groupBy(*key).agg(
        F.sum("n").alias("rows"),
        F.sum("amount").cast(MONEY).alias("amount"),
        F.sum("bad").alias("bad_rows"),
        F.count_distinct("partner_code").alias("partners"),
        F.count_distinct("hs_version").alias("editions"),
        F.coalesce(F.sum(F.when(F.col("partner_code") == "0", F.col("n"))), F.lit(0)).alias(
            "world_rows"
        ),
    )


def edition_splits(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("editions") != 1)


def unrequested(rows: DataFrame, requested: DataFrame) -> DataFrame:
    return rows.join(requested.select("reporter_code").distinct(), "reporter_code", "left_anti")


def manifest_checks(
    products: Sequence[str], earliest: date = FIRST_MONTH
) -> list[tuple[Column, str]]:
    """Rules of a manifest on its own and against its path."""
    request = F.col("request_parameters")
    stamped = F.col("ingested_at").rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})\z")
    kind = F.col("query_type")
    return [
        (F.col("_corrupt").isNull(), "invalid_manifest"),
        (F.col("schema_version") == SCHEMA_VERSION, "schema_version"),
        (valid_edition(F.col("hs_version")), "hs_version"),
        (kind.isin(*KINDS), "query_type"),
        (F.col("cmd_code").isin(*products), "product"),
        (F.col("revision") > 0, "revision"),
        (valid_period(F.col("period"), earliest), "period"),
        (stamped & F.col("ingested_at").try_cast("timestamp").isNotNull(), "ingested_at"),
        (
            (F.col("path_reporter_code") == F.col("reporter_code"))
            & (F.col("path_hs_version") == F.col("hs_version"))
            & (F.col("path_cmd_code") == F.col("cmd_code"))
            & (F.col("path_period") == F.col("period"))
            & (F.col("path_query_type") == kind)
            & (F.col("path_revision") == F.col("revision")),
            "path_identity",
        ),
        (
            (request["period"] == F.col("period"))
            & (request["cmdCode"] == F.col("cmd_code"))
            & (request["flowCode"] == IMPORT_FLOW)
            & (request["partner2Code"] == "0")
            & (request["customsCode"] == CUSTOMS_CODE)
            & (request["motCode"] == "0"),
            "request_identity",
        ),
        (~kind.eqNullSafe("world_total") | (request["partnerCode"] == "0"), "world_request"),
    ]


def reconcile(
    manifests: DataFrame,
    rows: DataFrame,
    checksums: DataFrame,
    products: Sequence[str] = tuple(PRODUCTS),
    earliest: date = FIRST_MONTH,
) -> DataFrame:
    """Manifests with ``reasons``: everything that keeps an extract from loading."""
    facts = extract_facts(check_identity(rows, manifests))
    joined = manifests.join(facts, "extract", "left").join(checksums, "extract", "left")
    count = F.coalesce("rows", F.lit(0))
    world = F.col("query_type") == "world_total"
    total = parse_decimal(F.col("primary_value_sum"))
    found = reasons(
        *manifest_checks(products, earliest),
        (F.col("checksum") == F.col("data_checksum"), "checksum"),
        (F.col("row_count") == count, "row_count"),
        (count > 0, "empty"),
        (~world | (count == 1), "world_rows"),
        (F.col("amount") == total, "amount_sum"),
        (F.col("partners") == F.col("rows"), "duplicate_grain"),
        (F.col("editions") == 1, "single_edition"),
        (F.col("bad_rows") == 0, "rows"),
    )
    return joined.withColumn("reasons", found)


def accepted(reconciled: DataFrame) -> DataFrame:
    """One row per usable extract, typed for loading."""
    return reconciled.where(F.size("reasons") == 0).select(
        "extract",
        F.col("query_type").alias("kind"),
        "reporter_code",
        "cmd_code",
        "hs_version",
        "period",
        period_start(F.col("period")).alias("period_start_date"),
        "revision",
        "checksum",
        "row_count",
        parse_decimal(F.col("primary_value_sum")).alias("primary_value_sum"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        F.concat("extract", F.lit("/data.ndjson")).alias("source_file"),
        "manifest_file",
    )


def newest_extracts(extracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The newest accepted revision per identity, and extracts that share a revision.

    Two extracts of one identity with the same revision are ambiguous: neither loads.
    """
    newest = latest_manifests(extracts, EXTRACT_IDENTITY)
    shared = newest.where(F.col("copies") > 1).select(*EXTRACT_IDENTITY, "revision")
    ambiguous = extracts.join(shared, [*EXTRACT_IDENTITY, "revision"], "left_semi")
    chosen = newest.where(F.col("copies") == 1).select(*extracts.columns)
    return chosen, ambiguous


def digest_extracts(
    rows: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Count, sum and content digest of each extract, whatever its size.

    The digest adds up hash lanes of the canonical lines, so it is combined before the
    shuffle and no extract is gathered.
    """
    return rows.groupBy(*key).agg(
        F.count("*").alias("row_count"),
        exact_sum(F.col("primary_value")).alias("primary_value_sum"),
        row_multiset_digest(canonical_json(columns)).alias("content_digest"),
    )


def serialize_extracts(
    rows: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Canonical text, checksum, count and sum of each extract.

    For a consumer that wants the text of one extract as one value; all extracts are
    treated alike. ``digest_extracts`` identifies contents without gathering them.
    """
    order = F.struct(
        F.col("period").alias("p"),
        F.col("partner_code").cast("bigint").alias("c"),
        F.col("cmd_code").alias("m"),
        canonical_json(columns).alias("line"),
    )
    sorted_lines = F.transform(F.array_sort(F.collect_list(order)), lambda item: item["line"])
    texts = rows.groupBy(*key).agg(
        F.count("*").alias("row_count"),
        exact_sum(F.col("primary_value")).alias("primary_value_sum"),
        F.concat(F.array_join(sorted_lines, "\n"), F.lit("\n")).alias("data"),
    )
    return texts.withColumn("checksum", namespaced_sha256(F.col("data")))


def worklist(spark, start, end, products, reporters, kinds=KINDS) -> DataFrame:
    """Every identity of a request range: months x products x reporters x kinds."""
    listed = month_frame(spark, start, end, "period_start_date")
    for name, values in (
        ("cmd_code", products),
        ("reporter_code", reporters),
        ("query_type", kinds),
    ):
        listed = listed.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return listed


def missing_extracts(planned: DataFrame, present: DataFrame, refresh: bool = False) -> DataFrame:
    """Planned identities still to fetch; a refresh fetches all of them again."""
    key = ["period_start_date", "cmd_code", "reporter_code", "query_type"]
    return planned if refresh else planned.join(present.select(*key), key, "left_anti")


def recent_window(planned: DataFrame, anchor: Column, months: int = 3) -> DataFrame:
    """The last ``months`` complete months before the month of ``anchor``."""
    first = F.trunc(anchor, "MM")
    return planned.where(
        (F.col("period_start_date") >= F.add_months(first, -months))
        & (F.col("period_start_date") < first)
    )


def record_line() -> Column:
    """A raw row as the source's JSON line: sorted keys, exact amounts as text."""
    fields = {
        "classificationCode": F.col("hs_version"),
        "cmdCode": F.col("cmd_code"),
        "customsCode": F.lit(CUSTOMS_CODE),
        "flowCode": F.col("flow_code"),
        "freqCode": F.lit(FREQUENCY),
        "isOriginalClassification": F.lit(True),
        "motCode": F.lit(0),
        "netWgt": plain_decimal(F.col("net_weight")),
        "partner2Code": F.lit(0),
        "partnerCode": F.col("partner_code").cast("bigint"),
        "period": F.col("period"),
        "primaryValue": plain_decimal(F.col("primary_value")),
        "qty": plain_decimal(F.col("quantity")),
        "reporterCode": F.col("reporter_code").cast("bigint"),
    }
    row = F.struct(*[column.alias(name) for name, column in fields.items()])
    return F.to_json(row, {"ignoreNullFields": "false"})


def request_of(kind: Column) -> Column:
    """Parameters of the request an extract answers."""
    fixed = {
        "flowCode": F.lit(IMPORT_FLOW),
        "partner2Code": F.lit("0"),
        "customsCode": F.lit(CUSTOMS_CODE),
        "motCode": F.lit("0"),
        "reporterCode": F.col("reporter_code"),
        "period": F.col("period"),
        "cmdCode": F.col("cmd_code"),
    }
    pairs = [part for name, value in fixed.items() for part in (F.lit(name), value)]
    world = F.create_map(F.lit("partnerCode"), F.lit("0"))
    nothing = F.create_map().cast("map<string,string>")
    return F.map_concat(F.create_map(*pairs), F.when(kind == "world_total", world).otherwise(nothing))


def land_extracts(rows: DataFrame, root: str, source: str = "panel") -> None:
    """Store extracts below ``root``: their data, then the manifests that commit them.

    ``rows`` are raw rows with ``query_type``. Checksums are those of the files as they were
    written. A failure before the manifests leaves data that a scan refuses.
    """
    spark = rows.sparkSession
    keyed = rows.withColumns({"line": record_line(), "place": F.col("partner_code").cast("bigint")})
    write_lines(keyed, root, ("place", "line"))
    facts = rows.groupBy(*PATH_FIELDS).agg(
        F.count("*").alias("row_count"),
        exact_sum(F.col("primary_value")).alias("total"),
        F.max("ingested_at").alias("at"),
    )
    wanted: dict[str, list[str]] = {}
    for row in rows.select("reporter_code", "period").distinct().collect():  # markets x months
        wanted.setdefault(row[0], []).append(row[1])
    if not wanted:
        return
    hashed = scan_checksums(spark, root, scope_paths(root, wanted))
    path = path_identity(F.concat("extract", F.lit("/x")))
    named = hashed.select(*[path[f"path_{name}"].alias(name) for name in PATH_FIELDS], "data_checksum")
    manifests = facts.join(named, list(PATH_FIELDS)).select(
        *PATH_FIELDS,
        request_of(F.col("query_type")).alias("request_parameters"),
        F.col("data_checksum").alias("checksum"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "row_count",
        plain_decimal(F.col("total")).alias("primary_value_sum"),
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("ingested_at"),
        F.lit(source).alias("source"),
    )
    write_manifests(manifests, root)
