"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("period_start_date", T.DateType()),
        T.StructField("reporter_code", T.StringType()),
        T.StructField("partner_code", T.StringType()),
        T.StructField("flow_code", T.StringType()),
        T.StructField("cmd_code", T.StringType()),
        T.StructField("hs_version", T.StringType()),
        T.StructField("primary_value", MONEY),
        T.StructField("net_weight", MONEY),
        T.StructField("quantity", MONEY),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("revision", T.LongType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

COUNTRY_SCHEMA = T.StructType(
    [
        T.StructField("partner_code", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_note", T.StringType()),
        T.StructField("source_iso_alpha3", T.StringType()),
        T.StructField("source_is_group", T.BooleanType()),
        T.StructField("partner_type", T.StringType()),
        T.StructField("classification_status", T.StringType()),
        T.StructField("map_iso3", T.StringType()),
        T.StructField("reconciliation_role", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("retrieved_at", T.StringType()),
        T.StructField("classification_source_url", T.StringType()),
        T.StructField("classification_note", T.StringType()),
        T.StructField("mapping_source_url", T.StringType()),
        T.StructField("mapping_note", T.StringType()),
    ]
)

HS_SCHEMA = T.StructType(
    [
        T.StructField("hs_version", T.StringType()),
        T.StructField("cmd_code", T.StringType()),
        T.StructField("hs_description", T.StringType()),
        T.StructField("code_level", T.LongType()),
        T.StructField("parent_code", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("retrieved_at", T.StringType()),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("request_parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("checksum", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("hs_version", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("query_type", T.StringType()),
        T.StructField("cmd_code", T.StringType()),
        T.StructField("revision", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("primary_value_sum", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("attempt_id", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("query_type", T.StringType()),
        T.StructField("cmd_code", T.StringType()),
        T.StructField("hs_version", T.StringType()),
        T.StructField("revision", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("manifest_file", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("load_job_id", T.StringType()),
        T.StructField("transfer_run_id", T.StringType()),
        T.StructField("merge_job_id", T.StringType()),
        T.StructField("expected_row_count", T.LongType()),
        T.StructField("actual_row_count", T.LongType()),
        T.StructField("expected_primary_value_sum", T.StringType()),
        T.StructField("actual_primary_value_sum", MONEY),
        T.StructField("status", T.StringType()),
        T.StructField("error_stage", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("source_ingested_at", T.TimestampType()),
        T.StructField("event_at", T.TimestampType()),
        T.StructField("contract_fingerprint", T.StringType()),
        T.StructField("snapshot_hash", T.StringType()),
    ]
)

_TEXT = T.StringType()
MONTHLY_SCHEMA = T.StructType(
    [
        T.StructField("month", T.DateType()),
        T.StructField("cmd_code", _TEXT),
        T.StructField("hs_version", _TEXT),
        T.StructField("world_value", MONEY),
        T.StructField("previous_year_world_value", MONEY),
        T.StructField("world_yoy", MONEY),
        T.StructField("country_value", MONEY),
        T.StructField("country_count", T.LongType()),
        T.StructField("country_coverage", MONEY),
        T.StructField("hhi", MONEY),
        T.StructField("hhi_status", _TEXT),
        T.StructField("has_world", T.BooleanType()),
        T.StructField("has_countries", T.BooleanType()),
        T.StructField("reporter_code", _TEXT),
    ]
)
PARTNER_SCHEMA = T.StructType(
    [
        T.StructField("month", T.DateType()),
        T.StructField("cmd_code", _TEXT),
        T.StructField("hs_version", _TEXT),
        T.StructField("partner_code", _TEXT),
        T.StructField("source_name", _TEXT),
        T.StructField("map_iso3", _TEXT),
        T.StructField("import_value", MONEY),
        T.StructField("market_share", MONEY),
        T.StructField("market_share_status", _TEXT),
        T.StructField("previous_month_value", MONEY),
        T.StructField("previous_year_value", MONEY),
        T.StructField("mom", MONEY),
        T.StructField("yoy", MONEY),
        T.StructField("reporter_code", _TEXT),
    ]
)
MONTHLY_COLUMNS = MONTHLY_SCHEMA.fieldNames()
PARTNER_COLUMNS = PARTNER_SCHEMA.fieldNames()
