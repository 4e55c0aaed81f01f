"""Conforming rows to the country, product and calendar dimensions.

The dimensions are left to Spark's size threshold: below it they are broadcast,
beyond it they are merged, and adaptive execution splits a hot key of the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthloom.operators.select import valid_amount, verified_country

HS_KEY = ("hs_version", "cmd_code")


def dim_countries(seed: DataFrame) -> DataFrame:
    return seed.withColumn("map_iso3", F.nullif(F.col("map_iso3"), F.lit("")))


def dim_hs_codes(seed: DataFrame) -> DataFrame:
    return seed.select(
        "hs_version",
        "cmd_code",
        "hs_description",
        "code_level",
        "parent_code",
        "source_url",
        "retrieved_at",
    )


def conform_dimensions(
    detail: DataFrame, countries: DataFrame, hs_codes: DataFrame, months: DataFrame
) -> DataFrame:
    """Keep every row; unmatched attributes get defaults and a flag."""
    country = countries.select(
        "partner_code",
        "source_name",
        F.col("partner_type").alias("country_type"),
        F.col("classification_status").alias("country_status"),
        "map_iso3",
        F.col("reconciliation_role").alias("country_role"),
        F.lit(True).alias("country_hit"),
    )
    product = hs_codes.select(*HS_KEY, "hs_description", F.lit(True).alias("product_hit"))
    month = months.select(
        F.col("month_start_date").alias("period_start_date"), F.lit(True).alias("month_hit")
    )
    joined = (
        detail.join(country, "partner_code", "left")
        .join(product, list(HS_KEY), "left")
        .join(month, "period_start_date", "left")
    )
    return joined.select(
        *detail.columns,
        "source_name",
        F.coalesce("country_type", F.lit("unknown")).alias("partner_type"),
        F.coalesce("country_status", F.lit("needs_review")).alias("classification_status"),
        "map_iso3",
        F.coalesce("country_role", F.lit("unresolved")).alias("reconciliation_role"),
        "hs_description",
        F.col("country_hit").isNotNull().alias("country_mapping_found"),
        F.col("product_hit").isNotNull().alias("hs_mapping_found"),
        F.col("month_hit").isNotNull().alias("month_mapping_found"),
    )


def conform_verified(detail: DataFrame, countries: DataFrame, hs_codes: DataFrame) -> DataFrame:
    """Keep valid amounts of verified countries; the product may stay unmapped."""
    country = countries.where(verified_country()).select(
        "partner_code", "source_name", "map_iso3"
    )
    product = hs_codes.select(*HS_KEY, "hs_description", F.lit(True).alias("product_hit"))
    return (
        detail.where(valid_amount(F.col("primary_value")))
        .join(country, "partner_code")
        .join(product, list(HS_KEY), "left")
        .select(
            *detail.columns,
            "source_name",
            "map_iso3",
            "hs_description",
            F.col("product_hit").isNotNull().alias("hs_mapping_found"),
        )
    )


def reference_refresh(
    existing: DataFrame,
    partners: DataFrame,
    official: DataFrame,
    retrieved_at: str,
    partner_source: str = "",
    official_source: str = "",
) -> DataFrame:
    """Add partners whose code and ISO3 agree with the official list.

    ``partners``: id, name, note, iso3, is_group. ``official``: code, name, iso3.
    Reviewed rows are never changed.
    """
    wanted = partners.where(F.col("is_group").eqNullSafe(F.lit(False))).select(
        F.col("id").cast("long").cast("string").alias("partner_code"),
        F.col("name").alias("source_name"),
        F.coalesce("note", F.lit("")).alias("source_note"),
        F.col("iso3").alias("source_iso_alpha3"),
    )
    listed = official.select(
        F.col("code").cast("long").cast("string").alias("partner_code"),
        F.col("name").alias("official_name"),
        F.col("iso3").alias("official_iso3"),
    )
    agreed = (
        wanted.join(existing.select("partner_code"), "partner_code", "left_anti")
        .join(listed, "partner_code")
        .where(F.col("source_iso_alpha3") == F.col("official_iso3"))
    )
    # Fixed note texts of the reference list.
    note = F.concat(
        F.lit("Comtrade code and ISO3 match M49 country/area: "), F.col("official_name")
    )
    added = agreed.select(
        "partner_code",
        "source_name",
        "source_note",
        F.col("official_iso3").alias("source_iso_alpha3"),
        F.lit(False).alias("source_is_group"),
        F.lit("country").alias("partner_type"),
        F.lit("verified").alias("classification_status"),
        F.col("official_iso3").alias("map_iso3"),
        F.lit("detail").alias("reconciliation_role"),
        F.lit(partner_source).alias("source_url"),
        F.lit(retrieved_at).alias("retrieved_at"),
        F.lit(official_source).alias("classification_source_url"),
        note.alias("classification_note"),
        F.lit(official_source).alias("mapping_source_url"),
        F.lit("Official code and ISO3 verified; geometry coverage checked separately").alias(
            "mapping_note"
        ),
    )
    return existing.unionByName(added.select(*existing.columns))


def with_label(
    frame: DataFrame,
    labels: DataFrame,
    overrides: dict[str, str] | None = None,
    name: str = "source_name",
    iso3: str = "map_iso3",
    code: str = "partner_code",
) -> DataFrame:
    """``label``: an override of the source name, else by ISO3, else the source name."""
    original = F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(code), F.lit(""))
    looked_up = labels.select(F.col("iso3").alias(iso3), F.col("label").alias("iso_label"))
    label: Column = F.coalesce("iso_label", original)
    for source, shown in (overrides or {}).items():
        label = F.when(original == source, F.lit(shown)).otherwise(label)
    return frame.join(looked_up, iso3, "left").select(*frame.columns, label.alias("label"))
